"""Histogram packing, source divergence and impact-ordered search against brute force and their SQL."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from planforge.llm import divergence, histogram_packing, impact_search
from planforge.llm.common import AS_WRITTEN, distinct_words

#: clashing and needless columns beside those that are read
DOCS = "doc_id long, text string, lang string, source string, n_chars long, length long, rank int, term string, n long, docs long, shard int, score long, start long, ids binary, total long, kind int"
EXTRA = (1, 2, 3, "x", 4, 5, 6, 7, 8, b"y", 9, 10)


def rows():
    r = random.Random(3)
    stock = ["Alpha", "beta", "GAMMA", "naïve", "été", "x1", "42", "日本", "l'eau", "co-op", "Zed", "the", "the", "the"]
    out = []
    for i in range(240):
        text = " ".join(r.choice(stock) + (str(r.randint(0, 9)) if r.random() < 0.2 else "") for _ in range(r.randint(1, 90)))
        out.append((i, text, ["en", "de", None, "fr"][i % 4], ["a", "b", None, "ü"][i // 4 % 4], *EXTRA))
    hot = "the hot text of many copies, the same the whole time"
    out += [(1000 + i, hot, "en", "hot", *EXTRA) for i in range(120)]  # a third of all rows: ties
    out += [(2000, None, None, None, *EXTRA), (2001, "", "xx", "a", *EXTRA), (2002, " \n\t", "en", "", *EXTRA), (2003, "Long the " * 3000, "en", "a", *EXTRA), (2004, "x" * 6000, "de", "solo", *EXTRA), (2005, "!! -- ..", "zz", None, *EXTRA)]
    out += [(None, "no id the Alpha", "en", "a", *EXTRA)] * 2 + [(3, "repeated id beta", "en", "b", *EXTRA)] * 2 + [(2006, "été İstanbul ''s don't'LL _x__ <|endoftext|>y \x1c\x85a​b ½²３ 🙂", "en", "b", *EXTRA)]
    return out


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), DOCS).repartition(5).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


# --- 11: packing ---
def ids_of(text):
    t = Tokenizer.from_file(histogram_packing.vocabulary())
    return [*t.encode(text or "", add_special_tokens=False).ids, 1]


def test_words_encode_like_whole_texts():
    r = random.Random(1)
    chars = "aAzZéÉéİıßẞǅſ'’sStTlL019½²３_-.!<|>  ​\x1c\x85日本🙂퟿ ΣςΟͅ"
    texts = ["".join(r.choice(chars + "     \n\t") for _ in range(r.randint(0, 60))) for _ in range(600)] + ["x<|endoftext|>y <|STARTOFTEXT|>", ""]
    flat, counts = histogram_packing.encode([t.encode() for t in texts], histogram_packing.vocabulary())
    t = Tokenizer.from_file(histogram_packing.vocabulary())
    assert [x.tolist() for x in np.split(flat, np.cumsum(counts)[:-1])] == [t.encode(x, add_special_tokens=False).ids for x in texts]


def placed(got, size):
    """Pieces by sequence are gapless from 0 and fit; returns the share of padding."""
    by, pad, all_ids = defaultdict(list), 0, 0
    for r in got:
        by[r.sequence_id].append(r)
    for pieces in by.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at and 0 < r.length <= size
            at += r.length
        assert at <= size
        all_ids += at
        pad += 0 if at & (at - 1) == 0 else size - at
    assert sorted(by) == list(range(len(by)))
    return pad / max(1, all_ids)


@pytest.mark.parametrize("size", [64, 2048])
def test_histogram_packing(docs, empty, size):
    got = histogram_packing.pack(docs, size=size).collect()
    assert placed(got, size) < 0.3  # a third of all pieces has one length here
    rest = Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got)
    want = Counter()
    for d, text, *_ in rows():
        ids = ids_of(text)
        for s in range(0, len(ids), size):
            part = np.array(ids[s : s + size], dtype="<u4").tobytes()
            want[d, s, len(part) // 4, zlib.crc32(part), len(ids)] += 1
    assert rest == want and all(zlib.crc32(r.ids) == r.ids_crc32 for r in got)
    none = histogram_packing.pack(empty, size=size)
    assert none.count() == 0 and none.columns == [*"doc_id start length ids_crc32 doc_tokens sequence_id offset ids".split()]


def test_packs_do_not_follow_file_splits(docs):
    one, other = (Counter(tuple(r) for r in histogram_packing.pack(docs.repartition(n), size=128, with_ids=False).collect()) for n in (1, 7))
    assert one == other


def test_sequences_hold_what_was_packed(docs):
    packed = histogram_packing.pack(docs, size=256)
    out, back = histogram_packing.sequences(packed, size=256, pad=9).collect(), defaultdict(Counter)
    for r in out:
        ids = np.frombuffer(r.ids, "<u4")
        assert len(ids) == r.padded_length == (r.n_tokens if r.n_tokens & (r.n_tokens - 1) == 0 else 256) and (ids[r.n_tokens :] == 9).all()
        assert r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens and len(r.cu_seqlens) == len(r.starts) + 1 == len(r.doc_ids) + 1
        for d, s, a, b in zip(r.doc_ids, r.starts, r.cu_seqlens, r.cu_seqlens[1:]):
            back[d][s, tuple(ids[a:b].tolist())] += 1
    want = defaultdict(Counter)
    for d, text, *_ in rows():
        ids = ids_of(text)
        want[d].update((s, tuple(ids[s : s + 256])) for s in range(0, len(ids), 256))
    assert back == want


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 32), st.integers(1, 50), max_size=20))
def test_shortest_pack_first(histogram):
    """The patterns are those of placing piece by piece, longest first, into the pack with the most space."""
    space = []
    for x in sorted(histogram, reverse=True):
        for _ in range(histogram[x]):
            k = max(range(len(space)), key=space.__getitem__, default=None)
            if k is None or space[k] < x:
                space.append(32 - x)
            else:
                space[k] -= x
    found = histogram_packing.patterns(histogram, 32)
    left = Counter()
    for count, pattern in found:
        left[32 - sum(a * b for a, b in pattern)] += count
        assert [a for a, _ in pattern] == sorted({a for a, _ in pattern}, reverse=True)
    assert left == Counter(space) and len(found) <= 2 * len(histogram) + 1
    p = histogram_packing.plan(histogram, 32)
    lengths = np.array([x for x in histogram for _ in range(histogram[x])], dtype=np.int64)
    ranks = np.array([k for x in histogram for k in range(histogram[x])], dtype=np.int64)
    sequence, offset = histogram_packing.place(p, lengths, ranks)
    filled = Counter((s, o + i) for s, o, x in zip(sequence.tolist(), offset.tolist(), lengths.tolist()) for i in range(x))
    assert not filled or max(filled.values()) == 1
    assert all(len({o for q, o in filled if q == s}) == 1 + max(o for q, o in filled if q == s) for s in range(p.n_sequences))


def test_distinct_words():
    texts = [b"b a B", b"", b"a \xc3\xa9 b", b"a" * (1 << 20), b"B"]
    index, words, counts, hashes = distinct_words(texts, value=AS_WRITTEN)
    assert [words[i] for i in index] == [w for t in texts for w in t.split()] and counts.tolist() == [3, 0, 3, 1, 1] and (np.diff(hashes.astype(object)) > 0).all()
    assert distinct_words([])[1] == [] and distinct_words([b"", b" "])[2].tolist() == [0, 0]


# --- 12: divergence ---
def tables(docs):
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text", "lang", "source").toArrow())
    return con


def test_divergence_is_its_sql(docs, empty):
    got = divergence.divergence(docs)
    assert Counter(map(tuple, got.collect())) == Counter(tables(docs).execute(divergence.ORACLE).fetchall())
    assert divergence.divergence(empty).count() == 0


@pytest.mark.parametrize("least", [1, 3, 10_000])
def test_divergence_by_hand(docs, least):
    count, held, groups = Counter(), defaultdict(int), set()
    for _, text, lang, source, *_ in rows():
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        for t in terms:
            count[lang, source, t] += 1
        for t in set(terms):
            held[lang, t] += 1
    want = set()
    for lang in {g for g, _ in groups}:
        kept, own = [t for (g, t), n in held.items() if g == lang and n >= least], sorted(s for g, s in groups if g == lang)
        p = {}
        for s in [*own, None]:
            c = {t: count[lang, s, t] if s is not None else sum(count[lang, x, t] for x in own) for t in kept}
            p[s] = {t: 1 + 10**9 * (n + 2) // (sum(c.values()) + 2 * len(kept)) for t, n in c.items()}
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in own:
            pair = [(x, sum(f(p[s][t], p[x][t]) for t in kept)) for x in own if x != s]
            term = [(t, f(p[s][t], p[None][t])) for t in kept if count[lang, s, t] and p[s][t] > p[None][t]]
            for part, found in (("pair", pair), ("term", term)):
                for k, (item, value) in enumerate(sorted(found, key=lambda x: (-x[1], x[0].encode()))):
                    if part == "pair" or k < 10:
                        want.add((lang, s, part, item, value, k + 1))
    assert {tuple(r) for r in divergence.divergence(docs, least=least).collect()} == want


# --- 13: search ---
def items(spark, found):
    return spark.createDataFrame(found, "item_id long, text string, doc_id long, score long, rank int").repartition(2)


ITEMS = [(1, "The hot naïve text", 1, 1, 1), (2, "the the THE the", 1, 1, 1), (3, "alpha été 42 x1 日本 zed", 1, 1, 1), (4, None, 1, 1, 1), (5, "", 1, 1, 1), (6, "unheard-of", 1, 1, 1), (7, "long Long " * 500 + "x", 1, 1, 1), (8, "co op l eau gamma", 1, 1, 1), (8, "co op l eau gamma", 1, 1, 1)]


def brute(found, k=10):
    terms = lambda t: re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    have = [(d, Counter(w), len(w)) for d, text, *_ in rows() if (w := terms(text))]
    n_docs, total, held = len(have), sum(n for *_, n in have), Counter(t for _, c, _ in have for t in c)
    out = set()
    for i, text, *_ in set(found):
        scored = []
        for d, c, n in have:
            m = 25 + 75 * n * n_docs // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in terms(text) if c[t])
            if s > 0:
                scored.append((-s, d is None, d or 0, d))
        out |= {(i, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(scored)[:k])}
    return out


@pytest.mark.parametrize(("postings", "query_terms", "seen"), [(1, 1 << 18, 1 << 26), (200, 12, 1 << 26), (1 << 20, 1 << 18, 1 << 26), (1 << 20, 1 << 18, 0)])
def test_search_is_brute_force(spark, docs, monkeypatch, postings, query_terms, seen):
    monkeypatch.setattr(impact_search, "POSTINGS", postings)
    monkeypatch.setattr(impact_search, "SEEN", seen)
    got = impact_search.search(docs, items(spark, ITEMS), query_terms=query_terms).collect()
    assert {tuple(r)[:4] for r in got} == brute(ITEMS) and len(got) == len(brute(ITEMS))


def test_search_stops_early_and_stays_exact(spark):
    r = np.random.default_rng(4)
    stock = [f"w{i}" for i in range(400)]
    texts = [" ".join(stock[min(399, int(x))] for x in r.zipf(1.3, size=60)) for _ in range(3000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    asked = items(spark, [(i, f"w0 w1 w{50 + i} w{90 + i} w{200 + i}", 0, 0, 0) for i in range(30)])
    got = impact_search.search(docs, asked).collect()
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    con.register("benchmark", asked.select("item_id", "text").toArrow())
    assert {tuple(x)[:4] for x in got} == set(con.execute(impact_search.ORACLE).fetchall())
    assert sum(x.n_read < x.n_postings for x in got) > 0.3 * len(got)  # some searches end before their lists do


def test_search_of_nothing(spark, docs, empty):
    assert impact_search.search(empty, items(spark, ITEMS)).count() == 0
    none = impact_search.search(docs, items(spark, []))
    assert none.count() == 0 and none.columns[:4] == ["item_id", "rank", "doc_id", "score"]
    assert impact_search.search(docs, items(spark, [(1, None, 1, 1, 1), (None, "Alpha", 1, 1, 1)])).count() == 10
