"""Training-data operators against brute force, on small fixtures with nulls, empty, long, tied and repeated rows."""

import base64
import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken

from planforge.llm import bpe, exact_dedup, lm_scoring, mixing, near_dedup, packing, pii, pretokens, topk_search, toxicity, url_filter
from planforge.llm.common import Scratch

DOCS = "doc_id long, text string, lang string, source string, n_chars long, row long, key long, kept string, size int, cid long"
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def texts():
    r = random.Random(5)
    base = [" ".join(r.choice(["alpha", "beta", "gamma", "delta", "Eps", "zêta", "don't", "x1"]) + str(r.randint(0, 40)) for _ in range(120)) for _ in range(6)]
    out = [None, "", " \n\t", "one", "One", "o n e", "one ", "'s it's WE'LL  spaced   out \n\n end  ", "a b c", "a b c ", "a b c d e", "🙂🙂 \x1c\x1f mixed２３ ½ ça  ", "x" * 5000, "7 " * 3000]
    for b in base:
        w = b.split()
        out += [b, b, b + "  ", b.upper()]
        for k in range(8):
            v = list(w)
            for _ in range(1 + k % 4):
                v[r.randrange(len(v))] = f"edit{r.randint(0, 99)}"
            out.append(" ".join(v))
    return out


def frame(spark, rows=None):
    rows = [(i, t, "en", f"src{i % 5}" if i % 7 else None, 1, 2, 3, "x", 4, 5) for i, t in enumerate(texts())] + [(None, "no id", None, None, None, None, None, None, None, None), (3, "one", "en", "src3", 1, 1, 1, "y", 1, 1)] if rows is None else rows
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return frame(spark, [])


def rows_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def words(t):
    return WORD.findall((t or "").encode().lower())


def test_exact_dedup(docs, empty):
    rows = rows_of(docs)
    norm = lambda t: re.sub("[ \t-\r]", "", t or "")
    groups = {}
    for d, t in rows:
        groups.setdefault(norm(t), []).append((-len(t or ""), d is None, d or 0, d))
    got = exact_dedup.exact_dedup(docs, capacity=500).collect()
    assert len(got) == len(rows)
    expect = Counter((d, min(groups[norm(t)])[3], len(groups[norm(t)]), hashlib.sha256(norm(t).encode()).digest()) for d, t in rows)
    assert Counter((r.doc_id, r.keep_id, r.group_size, bytes(r.sha)) for r in got) == expect
    assert sum(r.kept for r in got) == len(groups)
    assert exact_dedup.exact_dedup(empty).count() == 0


def test_directory_doubles_only_where_full():
    slots = exact_dedup.directory({0: 100, 1: 1, 8: 1}, 4, 50)
    assert [s for s, _ in slots] == list(range(16))
    assert dict(slots)[0] == 0 and dict(slots)[1] == 1 and len({b for s, b in slots if s >= 8}) == 1


def test_lm_scoring(docs, empty):
    rows = rows_of(docs)
    train = [t for d, t in rows if d is None or zlib.crc32(str(d).encode()) % 10]
    c = Counter(w for t in train for w in [*words(t), None])
    n, v = sum(c.values()), len(c)
    got = lm_scoring.score(docs.select("doc_id", "text"), lm_scoring.train(docs.select("doc_id", "text"))).collect()
    base = lambda t: sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in [*words(t), None])
    expect = sorted((d is None, d or 0, len(words(t)) + 1, sum(c[w] > 0 for w in [*words(t), None]), round(base(t), 6)) for d, t in rows)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in got) == expect
    assert {r.train_tokens for r in got} == {n}
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 10 == 0) for r in got)
    assert sum(r.score for r in got) > sum(r.base_score for r in got)
    assert lm_scoring.score(empty.select("doc_id", "text"), lm_scoring.train(empty.select("doc_id", "text"))).count() == 0


def test_log_frequency_filter_never_underestimates():
    h = lm_scoring.mix64(np.arange(1, 20001, dtype=np.uint64))
    counts = np.random.default_rng(1).zipf(1.7, 20000).clip(1, 10**6)
    order = np.argsort(h)
    edges = lm_scoring.splits(h[order], 4)
    own = lm_scoring.Filter([lm_scoring.build_filter(h[order][a:b], counts[order][a:b]).tobytes() for a, b in zip(edges[:-1], edges[1:])])
    level, true = own.level(h), lm_scoring.levels(counts)
    assert (level >= true).all() and (level > true).mean() < 0.03
    unseen = own.level(lm_scoring.mix64(np.arange(10**6, 10**6 + 20000, dtype=np.uint64)))
    assert (unseen > 0).mean() < 0.03


def test_lm_shards_answer_exactly_or_by_their_own_filter():
    """A shard of very many: its filter isn't cut to a share of a global bound, and tokens keep their counts."""
    r = np.random.default_rng(8)
    h = np.unique(lm_scoring.mix64(np.arange(1, 60001, dtype=np.uint64)))
    counts = r.integers(1, 40, len(h)).astype(np.uint32)
    counts[::2] = 0
    for kind in lm_scoring.KINDS:
        rows = lm_scoring._table([(kind, 5, 3, bpe.pack(lm_scoring.gaps(h), counts)), (kind, None, 3, bpe.pack(lm_scoring.gaps(h[:10]), counts[:10]))])
        sums, own = lm_scoring._answer(lm_scoring.pa.Table.from_batches([rows])).to_pylist()
        true = counts.astype(int)
        true[:10] *= 2
        assert (sums["total"], sums["held"], sums["chunk"], own["chunk"]) == (true.sum(), (true > 0).sum(), None, 5)
        value = bpe.unpack(own["data"])[0]
        if kind == lm_scoring.UNIGRAM:
            assert value.tolist() == true.tolist()
        else:
            true[true > 0] = lm_scoring.levels(true[true > 0])
            assert sums["full"] < 0.5 and (value >= true).all() and (value > true).mean() < 0.03


def test_lm_scores_set_repeated_texts_apart(spark):
    """A text that occurs twice is likelier than texts like it that occur once."""
    r = random.Random(7)
    texts = [" ".join(f"w{int(r.paretovariate(0.8)) % 500}" for _ in range(120)) for _ in range(150)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(1000 + i, texts[i]) for i in range(25)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {x.doc_id: x.score for x in lm_scoring.score(df, lm_scoring.train(df)).collect()}
    once, twice = [got[i] for i in range(25, 150)], [got[i] for i in range(25)]
    assert np.median(twice) > np.quantile(once, 0.7)


def test_lm_scores_are_the_smoothed_counts(docs, spark):
    """Against exact counts: nearly all documents have the model's formula; other texts than the learnt ones too."""
    table, few = lm_scoring.expected(), docs.where("doc_id % 3 = 1")
    rows = rows_of(docs)
    train = [[None, *words(t), b""] for d, t in rows if d is None or zlib.crc32(str(d).encode()) % 10]
    one, two, three = Counter(w for t in train for w in t), Counter(p for t in train for p in zip(t, t[1:])), Counter(p for t in train for p in zip([b"^", *t], t, t[1:]))
    total, distinct = sum(one.values()) - one[None], len(one) - 1
    level = lambda n: table[lm_scoring.levels(np.array([n]))[0]] if n else 0.0

    def brute(text):
        t, out = [None, *words(text), b""], 0.0
        history = one[None]
        for z, a, b in zip([b"^", *t], t, t[1:]):
            p = (one[b] + 0.1) / (total + 0.1 * (distinct + 1))
            pair = min(level(two[a, b]), one[a], one[b])
            p = (pair + 200 * p) / (one[a] + 200)
            out += math.log10((min(level(three[z, a, b]), pair, history) + 5 * p) / (history + 5))
            history = pair
        return out

    for asked in (docs, few):
        got = sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.train_tokens, r.score) for r in lm_scoring.score(asked, lm_scoring.train(docs)).collect())
        expect = sorted((d is None, d or 0, len(words(t)) + 1, total, brute(t)) for d, t in rows_of(asked))
        assert [g[:4] for g in got] == [e[:4] for e in expect]
        near = [abs(g[4] - e[4]) < 0.02 * abs(e[4]) for g, e in zip(got, expect)]
        assert sum(near) > 0.85 * len(near)


def brute_near(rows):
    sets = []
    for _, t in rows:
        w = words(t)
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if rows[i][0] is not None and rows[j][0] is not None and sets[i] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return sorted((d is None, d or 0, len(s), low.get(find(i)) if d is not None else None) for i, ((d, _), s) in enumerate(zip(rows, sets)))


def test_near_dedup(docs, empty):
    got = near_dedup.near_dedup(docs).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_shingles, r.component_id) for r in got) == brute_near(rows_of(docs))
    assert near_dedup.near_dedup(empty).count() == 0


def test_near_dedup_chain_in_one_bucket(spark):
    """A chain of drifting copies: neighbours are linked, ends are not; all are one component."""
    r = random.Random(2)
    w = [f"w{r.randint(0, 10**6)}" for _ in range(300)]
    rows = []
    for i in range(60):
        rows.append((100 + i, " ".join(w)))
        w = list(w)
        for _ in range(3):
            w[r.randrange(300)] = f"v{r.randint(0, 10**6)}"
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_dedup.near_dedup(df).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_shingles, r.component_id) for r in got) == brute_near(rows)


def test_near_dedup_large_bucket_of_unlinked_and_linked(spark):
    """A large family of copies, most of them unlike each other: every link is found, blocks included."""
    r = random.Random(6)
    w = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(330):
        v = list(w)
        for _ in range(r.randint(0, 7)):
            v[r.randrange(150)] = f"v{r.randint(0, 10**6)}"
        rows.append((i, " ".join(v)))
    got = near_dedup.near_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_shingles, r.component_id) for r in got) == brute_near(rows)


def test_near_dedup_deals_large_buckets_by_a_second_band(spark):
    """As above with a low bound, so that all buckets are dealt again."""
    r = random.Random(16)
    rows = []
    for f in range(3):
        w = [f"w{f}-{i}" for i in range(150)]
        for i in range(60):
            v = list(w)
            for _ in range(r.randint(0, 5)):
                v[r.randrange(150)] = f"v{r.randint(0, 10**6)}"
            rows.append((1000 * f + i, " ".join(v)))
    got = near_dedup.near_dedup(spark.createDataFrame(rows, "doc_id long, text string"), reband=3).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_shingles, r.component_id) for r in got) == brute_near(rows)


def test_near_dedup_leads(spark):
    """One text of a component leads, also where one doc_id has two texts, only one of which is linked."""
    w = [f"w{i}" for i in range(60)]
    rows = [(5, " ".join(w)), (7, " ".join(w[:-1]) + " x"), (7, "something of its own that nothing is like"), (5, " ".join(w)), (8, None), (None, " ".join(w))]
    got = near_dedup.near_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0, r.leads) for r in got) == [(0, 0, True), (5, 5, True), (5, 5, True), (7, 5, False), (7, 7, True), (8, 8, True)]


def test_intersections():
    r = np.random.default_rng(7)
    sets = [np.unique(r.integers(0, 300, r.integers(1, 200)).astype(np.uint64)) for _ in range(20)]
    got = near_dedup.intersections(sets[:12], sets[5:], width=64)
    assert got.astype(int).tolist() == [[len(np.intersect1d(a, b)) for b in sets[5:]] for a in sets[:12]]


def test_registers_merge_and_estimate():
    r = np.random.default_rng(3)
    x = near_dedup.mix64(r.integers(0, 2**63, 4000).astype(np.uint64))
    a, b = x[:3000], x[1000:]
    ra, rb, ru = near_dedup.registers([a, b, x])
    assert (near_dedup.merge(ra, rb) == ru).all()
    one = lambda v: np.array([v], dtype=float)
    assert not near_dedup.possible(ra[None], rb[None], one(3000), one(3000))[0]
    assert near_dedup.possible(ra[None], ru[None], one(3000), one(3500), 0.7)[0]


def tiktoken_encoder():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))}
    return tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_round_trip(docs, empty):
    enc, got = tiktoken_encoder(), bpe.digests(docs).collect()
    hexed = lambda b: hashlib.sha256(b).hexdigest()
    expect = Counter((d, len(i := enc.encode_ordinary(t or "")), hexed(" ".join(map(str, i)).encode()), hexed((t or "").encode())) for d, t in rows_of(docs))
    assert Counter(map(tuple, got)) == expect
    assert bpe.digests(empty).count() == 0


def test_pretokens_follow_the_pattern():
    r, pattern = random.Random(9), regex.compile(public_tokenizers.PATTERN)
    parts = ["a", "st", "re", "ll", "'", "'s", "''", " ", "  ", "\n", "1", "²", "é", "!", "　", "\x1f", "\0", "🙂"]
    for _ in range(800):
        ts = ["".join(r.choice(parts) for _ in range(r.randint(0, 12))) for _ in range(3)]
        index, found, counts, _ = pretokens.split(ts)
        assert [found[i] for i in index] == [m for t in ts for m in pattern.findall(t)]
        assert counts.tolist() == [len(pattern.findall(t)) for t in ts]


def test_pii(docs, spark, empty):
    good = "4111 1111 1111 1111"
    rows = [(1, f"mail a.b_c@d-e.fr.org_x@y.zz! ip 1.2.3.4.5 and 300.1.1.1 {good} +1 (017) 555-7713 x"), (2, None), (3, "é @x @@ a@b"), (4, "0" * 6000 + ".1.1.1")]
    rows += [(10 + i, f"call my desk line +49 30 55500{i} today") for i in range(5)] + [(20, "call my desk line 030-5550099 today"), (21, "odd 030-5550099 here")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in pii.find_pii(df).collect()}
    patterns = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}

    def test(kind, m):
        digits = [int(c) for c in m if c.isdigit()]
        if kind == "ip":
            return all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) < 256 for p in m.split("."))
        if kind == "card":
            return 16 <= len(digits) <= 19 and sum(sum(divmod(d * (1 + i % 2), 10)) for i, d in enumerate(digits[::-1])) % 10 == 0
        return kind != "phone" or 8 <= len(digits) <= 15

    for d, t in rows:
        expect = [(k, *m.span()) for k, p in patterns.items() for m in re.finditer(p, t or "") if test(k, m[0])]
        assert [tuple(x) for x in got[d].base] == expect, d
    assert [x.kind for x in got[20].spans] == ["phone"]  # discovered by its context
    assert pii.find_pii(docs).count() == docs.count() and pii.find_pii(empty).count() == 0


def test_pii_rounds_go_on_while_they_find(spark):
    """Six known instances make each of two contexts trusted, which hold three new ones each: six levels deep."""
    name = lambda level, j: f"{level}55{j}-0099" if level else f"+49 30 55500{j}"
    texts = [f"a{w} b{w} {i} z{w}" for level in range(6) for x in (0, 1) for w in ["abcdef"[level] + "xy"[x]] for i in [*(name(level, j) for j in range(6)), *(name(level + 1, 3 * x + j) for j in range(3))]]
    got = pii.find_pii(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert [r.doc_id for r in got if [s.kind for s in r.spans] != ["phone"]] == []


def test_pii_candidates_are_whole(spark):
    odd = ["01 23 45 67 89", "4111 1111 1111 1112", "AB12345", "x" * 100 + "77-12", "7", "(030) 12 34", "a1@local"]
    texts = [f"my desk line +49 30 55500{i} today" for i in range(30)] + [f"my desk line {x} today" for x in odd] + ["at 10.0.0.1 12345, 67 89. 5\n6"]
    got = {r.doc_id: r for r in pii.find_pii(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert [[texts[30 + i][x.s : x.e] for x in got[30 + i].spans] for i in range(len(odd))] == [[x] for x in odd]
    assert [m["instance"] for m in pii._mentions(texts[-1])[1]] == ["10.0.0.1", "12345", "67", "67 89", "89", "5", "6"]
    assert [m["instance"] for m in pii._mentions("1 2 3 4 5")[1] if len(m["instance"]) > 7] == ["1 2 3 4 5"]


def test_pii_finds_what_a_match_swallowed_and_hidden_seeds(spark):
    """Base matches that run into each other are dropped; their parts have trusted forms.  Hidden seeds are found again."""
    r = random.Random(3)
    phone = lambda: f"+1 ({r.randint(100, 999)}) 555-{r.randint(1000, 9999)}"
    mail = lambda: f"{r.choice('abc')}x.{r.randint(10, 99)}@mail{r.randint(1, 9)}.example.org"
    word = lambda: "".join(r.choice("aeiklmnrst") for _ in range(6))
    texts = [" ".join([word(), word(), r.choice([phone, mail])(), word()]) for _ in range(200)]
    texts += [f"{word()} {phone()} 190.13.22.20 {word()}", f"{word()} version 2.0 {word()} {r.randint(10**11, 10**12)}"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x.doc_id: x for x in pii.find_pii(df).collect()}
    assert [s.kind for s in got[200].base] == ["ip"] and [s.kind for s in got[200].spans] == ["ip", "phone"]
    assert not got[201].spans
    seeds = [(texts[i][s.s : s.e], s.kind) for i, x in got.items() for s in x.base]
    edges = [(p, m["instance"]) for t in texts for m in pii._mentions(t)[1] for p in m["patterns"]]
    hidden = {s for s in seeds if zlib.crc32(s[0].encode()) % 10 == 0}
    known = spark.createDataFrame(sorted(set(seeds) - hidden), "instance string, kind string")
    found = {tuple(x) for x in pii.bootstrap(spark.createDataFrame(sorted(set(edges)), "pattern string, instance string"), known, Scratch(spark, "t")).collect()}
    assert len(hidden) > 10 and len(found & hidden) >= 0.9 * len(hidden) and len(found - set(seeds)) <= 1


def test_pii_is_linear_in_digits():
    begin = time.perf_counter()
    assert [k for k, *_ in pii.base_spans("1" * 300_000 + " " + "2." * 100_000 + "x" + "a@" * 50_000)] .count("ip") == 25_000
    pii._mentions("7 " * 20_000)
    assert time.perf_counter() - begin < 30


def test_topk_is_exact(spark):
    r = np.random.default_rng(4)
    vectors = [(int(i), [float(x) for x in v]) for i, v in enumerate(r.normal(size=(300, 8)))] + [(300 + i, [0.5] * 8) for i in range(60)]
    vectors += [(1000, None), (1001, [None] * 8), (1002, [float("nan")] + [0.1] * 7), (None, [1.0] * 8), (20, vectors[20][1])]
    got = topk_search.search(spark.createDataFrame(vectors, "vec_id long, embedding array<float>"))
    ok = [(i, np.floor(64 * np.array(v, np.float32).astype(float)).astype(int)) for i, v in vectors if i is not None and v and None not in v and np.isfinite(v).all()]
    expect = set()
    for i, q in dict(ok).items():
        if i % 20 == 0:
            best = sorted((-int(q @ x), j) for j, x in ok if j != i)[:20]
            expect |= {(i, k + 1, j, -s) for k, (s, j) in enumerate(best)}
    assert {tuple(x) for x in got.collect()} == expect
    assert topk_search.search(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_topk_of_a_query_with_many_rows_of_its_own():
    """30 rows have the query's id and vector: they neither appear nor prune the others."""
    r = np.random.default_rng(9)
    x = np.floor(64 * np.concatenate([v := r.normal(size=(2000, 64)), np.repeat(v[:1], 29, axis=0)])).astype(np.int32)
    ids = np.concatenate([np.arange(2000), np.zeros(29, int)])
    got = list(topk_search.nra(x[:1], np.array([0]), x, ids, 20))
    best = sorted((-int(s), int(i)) for s, i in zip(x @ x[0], ids) if i != 0)[:20]
    assert sorted((-s, i) for _, i, s in got) == best


def test_topk_of_large_components(spark):
    """Components of 2**20 and more keep their values; scores are exact beyond doubles."""
    r = np.random.default_rng(10)
    rows = [(int(i), [float(x) for x in v]) for i, v in enumerate(r.normal(size=(200, 4)) * np.where(np.arange(200) % 3, 1, 2.0**22)[:, None])]
    rows += [(200, [2.0**24, 1.0, 0.0, 0.0]), (201, [2.0**24, 1.0, 2.0**-6, 0.0])]
    got = topk_search.search(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    v = {i: [math.floor(64 * float(np.float32(x))) for x in e] for i, e in rows}
    expect = {(i, n + 1, j, -s) for i in v if i % 20 == 0 for n, (s, j) in enumerate(sorted((-sum(a * b for a, b in zip(v[i], v[j])), j) for j in v if j != i)[:20])}
    assert {tuple(x) for x in got} == expect


def test_nra_stops_early_and_stays_exact():
    r = np.random.default_rng(5)
    x = np.concatenate([r.integers(-64, 64, (2000, 4)), r.integers(50, 64, (30, 4))]).astype(np.int32)
    q = np.array([[60, 60, 60, 60]], np.int32)
    got = list(topk_search.nra(q, np.array([-1]), x, np.arange(len(x)), 20))
    assert [g[2] for g in got] == sorted((x @ q[0]).tolist(), reverse=True)[:20]


def test_toxicity(spark, empty):
    r, bad = random.Random(1), ["trash", "idiot", "scum"]
    rows, labels = [], []
    for i in range(900):
        toxic = i % 6 == 0
        w = [f"w{r.randint(0, 300)}" for _ in range(40)] + ([r.choice(bad).upper() + "!!"] if toxic else [])
        r.shuffle(w)
        rows.append((i, " ".join(w)))
        if r.random() < 0.7:
            labels.append((i, 1, int(toxic)))
    rows += [(5000, None), (5001, ""), (None, "idiot")]
    df, lab = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.train(df, lab)
    got = toxicity.score(df, model, "score").collect()
    held = [x for x in got if x.doc_id is not None and x.doc_id < 900 and zlib.crc32(str(x.doc_id).encode()) % 3 == 1]
    assert len(got) == len(rows) and sum((x.score >= 0.7) == (x.doc_id % 6 == 0) for x in held) / len(held) > 0.95
    assert all(0 <= x.score <= 1 for x in got)
    assert toxicity.score(empty, toxicity.train(empty, lab.limit(0))).count() == 0


def test_non_negative_risk_and_gradient():
    """The risk by its definition, its gradients by finite differences, and a step out of a negative bracket."""
    r = np.random.default_rng(3)
    p, u, w, b, prior = r.integers(0, 2, (7, 4)).astype(float), r.integers(0, 2, (11, 4)).astype(float), r.normal(size=4), 0.3, 0.2
    loss = lambda g, y: math.log(1 + math.exp(-y * g))
    plain = lambda w, b: (prior * sum(loss(x @ w + b, 1) for x in p) / 7, sum(loss(x @ w + b, -1) for x in u) / 11 - prior * sum(loss(x @ w + b, -1) for x in p) / 7)
    positive, bracket, gp, gb = toxicity.risk(w, b, p, u, prior)
    assert (positive, bracket) == pytest.approx(plain(w, b))
    for part, grad in ((0, gp), (1, gb)):
        for k in range(5):
            d = np.zeros(5)
            d[k] = 1e-6
            up, down = plain(w + d[:4], b + d[4])[part], plain(w - d[:4], b - d[4])[part]
            assert grad[k] == pytest.approx((up - down) / 2e-6, abs=1e-6)
    # all unlabelled rows are positives that the prior calls rare: the bracket goes negative and is climbed out of
    ones = np.ones((20, 1))
    w, b = toxicity.nn_pu_fit(ones, ones, 0.9, rounds=400)
    assert toxicity.risk(w, b, ones, ones, 0.9)[1] > -0.05


def test_toxicity_of_repeated_ids_and_clashing_columns(spark):
    """Other columns stay as they are, a score column is replaced, samples keep to their bounds though ids repeat."""
    rows = [(i % 30, f"w{i % 9} " + ("scum" if i % 30 < 8 else "fine"), 0.5, 1, "s") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, score double, toxic int, source string")
    lab = spark.createDataFrame([(i, int(i < 8), None) for i in range(30)] + [(None, 1, None), (3, None, None)], "doc_id long, toxic int, text string")
    model = toxicity.train(df, lab, max_toxic=4, max_unlabelled=5)
    got = toxicity.score(df, model, "score")
    assert got.columns == ["doc_id", "text", "toxic", "source", "score"] and got.count() == 300
    assert got.where("text like '%scum%'").agg({"score": "min"}).first()[0] > got.where("text like '%fine%'").agg({"score": "max"}).first()[0]


def test_toxicity_features_come_from_all_training_rows(spark):
    """A word of 12 toxic documents among 400 is a feature although the fit's sample is small."""
    rows = [(i, f"w{i % 50} w{i % 7}" + (" scum" if i < 400 else "") + (" vermin" if i < 18 else "")) for i in range(2000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    lab = spark.createDataFrame([(i, int(i < 400)) for i in range(2000)], "doc_id long, toxic int")
    model = toxicity.train(df, lab, max_toxic=20, max_unlabelled=60)
    assert set(toxicity._words([b"scum vermin"])[0].tolist()) <= set(model.hashes.tolist())


def test_mixing(docs, empty):
    got = mixing.mix(docs).collect()
    rows = rows_of(docs)
    assert sorted((r.doc_id is None, r.doc_id or 0, r["size"]) for r in got) == sorted((d is None, d or 0, len(words(t))) for d, t in rows)
    by = {}
    for r in got:
        by.setdefault(r.source, []).append(r)
        assert 0 <= r.copies <= 2 and (r["size"] or not r.copies)
    total = sum(r["size"] for r in got)
    assert abs(sum(v[0].target for v in by.values()) - 1.5 * total) < 1e-6 * total
    for v in by.values():
        assert abs(sum(r["size"] * r.copies for r in v) - v[0].target) <= max(r["size"] for r in v) + 1e-6
    again = mixing.mix(docs.repartition(2)).collect()
    assert Counter(again) == Counter(got)
    assert mixing.mix(empty).count() == 0


def test_mixing_expectations_and_nearness(spark):
    """Over many seeds copies average to their rates; every run ends within half the largest document of its targets."""
    r = random.Random(4)
    rows = [(i, "w " * r.choice([1, 2, 5, 9, 30]), f"s{i % 3}", "x", i) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size string, target long").cache()
    sums, n = Counter(), 10
    for seed in range(n):  # each run is a few small jobs
        got = mixing.mix(df, seed=seed).collect()
        for x in got:
            sums[x.doc_id] += x.copies
        for s in {x.source for x in got}:
            own = [x for x in got if x.source == s]
            assert abs(sum(x["size"] * x.copies for x in own) - own[0].target) <= 15 and max(x.copies for x in own) <= 2
    rate = {x.doc_id: min(2.0, x.target / x.source_size) for x in got}
    errors = [abs(sums[d] / n - rate[d]) for d in rate]
    assert sum(errors) / len(errors) < 0.16 and abs(sum(sums.values()) / n - sum(rate.values())) < 4


def plain_targets(sizes, weights=(3, 1, 2)):
    weight = [weights[i % len(weights)] for i in range(len(sizes))]
    out, free, left = [0.0] * len(sizes), set(range(len(sizes))), 1.5 * sum(sizes)
    while free:
        unit = left / sum(weight[i] for i in free)
        over = {i for i in free if unit * weight[i] > 2 * sizes[i]}
        for i in over or free:
            out[i] = 2.0 * sizes[i] if over else unit * weight[i]
        if not over:
            break
        left -= sum(out[i] for i in over)
        free -= over
    return out


@pytest.mark.parametrize("sizes", [[10, 1000, 10], [], [0, 0], [5], list(range(1, 60)), [1, 1000000, 3, 40, 40, 40, 7]])
def test_targets_are_those_of_plain_water_filling(spark, sizes, monkeypatch):
    """Sources in several key ranges, a null one last."""
    monkeypatch.setattr(mixing, "RANKED", 16)
    names = [f"s{i:03}" for i in range(len(sizes))]
    if names:
        names[-1] = None
    df = spark.createDataFrame(list(zip(names, sizes, [1] * len(sizes))), "source string, s long, n long").repartition(3)
    got = {r.source: r.target for r in mixing.targets(df, Scratch(spark, "t")).collect()}
    assert [got[n] for n in names] == pytest.approx(plain_targets(sizes))


def test_url_filter(spark):
    urls = ["https://a.example.org/en/12?x#y", "http://Example.ORG/es/x", "http://example.org", "ftp://notexample.org/es/", "http://x.com/de/1", "http://com/fr/", "nothing", None, "", "://", "http://x.com/fr", "http://a.org/#/es/", "http://x.com/de/1"]
    df = spark.createDataFrame([(i, u, "h", "r") for i, u in enumerate(urls)], "page_id long, url string, host string, rule string")

    def brute(u):
        if not u or "://" not in u:
            return "", "", None, "allow"
        m = re.match(r"([^/?#]*)([^?#]*)", u.split("://", 1)[1], re.S)
        host, path = m[1].lower(), m[2]
        fit = [(len(h + p), h + p, a) for a, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return host, path, max(fit)[1] if fit else None, max(fit)[2] if fit else "allow"

    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(df).collect()}
    assert got == {i: brute(u) for i, u in enumerate(urls)}
    assert url_filter.judge(df.limit(0)).count() == 0


def test_best_fit_decreasing():
    r = random.Random(8)
    for _ in range(30):
        size = r.randint(5, 40)
        lengths = [r.randint(1, size) for _ in range(r.randint(0, 120))]
        free, rows = [], []
        for i in sorted(range(len(lengths)), key=lambda k: (-lengths[k], k)):
            fit = [(f, j) for j, f in enumerate(free) if f >= lengths[i]]
            j = min(fit)[1] if fit else len(free)
            if not fit:
                free.append(size)
            free[j] -= lengths[i]
        rows = packing.best_fit_decreasing(lengths, size)
        assert sorted(i for row in rows for i in row) == list(range(len(lengths)))
        assert sorted(size - sum(lengths[i] for i in row) for row in rows) == sorted(free)


def test_packing_raises_on_ids_that_do_not_fit(spark):
    """Ids above 65,535 don't wrap: they raise with a 16-bit pad and stay as they are with a 32-bit one."""
    ids = np.array([1, 65_537], np.uint32)
    encoded = spark.createDataFrame([(1, 2, bytearray(ids.tobytes()))], "doc_id long, n_tokens int, ids binary")
    with pytest.raises(Exception, match="doesn't fit"):
        packing.pack(encoded, size=4).collect()
    [row] = packing.pack(encoded, size=4, pad=1 << 16).collect()
    assert np.frombuffer(row.ids, np.uint32).tolist() == [1, 65_537, 1 << 16, 1 << 16]


def test_packing_is_lossless(docs, empty):
    encoded = bpe.encode(docs).cache()
    got = packing.pack(encoded, size=64, group_tokens=500).collect()
    back = {}
    for r in got:
        ids = np.frombuffer(r.ids, np.uint16)
        assert len(ids) == 64 and r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens and r.resets == r.cu_seqlens[:-1] and (ids[r.n_tokens :] == packing.PAD).all()
        for d, p, s, a, b in zip(r.doc_ids, r.pieces, r.starts, r.cu_seqlens, r.cu_seqlens[1:]):
            back.setdefault((d, p, s), []).append(ids[a:b].tolist())
    want = {}
    for r in encoded.collect():
        ids = np.frombuffer(r.ids, np.uint32).tolist()
        for k in range(0, len(ids), 64):
            want.setdefault((r.doc_id, k // 64, k), []).append(ids[k : k + 64])
    assert {k: sorted(v) for k, v in back.items()} == {k: sorted(v) for k, v in want.items()}
    assert packing.pack(bpe.encode(empty)).count() == 0
    def pieces(df):
        return Counter((d, s, np.frombuffer(r.ids, np.uint16)[a:b].tobytes()) for r in df.collect() for d, s, a, b in zip(r.doc_ids, r.starts, r.cu_seqlens, r.cu_seqlens[1:]))

    assert pieces(packing.pack_texts(docs, size=64, group_tokens=500)) == pieces(packing.pack(encoded, size=64, group_tokens=500))


def test_packing_spreads_equal_rows(spark):
    ids = bytearray(np.arange(10, dtype=np.uint32).tobytes())
    encoded = spark.createDataFrame([(1, 10, ids)] * 400, "doc_id long, n_tokens int, ids binary").repartition(2)
    got = packing.pack(encoded, size=40, group_tokens=500).groupBy("pack_group").sum("n_tokens").collect()
    assert len(got) == 8 and max(r[1] for r in got) < 1200


def test_encoding_without_a_shuffle():
    enc, known = tiktoken_encoder(), {}
    for ts in ([t or "" for t in texts()], ["", ""], [""], []):
        assert [x.tolist() for x in bpe.encode_here(ts, bpe.vocabulary(), known)] == [enc.encode_ordinary(t) for t in ts]


def test_decoding(docs):
    assert Counter((r.doc_id, bytes(r.decoded)) for r in bpe.decode(bpe.encode(docs)).collect()) == Counter((d, (t or "").encode()) for d, t in rows_of(docs))


def test_clashing_columns_change_nothing(spark):
    """Operators read the columns of their contract; others of the same names as theirs are not met."""
    rows = [(i, t, "k", 7, "p", 1, b"x", 3, "c", 2, 4, 5) for i, t in enumerate(texts())]
    names = "doc_id long, text string, key string, row int, print string, comp int, registers binary, n int, chunk string, shard int, kind int, cid int"
    odd = spark.createDataFrame(rows, names).repartition(3)
    plain = odd.select("doc_id", "text")
    same = lambda f: [Counter(map(str, f(x).collect())) for x in (odd, plain)]
    for f in (near_dedup.near_dedup, bpe.digests, lambda d: lm_scoring.score(d, lm_scoring.train(d)).drop("score"), lambda d: pii.find_pii(d).drop("row"), lambda d: packing.pack_texts(d, size=64, group_tokens=500).selectExpr("explode(arrays_zip(doc_ids, pieces, starts))")):
        a, b = same(f)
        assert a == b


def test_packing_with_clashing_columns(spark):
    encoded = spark.createDataFrame([(1, 2, bytearray(np.array([5, 6], np.uint32).tobytes()), 9, 8, b"z")], "doc_id long, n_tokens int, ids binary, pack_group int, first int, pieces binary")
    [row] = packing.pack(encoded, size=4).collect()
    assert np.frombuffer(row.ids, np.uint16).tolist() == [5, 6, packing.PAD, packing.PAD]


def test_matrices_are_written(spark, tmp_path):
    packed = packing.pack_texts(frame(spark, [(1, "one two three", "en", "s", 1, 1, 1, "k", 1, 1)]), size=8)
    packing.write_matrices(packed, str(tmp_path / "m"))
    back = spark.read.parquet(str(tmp_path / "m")).collect()
    assert [len(r.ids) for r in back] == [16] and back[0].cu_seqlens[-1] == back[0].n_tokens


def test_near_dedup_crowded_buckets(spark, monkeypatch):
    """Members of large buckets are dealt to pairs of large buckets only, so there are no more rows than those met before."""
    r, rows = random.Random(5), []
    base = [f"w{i}" for i in range(120)]
    for i in range(60):
        v = list(base)
        for _ in range(r.randint(0, 6)):
            v[r.randrange(120)] = f"v{r.randint(0, 10**6)}"
        rows.append((i, " ".join(v)))
    counts, table = {}, near_dedup.Scratch.table

    def counted(self, df, name):
        out = table(self, df, name)
        if name in ("left2", "left3"):
            counts[name] = out.count()
        return out

    monkeypatch.setattr(near_dedup.Scratch, "table", counted)
    got = near_dedup.near_dedup(spark.createDataFrame(rows, "doc_id long, text string"), reband=25).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_shingles, r.component_id) for r in got) == brute_near(rows)
    assert 0 < counts["left3"] <= counts["left2"], counts
