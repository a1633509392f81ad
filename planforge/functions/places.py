"""Index of the places of fixed words in texts, as column expressions: one scan of a text, after which every question about
a word is a filter of a short array.

A place is (at, word): characters before it, and the longest of the words that begins there.  A shorter word begins
there too if the longer one begins with it, so ``of`` finds words by their beginning.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

PLACES = "array<struct<at:int,word:string>>"
#: Characters before a hint and behind its end that belong to it.
BEFORE, AFTER = 80, 800


def _any(words: Iterable[str]) -> str:
    every = sorted(set(words), key=lambda w: (-len(w), w))
    first = "".join(sorted({re.escape(w[0]) for w in every}))
    return f"(?=[{first}])(?:{'|'.join(rf'{chr(92)}Q{w}{chr(92)}E' for w in every)})"


def places(text: Column, words: Iterable[str]) -> Column:
    """Places of the words in a text, in its order."""
    words = tuple(words)
    any_word, longest = _any(words), max(map(len, words))

    def step(found: Column, part: Column) -> Column:
        word = F.regexp_extract(F.substring(text, found["at"] + 1, F.lit(longest)), f"^{any_word}", 0)
        here = F.struct(found["at"].alias("at"), word.alias("word"))
        return F.struct((found["at"] + F.length(part)).alias("at"), F.when(word == "", found["found"]).otherwise(F.concat(found["found"], F.array(here))).alias("found"))

    # parts begin where a word does; a text that begins with one has no empty part before it
    parts = F.split(text, f"(?={any_word})", -1)
    return F.aggregate(parts, F.struct(F.lit(0).alias("at"), F.array().cast(PLACES).alias("found")), step)["found"]


def indexed(sources: Column, words: Iterable[str]) -> Column:
    """``sources`` (source_path, text) with the places of the words in each text."""
    words = tuple(words)
    return F.transform(sources, lambda s: F.struct(s["source_path"].alias("source_path"), s["text"].alias("text"), places(s["text"], words).alias("places")))


def words(texts: Iterable[str]) -> Column:
    return F.array(*[F.lit(t) for t in texts])


def of(found: Column, word: Column) -> Column:
    return F.filter(found, lambda p: F.startswith(p["word"], word))


def around(sources: Column, hints: Column) -> Column:
    """array<struct<source_path,section_hint,snippet,places>>: the text around every occurrence of a hint, by source, then
    hint, then place; places in it, from its start, with their words whole."""

    def snippet(s: Column, hint: Column) -> Callable[[Column], Column]:
        def one(p: Column) -> Column:
            start = F.greatest(p["at"] - BEFORE, F.lit(0))
            end = p["at"] + F.length(hint) + AFTER
            inside = F.filter(s["places"], lambda q: (q["at"] >= start) & (q["at"] < end))
            return F.struct(s["source_path"].alias("source_path"), hint.alias("section_hint"), F.substring(s["text"], start + 1, end - start).alias("snippet"), F.transform(inside, lambda q: F.struct((q["at"] - start).alias("at"), q["word"].alias("word"))).alias("places"))

        return one

    return F.flatten(F.transform(sources, lambda s: F.flatten(F.transform(hints, lambda h: F.transform(of(s["places"], h), snippet(s, h))))))


def first(found: Column) -> Column:
    """The first element, null of an empty array."""
    return F.try_element_at(found, F.lit(1))


def _behind(s: Column, word: Column) -> Column:
    """array<string>: what stands in a snippet behind each whole occurrence of the word."""
    whole = F.filter(of(s["places"], word), lambda p: p["at"] + F.length(word) <= F.length(s["snippet"]))
    return F.transform(whole, lambda p: F.substring(s["snippet"], p["at"] + 1 + F.length(word), F.length(s["snippet"])))


def numbered(s: Column, keywords: Column) -> Column:
    """The first keyword, in the given order, that a number follows in the snippet, as written with its number; else null."""

    def of_word(w: Column) -> Column:
        tail = F.filter(F.transform(_behind(s, w), lambda t: F.regexp_extract(t, r"(?U)^\s*[:：]?\s*\d+", 0)), lambda x: x != "")
        return F.concat(w, first(tail))

    return first(F.array_compact(F.transform(keywords, of_word)))


def labelled(s: Column, labels: Column, with_value: Column) -> Column:
    """What follows the first occurrence of the first label that the snippet has (and, where ``with_value``, that something
    follows), up to the clause's end; null without one."""

    def of_label(label: Column) -> Column:
        value = F.regexp_replace(F.regexp_extract(first(_behind(s, label)), r"(?U)^\s*[:：]?\s*([^\n\r；。]*)", 1), r"(?U)^\s+|\s+\z", "")
        return F.when((value != "") | ~with_value, value)

    return first(F.array_compact(F.transform(labels, of_label)))


def first_found(snippets: Column, probe: Callable[[Column], Column]) -> Column:
    """(source_path, section_hint, raw_value, snippet) of the first snippet for which the probe gives a value; else null."""
    hit = F.transform(snippets, lambda s: F.struct(s["source_path"].alias("source_path"), s["section_hint"].alias("section_hint"), probe(s).alias("raw_value"), F.substring(s["snippet"], 1, 500).alias("snippet")))
    return first(F.filter(hit, lambda x: x["raw_value"].isNotNull()))
