"""Text functions that need Python: sections by title, snippets around words, label pairs, name normal form."""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Callable, Iterable
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column

from .. import config
from .udf import vectorised

SNIPPET = "array<struct<hint:string,start:int,snippet:string>>"
#: Titles that end a section.
TITLES = ("课程基本信息", "课程中文简介", "课程英文简介", "课程目标", "思政目标", "能力目标", "知识目标", "预备知识要求", "教学内容", "教学安排", "课程要求", "教材及阅读材料", "考核方式及成绩构成", "考核方式")
_SUFFIX = r"(?:[与及和、][^\n]{0,12})?"


def course_name(text: object, english: bool = False) -> str:
    """Comparable form of a course name: NFKC, no zero-width characters, one kind of bracket and comma, spaces squeezed."""
    t = re.sub("[​-‍﻿]", "", unicodedata.normalize("NFKC", str(text or "")))
    t = t.strip().strip("《》<> ").translate(str.maketrans("（）［］【】，、", "()[][],,"))
    t = re.sub(r"\s*([,;:()\[\]/&+\-])\s*", r"\1", re.sub(r"\s+", " ", t).strip())
    return t.casefold() if english else t


@vectorised("string")
def normal_name(values: pd.Series) -> pd.Series:
    return values.map(course_name)


@vectorised("string")
def normal_english_name(values: pd.Series) -> pd.Series:
    return values.map(lambda v: course_name(v, True))


def find_snippets(text: str | None, hints: Iterable[str], before: int = 80, after: int = 800, cap: int | None = None, accept: Callable[[str], bool] | None = None, distinct: bool = False) -> list[tuple[str, int, str]]:
    """(hint, start, snippet) around each occurrence, by hint, then place."""
    out, seen = [], set()
    for hint in hints:
        at = (text or "").find(hint)
        while at >= 0 and (cap is None or len(out) < cap):
            start = max(0, at - before)
            piece = text[start : at + len(hint) + after]
            if not (distinct and start in seen) and (accept is None or accept(piece)):
                seen.add(start)
                out.append((hint, start, piece))
            at = text.find(hint, at + len(hint))
    return out


def snippets(c: Column, hints: Iterable[str], before: int = 80, after: int = 800) -> Column:
    """Context around every hint."""
    hints = list(hints)

    @vectorised(SNIPPET)
    def run(values: pd.Series) -> pd.Series:
        return values.map(lambda v: [dict(hint=h, start=s, snippet=p) for h, s, p in find_snippets(v, hints, before, after)])

    return run(c)


def segments(c: Column, words: Iterable[str], window: int = 320, cap: int = 12) -> Column:
    """At most ``cap`` compacted segments around keywords, distinct by start."""
    words = list(words)

    @vectorised("array<string>")
    def run(values: pd.Series) -> pd.Series:
        return values.map(lambda v: [" ".join(p.split()) for _, _, p in find_snippets(v, words, window, window, cap, distinct=True)])

    return run(c)


def page_segments(pages: Column, words: Iterable[str], window: int = 260, cap: int = 12) -> Column:
    """array<struct<page,keyword,text>>: compacted text around keywords, page by page, distinct by page, start and keyword."""
    words = list(words)

    @vectorised("array<struct<page:int,keyword:string,text:string>>")
    def run(values: pd.Series) -> pd.Series:
        def one(pages: Iterable[str]) -> list[dict]:
            out = []
            for i, page in enumerate(pages if pages is not None else []):
                out += [{"page": i, "keyword": k, "text": t} for k, _, p in find_snippets(page, words, window, window, cap - len(out)) if (t := " ".join(p.split()))]
            return out[:cap]

        return values.map(one)

    return run(pages)


def source_segments(sources: Column, hints: Iterable[str], words: Iterable[str], window: int = 320, cap: int = 12) -> Column:
    """array<struct<source_path,section_hint,text>>: first the text around hints that has one of the words, then that
    around the words themselves; distinct, at most ``cap``."""
    hints, words = list(hints), list(words)

    @vectorised("array<struct<source_path:string,section_hint:string,text:string>>")
    def run(values: pd.Series) -> pd.Series:
        def one(sources: Iterable[dict]) -> list[dict]:
            found: dict[tuple, None] = {}
            for marks, accept in ((hints, lambda p: any(w in p for w in words)), (words, None)):
                for s in sources if sources is not None else []:
                    for hint, _, piece in find_snippets(s["text"], marks, window, window, accept=accept, distinct=True):
                        found.setdefault((s["source_path"], hint, " ".join(piece.split())))
                        if len(found) >= cap:
                            break
            return [dict(zip(("source_path", "section_hint", "text"), f, strict=True)) for f in list(found)[:cap]]

        return values.map(one)

    return run(sources)


def title_pattern(titles: Iterable[str]) -> re.Pattern:
    return _title_pattern(tuple(titles))


@lru_cache(maxsize=256)
def _title_pattern(titles: tuple[str, ...]) -> re.Pattern:
    """A line that is one of the titles alone, with numbering before it."""
    return re.compile(rf"(?m)^[ \t#]*{config.TITLE_PREFIX}(?:{'|'.join(map(re.escape, sorted(titles, key=len, reverse=True)))}){_SUFFIX}[ \t]*[:：]?[ \t]*$")


def section(text: str | None, titles: Iterable[str], stops: Iterable[str] = TITLES, last: bool = False) -> str:
    """Body after the first (or last) of the titles, up to the nearest other title."""
    text, titles = text or "", tuple(titles)
    if not any(t in text for t in titles):
        return ""
    heads = list(title_pattern(titles).finditer(text))
    if not heads:
        return ""
    begin = heads[-1 if last else 0].end()
    stop = title_pattern([s for s in stops if s not in titles]).search(text, begin)
    return text[begin : stop.start() if stop else len(text)].strip()


def section_column(c: Column, titles: Iterable[str], stops: Iterable[str] = TITLES) -> Column:
    titles, stops = tuple(titles), tuple(stops)

    @vectorised("string")
    def run(values: pd.Series) -> pd.Series:
        return values.map(lambda v: section(v, titles, stops))

    return run(c)


_BODY = ("教学内容", "教学安排", "课程要求", "课程目标")


def assessment_section(text: str | None) -> str:
    """The last section on assessment; its title counts with a number before it, in full, or after a section of the body."""
    text, best = text or "", ""
    for m in re.finditer(r"(?m)^[ \t#]*((?:[（(]?[一二三四五六七八九十0-9]+[）)]\s*[、.．-]?|[一二三四五六七八九十0-9]+\s*[、.．])?)\s*(考核方式及成绩构成|考核方式与成绩构成|考核方式|成绩构成)[ \t]*[:：]?", text):
        body_before = bool(title_pattern(_BODY).search(text[: m.start()]))
        if m[1].strip() or "成绩构成" in m[2] or body_before:
            stop = title_pattern([t for t in TITLES if "考核" not in t]).search(text, m.end())
            best = text[m.end() : stop.start() if stop else len(text)].strip() or best
    return best


@vectorised("string")
def assessment_section_column(values: pd.Series) -> pd.Series:
    return values.map(assessment_section)


_ANCHORS = [(re.compile(p), title) for p, title in config.ANCHORS]
_FIELDS = [(re.compile(p, re.S), field) for p, field in config.FIELD_PATTERNS]


def with_anchors(text: str | None) -> str:
    """Section titles on lines of their own, once for each pattern."""
    text = text or ""
    for pattern, title in _ANCHORS:
        if pattern.search(text):
            text = pattern.sub(lambda m, t=title: f"\n{m[0]}\n" if t else m[0], text, count=1)
    return text


def fill_fields(data: dict[str, str], text: str | None) -> dict[str, str]:
    """Blank fields filled by the first pattern that finds them."""
    out = dict(data)
    for pattern, field in _FIELDS:
        if not (out.get(field) or "").strip() and (m := pattern.search(text or "")) and m[1].strip():
            out[field] = m[1].strip()
    return out


def markdown_section(text: str | None, name: str) -> str:
    """The ``## `` part whose title holds, or is held by, the name."""
    for part in re.split(r"(?m)(?=^##\s)", text or ""):
        head, _, body = part.partition("\n")
        title = re.sub(r"[\s#（）()一二三四五六七八九十、.．0-9]", "", head)
        if head.startswith("##") and title and (name in title or title in name):
            return body
    return ""


def markdown_part(c: Column, name: str) -> Column:
    return vectorised("string")(lambda values: values.map(lambda v: markdown_section(v, name)))(c)


@vectorised("string")
def anchored(values: pd.Series) -> pd.Series:
    return values.map(with_anchors)


@vectorised("map<string,string>")
def text_fields(values: pd.Series) -> pd.Series:
    """Fields that patterns find in a text."""
    return values.map(lambda v: fill_fields({}, v))


def flexible(label: str) -> re.Pattern:
    """The label with any white space between its characters."""
    return re.compile(r"\s*".join(map(re.escape, label)))


@lru_cache(maxsize=64)
def _any_label(labels: tuple[str, ...]) -> tuple[list[str], re.Pattern]:
    """The labels, longest first, and a pattern of all, whose groups are their places."""
    ordered = sorted(labels, key=len, reverse=True)
    return ordered, re.compile("|".join(f"(?P<l{i}>{flexible(x).pattern})" for i, x in enumerate(ordered)))


def has_label(cells: Iterable[str | None], labels: Iterable[str]) -> bool:
    """Whether ``label_pairs`` can find anything in the cells: most tables have no label at all."""
    return bool(_any_label(tuple(labels))[1].search("\0".join(c for c in cells if c)))


def label_pairs(cells: Iterable[str | None], labels: Iterable[str]) -> list[tuple[str, str]]:
    """(label, value) of a row: labels in cells of their own take the next cell, glued ones the rest of theirs."""
    labels, out, cells = tuple(labels), [], [(c or "").strip() for c in cells]
    if not labels:
        return out
    labels, any_label = _any_label(labels)
    waiting = None
    for cell in cells:
        hits = list(any_label.finditer(cell)) if len(cell) > 1 else []
        if not hits or hits[0].start():
            if waiting and cell:
                out.append((waiting, cell[: hits[0].start()].strip(" :：") if hits else cell))
                waiting = None
            if not hits:
                continue
        for m, nxt in zip(hits, [*hits[1:], None], strict=True):
            if waiting:
                out.append((waiting, ""))
            label = labels[int(m.lastgroup[1:])]
            value = cell[m.end() : nxt.start() if nxt else len(cell)].strip(" :：\n\t")
            waiting = None if value else label
            if value:
                out.append((label, value))
    return out + ([(waiting, "")] if waiting else [])


def sanitise(value: object, path: str = "") -> tuple[object, list[str]]:
    """A JSON value without control characters, and the paths that changed."""
    if isinstance(value, str):
        clean = re.sub(r"[\x00-\x08\x0b\x0c\x0e-\x1f]", "", value)
        return clean, [path] if clean != value else []
    if isinstance(value, dict):
        pairs = {k: sanitise(v, f"{path}.{k}" if path else str(k)) for k, v in value.items()}
    elif isinstance(value, list):
        pairs = {i: sanitise(v, f"{path}[{i}]") for i, v in enumerate(value)}
    else:
        return value, []
    paths = [p for _, ps in pairs.values() for p in ps]
    return ({k: v for k, (v, _) in pairs.items()} if isinstance(value, dict) else [v for v, _ in pairs.values()]), paths


@vectorised("struct<json:string,paths:array<string>>")
def sanitised(values: pd.Series) -> pd.DataFrame:
    """JSON without control characters in its strings, and the paths that changed; null for null."""
    out = [(None, None) if v is None else sanitise(json.loads(v)) for v in values]
    return pd.DataFrame({"json": [None if p is None else json.dumps(j, ensure_ascii=False) for j, p in out], "paths": [p for _, p in out]})
