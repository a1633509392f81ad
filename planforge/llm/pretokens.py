"""Vectorised splitting of texts into the matches of the public byte-level BPE pattern.

The pattern (``public_tokenizers.PATTERN``) is evaluated on arrays of code points: runs of letters, numbers, other
characters and white space, with the rules for a leading space, trailing white space and English contractions.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import numpy as np

from .common import U64, mix64

LETTER, NUMBER, OTHER, WHITE, END = 0, 1, 2, 3, 4
#: Code points with the White_Space property.
WHITE_SPACE = [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
#: Characters of one segment of the vectorised passes.
SEGMENT = 1 << 18
_P = 0xD6E8FEB86659FD93


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    kinds = {"L": LETTER, "N": NUMBER}
    out = np.fromiter((kinds.get(unicodedata.category(chr(i))[0], OTHER) for i in range(0x110000)), dtype=np.uint8, count=0x110000)
    out[WHITE_SPACE] = WHITE
    return out


@lru_cache(maxsize=1)
def _values() -> np.ndarray:
    return mix64(np.arange(1, 0x110001, dtype=U64) * U64(0x9E3779B97F4A7C15)) | U64(1)


_POWERS: list[np.ndarray] = [np.ones(1, U64), np.ones(1, U64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        size = max(n, SEGMENT + (1 << 16))
        for k, base in enumerate((_P, pow(_P, -1, 1 << 64))):
            p = np.full(size, base, dtype=U64)
            p[0] = 1
            _POWERS[k] = np.multiply.accumulate(p)
    return _POWERS[0], _POWERS[1]


def split_segment(texts: list[str]) -> tuple[str, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(the joined texts, starts and ends of the tokens in it, the tokens' hashes, tokens of each text)."""
    joined = "\0".join(texts) + "\0"
    cp = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    n = len(cp)
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)) + 1
    ends_of_texts = np.cumsum(lengths)
    kind = _classes()[cp]
    kind[ends_of_texts - 1] = END
    edge = np.empty(n + 1, dtype=bool)
    edge[0] = edge[n] = True
    np.not_equal(kind[1:], kind[:-1], out=edge[1:n])
    edge[ends_of_texts - 1] = True
    edge[ends_of_texts] = True
    last = np.flatnonzero((kind[:-1] == WHITE) & (kind[1:] < WHITE))  # last white space before something else
    edge[last] = True
    spaces = last[cp[last] == 0x20]
    edge[spaces + 1] = False
    quote = np.flatnonzero((cp[:-1] == 0x27) & (kind[1:] == LETTER) & edge[:-2 if n > 1 else None][: n - 1])
    if len(quote):
        a = cp[quote + 1]
        b = cp[np.minimum(quote + 2, n - 1)]
        short = (a == ord("s")) | (a == ord("t")) | (a == ord("m")) | (a == ord("d"))
        long = ((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l")))
        edge[quote[short | long] + 1] = False
        edge[quote[short] + 2] = True
        edge[quote[long] + 3] = True
    marks = np.flatnonzero(edge)
    starts, ends = marks[:-1], marks[1:]
    own = kind[starts] != END
    starts, ends = starts[own], ends[own]
    power, inverse = _powers(n)
    total = np.empty(n + 1, dtype=U64)
    total[0] = 0
    np.cumsum(_values()[cp] * power[:n], out=total[1:])
    hashes = mix64((total[ends] - total[starts]) * inverse[starts])
    return joined, starts, ends, hashes, np.bincount(np.searchsorted(ends_of_texts, starts, side="right"), minlength=len(texts))


def split(texts: list[str]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray]:
    """(index of every token's word, the distinct words, tokens of each text, the words' hashes in order)."""
    parts, held, size = [], [], 0
    for i, t in enumerate(texts):
        held.append(t)
        size += len(t) + 1
        if size >= SEGMENT or i == len(texts) - 1:
            parts.append(split_segment(held))
            held, size = [], 0
    if not parts:
        return np.zeros(0, np.int64), [], np.zeros(0, np.int64), np.zeros(0, U64)
    hashes = np.concatenate([p[3] for p in parts])
    distinct, first, index = np.unique(hashes, return_index=True, return_inverse=True)
    offset = np.concatenate([[0], np.cumsum([len(p[3]) for p in parts])])
    words = [""] * len(first)
    order = np.argsort(first, kind="stable")
    at = np.searchsorted(first[order], offset)
    for k, (joined, starts, ends, _, _) in enumerate(parts):
        mine = order[at[k] : at[k + 1]]
        where = first[mine] - offset[k]
        for w, s, e in zip(mine.tolist(), starts[where].tolist(), ends[where].tolist(), strict=True):
            words[w] = joined[s:e]
    return index, words, np.concatenate([p[4] for p in parts]), distinct
