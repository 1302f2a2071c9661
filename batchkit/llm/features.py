"""Hashed features of texts, as sorted indexes into a table of fixed size."""

from __future__ import annotations

import numpy as np

from batchkit.llm.common import WordHashes, mix

_U = np.uint64


def word_grams(h: np.ndarray, bits: int, skips: tuple[int, ...] = (1, 2)) -> np.ndarray:
    """Distinct indexes of the words, of the pairs of neighbours and of the pairs that leave out ``skips`` words between."""
    parts = [h]
    for k, gap in enumerate((0, *skips)):
        if len(h) > gap + 1:
            parts.append((h[:-gap - 1] * _U(0x9E3779B97F4A7C15)) ^ (h[gap + 1:] + _U(k + 1)))
    return np.unique((mix(np.concatenate(parts)) >> _U(64 - bits)).astype(np.int64))


#: Class of a byte: letters by case, digits, white space and line ends apart, other ASCII signs by a few groups, the rest as letters.
_SHAPE = np.full(256, 1, np.uint8)
for _c in range(128):
    _ch = chr(_c)
    _SHAPE[_c] = (1 if _ch.islower() else 2 if _ch.isupper() else 3 if _ch.isdigit() else 4 if _ch in " \t" else 5 if _ch in "\r\n" else
                  6 if _ch in ".,;:" else 7 if _ch in "!?" else 8 if _ch in "'\"-()" else 9 if _ch in "|" else 10 if _ch in "*#$%&" else
                  11 if _ch in "@/_=+" else 12 if _ch in "<>[]{}\\^~`" else 13)
SHAPE_TERMS = 14 ** 3
#: Further terms: repeats of a word at a distance of 1 to 3 words, of rarer distances, and the length of words and lines by powers of two.
TERMS = SHAPE_TERMS + 64


def shape_terms(text: str | None, h: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(indexes, weights) of a text's terms, given its words' hashes and lengths: runs of three byte classes, repeated words, lengths; weights 1 + ln(count)."""
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    counts = np.zeros(TERMS, np.int64)
    if len(raw) >= 3:
        c = _SHAPE[raw].astype(np.int32)
        counts[:SHAPE_TERMS] = np.bincount((c[:-2] * 14 + c[1:-1]) * 14 + c[2:], minlength=SHAPE_TERMS)[:SHAPE_TERMS]
    n = len(h)
    if n:
        for gap in (1, 2, 3):
            if n > gap:
                counts[SHAPE_TERMS + gap] = int((h[gap:] == h[:-gap]).sum()) * 4
        distinct = len(np.unique(h)) / n
        counts[SHAPE_TERMS + 8 + int(distinct * 7.99)] = n
        sizes = np.minimum(np.log2(lengths).astype(np.int64), 7)
        counts[SHAPE_TERMS + 16:SHAPE_TERMS + 24] = np.bincount(sizes, minlength=8)
    at = np.flatnonzero(counts)
    return at, (1 + np.log(counts[at])).astype(np.float32)


def all_shape_terms(texts: list[str | None], words: WordHashes) -> list[tuple[np.ndarray, np.ndarray]]:
    """:func:`shape_terms` of each text."""
    return [shape_terms(t, h, n) for t, (h, n) in zip(texts, words.many(texts), strict=True)]
