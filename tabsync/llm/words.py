"""Words of many texts at once, as numbers: what the operators on runs and on quality rules share."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


class Words(NamedTuple):
    """``words`` of all texts in order; ``ids`` are their places in ``distinct``; those of text t end before ``ends[t]``."""

    words: list[bytes]
    ids: np.ndarray
    ends: np.ndarray
    distinct: pa.Array

    def starts(self) -> np.ndarray:
        return np.concatenate([[0], self.ends[:-1]]).astype(np.int64)

    def places(self) -> np.ndarray:
        """Place of every word in its own text."""
        sizes = np.diff(self.ends, prepend=0)
        return np.arange(len(self.ids), dtype=np.int64) - np.repeat(self.starts(), sizes)


def split(texts: list[bytes]) -> Words:
    """Words between white space of ASCII (space, tab, line feed, vertical tab, form feed, carriage return)."""
    words, ends = [], np.empty(len(texts), np.int64)
    for t, text in enumerate(texts):
        words += text.split()
        ends[t] = len(words)
    found = pc.dictionary_encode(pa.array(words, pa.large_binary()))
    return Words(words, found.indices.to_numpy(zero_copy_only=False).astype(np.int64), ends, found.dictionary)


def window_hashes(found: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Places at which a window of ``size`` words of one text ends, and a hash of each window; windows of two texts differ
    only by chance, so whoever needs equality of words compares them."""
    ends = np.flatnonzero(found.places() >= size - 1)
    ids, hashes = found.ids.astype(np.uint64) + np.uint64(1), np.zeros(len(ends), np.uint64)
    for back in range(size):
        hashes *= _STEP
        hashes += ids[ends - back]
        hashes ^= hashes >> np.uint64(29)
        hashes *= _MIX
    return ends, hashes


def last_seen(found: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Ends of windows whose hash was seen before in the same text, and how many words before it was seen last."""
    ends, hashes = window_hashes(found, size)
    order = np.argsort(hashes, kind="stable")
    same = hashes[order[1:]] == hashes[order[:-1]]
    later, earlier = ends[order[1:][same]], ends[order[:-1][same]]
    text = np.searchsorted(found.ends, later, "right") == np.searchsorted(found.ends, earlier, "right")
    later, earlier = later[text], earlier[text]
    order = np.argsort(later)
    return later[order], (later - earlier)[order]
