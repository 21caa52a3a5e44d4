"""Benchmark decontamination: one Aho-Corasick automaton over the normalised windows of all items.

Texts become words: A-Z in lower case, every other ASCII character that is no letter or digit a break.
Words are joined by one space, so a window is found as a string with spaces at both ends, in one
scan of the text whatever the number of items. A hit's place in the joined words is mapped back to
word numbers and to characters of the original text.

Nulls and texts without words have no words and no hits; rows are never lost or merged. Items of the
same id share their windows; items without id or words take no part. The automaton holds a block
of items of bounded size (``BLOCK_BYTES``); more items are scanned for in further passes whose hits add up.
"""

from __future__ import annotations

from functools import lru_cache

import ahocorasick
import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabsync.llm.common import LOWER, append
from tabsync.storage import materialise

WINDOW = 10
#: Text bytes of the items in one automaton; it has about ten times as many nodes.
BLOCK_BYTES = 256 << 10
_NORMAL = bytearray(LOWER)
for _b in range(128):
    if not chr(_b).isalnum():
        _NORMAL[_b] = 32
_NORMAL = bytes(_NORMAL)
FOUND = "n_words bigint, spans array<struct<first:bigint,last:bigint,start:bigint,stop:bigint>>, items array<bigint>"


def words(text: str) -> list[bytes]:
    return text.encode().translate(_NORMAL).split()


def windows(text: str, size: int = WINDOW) -> list[bytes]:
    """Windows of an item; one of fewer words is one window."""
    parts = words(text)
    return [b" ".join(parts[i:i + size]) for i in range(max(1, len(parts) - size + 1))] if parts else []


def automaton(items: list[tuple[int, str]], size: int = WINDOW):
    found: dict[bytes, set[int]] = {}
    for item, text in items:
        for w in windows(text, size):
            found.setdefault(w, set()).add(item)
    out = ahocorasick.Automaton()
    for w, ids in found.items():
        out.add_word(f" {w.decode('latin-1')} ", (len(w) + 1, w.count(b" ") + 1, tuple(sorted(ids))))
    out.make_automaton()
    return out


def scan(text: str, search) -> tuple[int, list[tuple[int, int]], list[int]]:
    """Number of words, hit ranges of word numbers (joined where they meet), items found."""
    parts = words(text)
    if not parts or not len(search):
        return len(parts), [], []
    joined = f" {b' '.join(parts).decode('latin-1')} "
    hits = [(end, value) for end, value in search.iter(joined)]
    if not hits:
        return len(parts), [], []
    gaps = np.flatnonzero(np.frombuffer(joined.encode("latin-1"), np.uint8) == 32)  # one before each word and one at the end
    ranges, items = [], set()
    for end, (length, n, ids) in hits:
        first = int(np.searchsorted(gaps, end - length))
        ranges.append((first, first + n - 1))
        items.update(ids)
    return len(parts), join_ranges(ranges), sorted(items)


def join_ranges(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, last in sorted(set(ranges)):
        if out and first <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(out[-1][1], last))
        else:
            out.append((first, last))
    return out


def places(text: str, ranges: list[tuple[int, int]]) -> list[tuple[int, int, int, int]]:
    """Ranges of words with the characters of the original text from the first to behind the last."""
    raw = np.frombuffer(text.encode(), np.uint8)
    inside = np.frombuffer(bytes(raw).translate(_NORMAL), np.uint8) != 32
    edges = np.flatnonzero(np.diff(inside.astype(np.int8), prepend=0, append=0))
    chars = np.append(0, np.cumsum(raw & 0xC0 != 0x80))  # characters before each byte
    return [(a, b, int(chars[edges[2 * a]]), int(chars[edges[2 * b + 1]])) for a, b in ranges]



@lru_cache(4)
def _automaton_of(items: tuple, size: int):
    return automaton(list(items), size)


def find(df: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
         size: int = WINDOW) -> DataFrame:
    """``df`` with n_words, spans (word and character ranges of hits) and items (ids with a window in the text)."""
    rows = benchmark.where(F.col(item_col).isNotNull() & F.col(item_text).isNotNull()).select(
        F.col(item_col).cast("bigint").alias("__item"), F.col(item_text).alias("__text"))
    total = rows.agg(F.sum(F.octet_length("__text"))).first()[0] or 0
    blocks = -(-total // BLOCK_BYTES) or 1
    out = df
    for k in range(blocks):
        block = tuple((r[0], r[1]) for r in rows.where(F.pmod(F.xxhash64("__text"), F.lit(blocks)) == k).distinct().collect())

        def make(block=block):
            search = _automaton_of(block, size)

            def run(texts):
                found = [scan(t, search) for t in texts]
                spans = [[dict(zip(("first", "last", "start", "stop"), p)) for p in places(t, r)] if r else [] for t, (_, r, _) in zip(texts, found)]
                return [n for n, _, _ in found], spans, [i for _, _, i in found]
            return run
        if k == 0:
            out = append(out, text_col, FOUND, make)
            continue
        before = out.withColumnsRenamed({"spans": "__spans", "items": "__items"})
        after = append(materialise(before, "decontaminate"), text_col, FOUND, make)
        out = after.withColumns({"spans": F.array_union("__spans", "spans"), "items": F.array_sort(F.array_union("__items", "items"))}
                                ).drop("__spans", "__items")
    return out


def n_hit(spans: list) -> int:
    """Words inside any span; spans of several passes may overlap."""
    return sum(b - a + 1 for a, b in join_ranges([(s["first"], s["last"]) for s in spans]))


def hit_words(column: str = "spans"):
    """:func:`n_hit` as an expression: sorted spans, each counted from behind the furthest word before it."""
    start = F.struct(F.lit(-1).cast("bigint").alias("end"), F.lit(0).cast("bigint").alias("n"))
    step = lambda acc, s: F.struct(F.greatest(acc["end"], s["last"]).alias("end"),
                                   (acc["n"] + F.greatest(F.lit(0).cast("bigint"), s["last"] - F.greatest(acc["end"], s["first"] - 1))).alias("n"))
    return F.aggregate(F.array_sort(column), start, step, lambda acc: acc["n"])


def items_digest(column: str = "items"):
    """sha256 of the item ids as text, sorted as text, joined by commas."""
    return F.sha2(F.array_join(F.array_sort(F.transform(column, lambda i: i.cast("string"))), ",").cast("binary"), 256)
