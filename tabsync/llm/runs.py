"""Periodic runs of words, by a suffix automaton whose suffix links are kept as a link-cut tree.

Words are appended one by one. The path from the state of the new prefix to the root is accessed in the tree of suffix links.
It falls into segments whose strings were all last seen ending at one place: the colour of the segment. With the new
end at i, a colour c and a deepest string of length l, the words i-l+1..i and c-l+1..c are equal; where the distance p = i - c is
at most l they overlap or touch, so the last 2p words are a square of period p, and p is the smallest period of it (a smaller one would
have been the colour). The square starts at i - l - p + 1 and is extended to the run around it. The access then gives the whole path the colour i.
Accesses recolour O(n log n) segments in all.

The automaton reads only stretches that can hold a run: of a run with period q, every window of a few words behind the first
period was seen at most q words before, so stretches of such windows, too long for chance, are cut out for every power of
two, with a period before them. The cut is never too narrow (equal hashes only widen it), and ends of runs are sought in the whole text.

A run has a smallest period, at least ``least_length`` words and ``least_exponent`` periods, and no neighbouring word continues it.
Collapsing a text keeps the first period of every run. Null and empty texts have no words: no runs, an empty collapsed text. Every row gives one
row, repeated or not; empty tables give empty ones. Columns of the caller named as the new ones give way to them.
One text is worked on by one task, in memory in proportion to its words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabsync.llm.common import append
from tabsync.llm.words import Words, last_seen, split

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def squares(symbols: list[int]) -> Iterator[tuple[int, int, int]]:
    """(end, period, length of the repeated string) of at least one square per run and of every end in it."""
    follow, link, length = [{}], [-1], [0]
    # The tree of suffix links: splay trees over preferred paths, ancestors to the left. ``seen`` holds at the root of a splay tree.
    left, right, up, seen = [-1], [-1], [-1], [-1]

    def rotate(x: int) -> None:
        p = up[x]
        g = up[p]
        if left[p] == x:
            between = left[p] = right[x]
            right[x] = p
        else:
            between = right[p] = left[x]
            left[x] = p
        if between >= 0:
            up[between] = p
        if g >= 0:
            if left[g] == p:
                left[g] = x
            elif right[g] == p:
                right[g] = x
        up[p], up[x], seen[x] = x, g, seen[p]

    def splay(x: int) -> None:
        while True:
            p = up[x]
            if p < 0 or (left[p] != x and right[p] != x):
                return
            g = up[p]
            if g >= 0 and (left[g] == p or right[g] == p):
                rotate(p if (left[p] == x) == (left[g] == p) else x)
            rotate(x)

    def add(next_states: dict, size: int, parent: int) -> int:
        follow.append(next_states)
        length.append(size)
        link.append(parent)
        for part in (left, right, up, seen):
            part.append(-1)
        return len(follow) - 1

    last = 0
    for i, symbol in enumerate(symbols):
        state = add({}, i + 1, 0)
        p = last
        while p >= 0 and symbol not in follow[p]:
            follow[p][symbol] = state
            p = link[p]
        if p >= 0:
            target = follow[p][symbol]
            if length[target] != length[p] + 1:
                # The shorter strings of the target get a state of their own, on the same path right above it and so of its colour.
                whole, target = target, add(follow[target].copy(), length[p] + 1, link[target])
                splay(whole)
                above = left[target] = left[whole]
                if above >= 0:
                    up[above] = target
                left[whole], up[target], link[whole] = target, whole, target
                while p >= 0 and follow[p].get(symbol) == whole:
                    follow[p][symbol] = target
                    p = link[p]
            link[state] = target
        up[state] = link[state]
        last = below = state
        at = up[state]
        while at >= 0:
            splay(at)
            colour, deeper = seen[at], right[at]
            if deeper >= 0:
                seen[deeper] = colour
            right[at] = below
            if colour >= 0 and i - colour <= length[at]:
                yield i, i - colour, length[at]
            below, at = at, up[at]
        seen[below] = i


def stretches(found: Words, least_length: int, least_exponent: int) -> list[tuple[int, int]]:
    """Parts (first word, end) of the texts, one behind the other, outside which no run lies."""
    more, spans = least_exponent - 1, []

    def cut(places: np.ndarray, least: int, before: int) -> None:
        if len(places):
            breaks = np.flatnonzero(np.diff(places) != 1)
            first, last = places[np.concatenate([[0], breaks + 1])], places[np.concatenate([breaks, [len(places) - 1]])]
            keep = last - first + 1 >= least
            spans.append(np.stack([first[keep] - before, last[keep] + 1], 1))

    places = found.places()
    for period in (1, 2):
        same = np.zeros(len(places), bool)
        same[period:] = (found.ids[period:] == found.ids[:-period]) & (places[period:] >= period)
        cut(np.flatnonzero(same), max(least_length, least_exponent * period) - period, period)
    size = max(1, min(6, 3 * more - 2))
    ends, distances = last_seen(found, size)
    # Behind its first period and a window, a run of period q holds at least ``more`` * q - size + 1 ends of windows seen q words before.
    reach, longest = 4, int(distances.max(initial=0))
    while reach // 2 < longest:
        cut(ends[distances <= reach], max(1, more * (reach // 2 + 1) - size + 1), reach + size)
        reach *= 2
    if not spans:
        return []
    spans = np.concatenate(spans)
    starts = found.starts()[np.searchsorted(found.ends, spans[:, 1] - 1, "right")]
    spans[:, 0] = np.maximum(spans[:, 0], starts)
    joined: list[tuple[int, int]] = []
    own: list[int] = []
    for (first, end), start in sorted(zip(map(tuple, spans.tolist()), starts.tolist(), strict=True)):
        if joined and first < joined[-1][1] and own[-1] == start:
            joined[-1] = (joined[-1][0], max(end, joined[-1][1]))
        else:
            joined.append((first, end))
            own.append(start)
    return joined


def runs_of(found: Words, least_length: int = 6, least_exponent: int = 4) -> list[list[tuple[int, int, int]]]:
    """Runs (start, length, period) of every text, by start and period."""
    out: list[set] = [set() for _ in found.ends]
    starts = found.starts()
    for first, end in stretches(found, least_length, least_exponent):
        text = int(np.searchsorted(found.ends, first, "right"))
        low, high = int(starts[text]), int(found.ends[text])
        ids, known = found.ids[low:high].tolist(), {}
        for i, period, common in squares(ids[first - low:end - low]):
            i += first - low
            if i <= known.get(period, -1):
                continue
            begin, last = i - period - common + 1, i
            while begin > 0 and ids[begin - 1] == ids[begin - 1 + period]:
                begin -= 1
            while last + 1 < high - low and ids[last + 1] == ids[last + 1 - period]:
                last += 1
            known[period] = last
            if last - begin + 1 >= max(least_length, least_exponent * period):
                out[text].add((begin, last - begin + 1, period))
    return [sorted(o, key=lambda r: (r[0], r[2])) for o in out]


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """Words that no run holds behind its first period, joined by one space."""
    gone = np.zeros(len(words), bool)
    for start, length, period in runs:
        gone[start + period:start + length] = True
    return b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g] if runs else words)


def find(df: DataFrame, text_col: str = "text", least_length: int = 6, least_exponent: int = 4, runs: str = "runs",
         collapsed: str = "collapsed") -> DataFrame:
    """``df`` with the runs of each text (array of start, length and period, in words) and the text without their repetitions."""
    if least_length < 2 or least_exponent < 2:
        raise ValueError("a run repeats: at least two words and two periods")

    def make():
        def work(texts):
            found = split([t.encode() for t in texts])
            each = runs_of(found, least_length, least_exponent)
            short = [collapse(found.words[a:b], r) for a, b, r in zip(found.starts(), found.ends, each, strict=True)]
            flat = [r for rs in each for r in rs]
            offsets = np.concatenate([[0], np.cumsum([len(rs) for rs in each])]).astype(np.int32)
            fields = [pa.array([r[j] for r in flat], pa.int64()) for j in range(3)]
            return (pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(fields, fields=list(RUN))),
                    pa.array(short, pa.binary()).cast(pa.string()))

        return work

    return append(df, text_col, f"`{runs}` array<struct<start: bigint, length: bigint, period: bigint>>, `{collapsed}` string", make)


def longest(runs: Column | str) -> Column:
    """The run of greatest length (ties: smallest start, then period) as a struct; null where there is none."""
    best = F.array_max(F.transform(runs, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    return F.when(best.isNotNull(), F.struct((-best["s"]).alias("start"), best["length"].alias("length"), (-best["p"]).alias("period")))


def digest(runs: Column | str) -> Column:
    """sha256 of ``start,length,period`` of every run, each followed by a line feed."""
    lines = F.transform(runs, lambda r: F.concat(F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]), F.lit("\n")))
    return F.sha2(F.array_join(lines, "").cast("binary"), 256)


def words_column(text: Column) -> Column:
    """Words of a text as an array, by the same white space."""
    return F.filter(F.split(text, "[ \\t\\n\\x0B\\f\\r]+"), lambda w: w != "")
