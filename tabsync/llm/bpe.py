"""Byte-level BPE without regular expressions: pieces are found by scanning transition functions.

Every code point gets a class from a table (letter, number, white space, other); white space and
apostrophes are told apart by the classes that follow them. A small automaton over these classes
marks where pieces begin. Its transition functions are closed under composition and few, so each is
a number and composing two is one table look-up. As composition is associative, the scan runs over
blocks side by side: compose each block, scan the blocks, then replay all blocks with their start
states. Pieces are slices of the text; a cache maps each to its ids, and new ones are merged by rank.

Nulls are empty texts; an empty text has no ids. Every row gives one row, repeated ones too.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import unicodedata
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tabsync.llm.common import append

# Classes: letter, number, other, apostrophe before a one-letter ending, before a two-letter ending,
# space before text, other white space before text, white space before white space or the end, end of text.
L, N, P, A1, A2, SP, WS, W, END = range(9)
CLASSES = 9
# States: nothing open, after a joining space, in letters, numbers, others, white space, 1 or 2 letters of an ending to come.
NONE, JOIN, IN_L, IN_N, IN_P, IN_W, END1, END2 = range(8)
STATES = 8
CACHED = 100_000
#: Bytes of text that are encoded at once; numbers of Python take many times the room of the text.
ENCODED = 256 << 10
SHIFT, NO_RANK = 22, 1 << 40
#: Beyond this many bytes a piece is merged with a heap, whose cost is n log n.
LONG = 64


def _step(state: int, kind: int) -> tuple[int, bool]:
    """Next state, and whether a piece begins here."""
    joins = {(JOIN, L): IN_L, (JOIN, N): IN_N, (JOIN, P): IN_P, (JOIN, A1): IN_P, (JOIN, A2): IN_P,
             (IN_L, L): IN_L, (IN_N, N): IN_N, (IN_P, P): IN_P, (IN_P, A1): IN_P, (IN_P, A2): IN_P, (IN_W, W): IN_W,
             (END1, L): NONE, (END2, L): END1}
    if (state, kind) in joins:
        return joins[state, kind], False
    return {L: IN_L, N: IN_N, P: IN_P, A1: END1, A2: END2, SP: JOIN, WS: NONE, W: IN_W, END: NONE}[kind], True


@lru_cache(1)
def _tables():
    """Next states and beginnings by (state, class), the function number of each class, the composition table, functions."""
    following = np.array([[_step(s, c)[0] for c in range(CLASSES)] for s in range(STATES)], np.uint8)
    begins = np.array([[_step(s, c)[1] for c in range(CLASSES)] for s in range(STATES)], bool)
    known = {tuple(range(STATES)): 0}
    of_class = [known.setdefault(tuple(int(x) for x in following[:, c]), len(known)) for c in range(CLASSES)]
    work = list(known)
    while work:  # close under composition with the classes' functions
        f = work.pop()
        for c in range(CLASSES):
            g = tuple(int(following[s, c]) for s in f)
            if g not in known:
                known[g] = len(known)
                work.append(g)
    functions = list(known)
    compose = np.array([[known[tuple(g[s] for s in f)] for g in functions] for f in functions], np.uint16)
    return following.ravel(), begins.ravel(), np.array(of_class, np.uint16), compose, np.array(functions, np.uint8)


@lru_cache(1)
def _code_points() -> np.ndarray:
    """Class of every code point, before looking at what follows."""
    kinds = np.full(0x110000, P, np.uint8)
    for cp in range(0x110000):
        major = unicodedata.category(chr(cp))[0]
        if major in "LN":
            kinds[cp] = L if major == "L" else N
    kinds[[*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]] = W
    return kinds


def _classes(cps: np.ndarray, ends: np.ndarray) -> np.ndarray:
    kinds = _code_points()[cps]
    kinds[ends] = END
    following = np.append(kinds[1:], np.uint8(END))
    last = (kinds == W) & (following != W) & (following != END)
    marks = np.flatnonzero(cps == 0x27)
    if len(marks):
        near = np.append(cps, np.zeros(2, cps.dtype))
        one, two = near[marks + 1], near[marks + 2]
        kinds[marks[np.isin(one, [ord(x) for x in "stmd"])]] = A1
        pairs = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
        kinds[marks[pairs]] = A2
    kinds[last] = np.where(cps[last] == 0x20, SP, WS)
    return kinds


def _start_states(functions: np.ndarray) -> np.ndarray:
    """State before each of these functions when they run in order from NONE (a scan by composition)."""
    _, _, _, compose, table = _tables()
    n, width = len(functions), 128
    if n <= width:
        out, state = np.empty(n, np.uint8), NONE
        for i, f in enumerate(functions.tolist()):
            out[i], state = state, table[f, state]
        return out
    rows = -(-n // width)
    blocks = np.zeros(rows * width, np.uint16)  # function 0 is the identity
    blocks[:n] = functions
    blocks = blocks.reshape(rows, width)
    whole = blocks[:, 0]
    for j in range(1, width):
        whole = compose[whole, blocks[:, j]]
    states, out = _start_states(whole), np.empty((rows, width), np.uint8)
    for j in range(width):
        out[:, j] = states
        states = table[blocks[:, j], states]
    return out.ravel()[:n]


def _beginnings(kinds: np.ndarray) -> np.ndarray:
    """Places where a piece begins."""
    following, begins, of_class, compose, _ = _tables()
    n, width = len(kinds), 256
    rows = -(-n // width)
    blocks = np.full(rows * width, END, np.uint8)
    blocks[:n] = kinds
    blocks = np.ascontiguousarray(blocks.reshape(rows, width).T)
    flat, size = compose.ravel(), compose.shape[0]
    whole = of_class[blocks[0]].astype(np.intp)
    for j in range(1, width):
        whole = flat[whole * size + of_class[blocks[j]]].astype(np.intp)
    states, found = _start_states(whole.astype(np.uint16)), np.empty((width, rows), bool)
    for j in range(width):
        at = states * np.uint8(CLASSES) + blocks[j]
        found[j], states = begins[at], following[at]
    return np.flatnonzero(found.T.ravel()[:n])


def pieces(texts: list[str]) -> tuple[list[str], np.ndarray]:
    """Pieces of all texts in order, and how many of them each text has."""
    joined = "\0".join(texts) + "\0"
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1) - 1
    cps = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    starts = _beginnings(_classes(cps, ends))
    marks = np.searchsorted(starts, ends)  # the end of a text always begins a piece
    bounds = np.append(starts, len(cps))
    keep = np.ones(len(starts), bool)
    keep[marks] = False
    found = [joined[a:b] for a, b in zip(bounds[:-1][keep].tolist(), bounds[1:][keep].tolist())]
    return found, np.diff(marks, prepend=-1) - 1


class Merges:
    """Ranks of a file, with a sorted table of which two ids make which one."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.bytes_of = ranks, {i: b for b, i in ranks.items()}
        made = {ranks[t[:i]] << SHIFT | ranks[t[i:]]: r for t, r in ranks.items() for i in range(1, len(t))
                if t[:i] in ranks and t[i:] in ranks}
        self.codes = np.array(sorted(made), np.int64)
        self.made = np.array([made[c] for c in self.codes.tolist()], np.int64)
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int64)

    def made_by(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        code = left << SHIFT | right
        at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        return np.where(self.codes[at] == code, self.made[at], NO_RANK)


def merge(parts: list[bytes], merges: Merges) -> list[tuple[int, ...]]:
    """Ids of each piece, all pieces side by side.

    A piece that is in the file is one id. In others, in every round, the neighbouring pair of lowest
    rank becomes one, the leftmost first, until no pair makes anything.
    """
    out: list = [merges.ranks.get(p) for p in parts]
    out = [(i,) if i is not None else _merge_long(p, merges.ranks) if len(p) > LONG else None for i, p in zip(out, parts)]
    todo = [i for i, ids in enumerate(out) if ids is None]
    if not todo:
        return out
    sizes = np.fromiter((len(parts[i]) for i in todo), np.int64, len(todo))
    ids = merges.byte_ids[np.frombuffer(b"".join(parts[i] for i in todo), np.uint8)]
    owner = np.repeat(np.array(todo), sizes)
    rank = np.full(len(ids), NO_RANK)
    inner = np.flatnonzero(owner[:-1] == owner[1:])
    rank[inner] = merges.made_by(ids[inner], ids[inner + 1])
    while len(ids):
        first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        sizes = np.diff(np.append(first, len(ids)))
        best = np.minimum.reduceat(rank, first)
        done = best == NO_RANK
        if done.any():  # these pieces are ready
            flat, which = ids[np.repeat(done, sizes)].tolist(), owner[first[done]].tolist()
            ends = np.cumsum(sizes[done]).tolist()
            for i, a, b in zip(which, [0, *ends], ends):
                out[i] = tuple(flat[a:b])
            stay = np.repeat(~done, sizes)
            ids, owner, rank, sizes, best = ids[stay], owner[stay], rank[stay], sizes[~done], best[~done]
            if not len(ids):
                break
        low = np.flatnonzero(rank == np.repeat(best, sizes))
        at = low[np.append(True, owner[low[1:]] != owner[low[:-1]])]
        ids[at] = best  # an id is the rank of its bytes
        stay = np.ones(len(ids), bool)
        stay[at + 1] = False
        rank[at] = NO_RANK
        ids, owner, rank = ids[stay], owner[stay], rank[stay]
        at -= np.arange(len(at))
        for i in (at, at[at > 0] - 1):
            i = i[i + 1 < len(ids)]
            i = i[owner[i] == owner[i + 1]]
            rank[i] = merges.made_by(ids[i], ids[i + 1])
    return out


def _merge_long(piece: bytes, ranks: dict[bytes, int]) -> tuple[int, ...]:
    n = len(piece)
    stop, after, before = list(range(1, n + 1)), list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i:i + 2])) is not None]
    heapq.heapify(heap)
    alive = [True] * n
    while heap:
        _, i, end = heapq.heappop(heap)
        j = after[i]
        if not alive[i] or j >= n or stop[j] != end:
            continue
        stop[i], after[i], alive[j] = end, after[j], False
        if after[i] < n:
            before[after[i]] = i
            if (r := ranks.get(piece[i:stop[after[i]]])) is not None:
                heapq.heappush(heap, (r, i, stop[after[i]]))
        if (p := before[i]) >= 0 and (r := ranks.get(piece[p:end])) is not None:
            heapq.heappush(heap, (r, p, end))
    return tuple(ranks[piece[i:stop[i]]] for i in range(n) if alive[i])


@lru_cache(4)
def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Codec(dict):
    """Cache from a piece to its ids; emptied when full, so its size is bounded."""

    def __init__(self, path: str):
        super().__init__()
        self.merges = Merges(load_ranks(path))
        self.bytes_of = self.merges.bytes_of

    def _learn(self, found: list[str]) -> None:
        new = [p for p in dict.fromkeys(found) if p not in self]
        if len(self) + len(new) > CACHED:
            self.clear()
            new = list(dict.fromkeys(found))
        self.update(zip(new, merge([p.encode() for p in new], self.merges)))

    def encode(self, texts: list[str]) -> list[list[int]]:
        found, counts = pieces(texts)
        self._learn(found)
        encoded, out, at = list(map(self.__getitem__, found)), [], 0
        for n in counts.tolist():
            out.append(list(chain.from_iterable(encoded[at:at + n])))
            at += n
        return out

    def decode(self, ids: list[int], ends: list[int] | None = None) -> bytes:
        """Bytes of the ids; with offsets, each id's bytes must end at its offset."""
        parts = list(map(self.bytes_of.__getitem__, ids))
        if ends is not None and np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts))).tolist() != list(ends):
            raise ValueError("the offsets are not those of the ids")
        return b"".join(parts)

    def ends(self, ids: list[int]) -> np.ndarray:
        """Byte offset in the text at which each id ends."""
        return np.cumsum(np.fromiter((len(self.bytes_of[i]) for i in ids), np.int64, len(ids)))


@lru_cache(2)
def codec_of(path: str) -> Codec:
    """One per Python worker, so that its cache serves all tasks that run there."""
    return Codec(path)


#: What :func:`encode` can add to a row.
OUTPUTS = {"ids": "array<int>", "ends": "array<bigint>", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"}


def encode(df: DataFrame, ranks_path: str, text_col: str = "text", outputs=("ids", "ends")) -> DataFrame:
    """``df`` with the outputs named: ids, byte offsets at which they end, their number, and digests.

    ``ids_sha256`` is of the decimal ids joined by a space, ``decoded_sha256`` of the bytes that the
    ids decode to. Ids are those of the rank file (whole pieces first, then merges by rank).
    """
    def make():
        codec = codec_of(ranks_path)
        digest = lambda b: hashlib.sha256(b).hexdigest()
        by_name = {"ids": lambda ids: np.array(ids, np.int32), "ends": codec.ends, "n_tokens": len,
                   "ids_sha256": lambda ids: digest(" ".join(map(str, ids)).encode()),
                   "decoded_sha256": lambda ids: digest(codec.decode(ids))}

        def run(texts):
            found = []
            sizes = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
            cuts = np.flatnonzero(np.diff(sizes // ENCODED, prepend=0)).tolist()  # a longer text is alone
            for first, last in zip([0, *cuts], [*cuts, len(texts)]):
                if first < last:
                    found += [[by_name[o](ids) for o in outputs] for ids in codec.encode(texts[first:last])]
            return list(zip(*found)) if found else [[] for _ in outputs]
        return run
    return append(df, text_col, ", ".join(f"{o} {OUTPUTS[o]}" for o in outputs), make)


def decode(df: DataFrame, ranks_path: str, ids_col: str = "ids", out: str = "text") -> DataFrame:
    """``df`` with the ids decoded as text (bytes that are no UTF-8 become U+FFFD); null ids are null."""
    fields = [f for f in df.schema.fields if f.name != out]

    def run(batches):
        codec = codec_of(ranks_path)
        for batch in batches:
            texts = [None if ids is None else codec.decode(ids).decode("utf-8", "replace") for ids in batch.column(ids_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(f.name) for f in fields] + [pa.array(texts, pa.string())],
                                             names=[f.name for f in fields] + [out])
    schema = T.StructType([*fields, T.StructField(out, T.StringType())])
    return df.select(*[f"`{f.name}`" for f in fields]).mapInArrow(run, schema)
