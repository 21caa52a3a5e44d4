"""Token ids as length-delimited binary records, with an offset index for shuffled reads.

A record is ``uint64 length | uint32 masked crc of the length | data | uint32 masked crc of the data``
(little endian). ``data`` is a flag byte (1: the document has an id, 2: ids take two bytes), the int64
document id and the token ids, as uint16 where all fit and as uint32 otherwise. A checksum is crc32, rotated right by 15 bits plus a constant, so that data which
holds checksums does not check itself. The index file has one ``uint64 offset, uint64 length`` per
record: any record is read with one seek.

Files hold ascending ids (null first, equal ids by text) and are cut at ``file_bytes``. Each attempt
of a task writes files of its own name; the manifest names those of the attempts that counted, so a
lost executor leaves unread files at most. Paths may be of any file system that pyarrow opens.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tabsync.llm.common import slices
from tabsync.storage import materialise

MASK_DELTA = 0xA282EAD8
#: Bytes before the data: the length and its checksum.
HEAD_SIZE = 12
FILE_BYTES = 64 << 20
CACHED = 800_000
MANIFEST = "part int, seq int, path string, records bigint, ids bigint, bytes bigint"


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK_DELTA) & 0xFFFFFFFF


def frame(data: bytes) -> bytes:
    size = struct.pack("<Q", len(data))
    return b"".join((size, struct.pack("<I", masked(size)), data, struct.pack("<I", masked(data))))


def unframe(head: bytes, read) -> bytes:
    """Data of the record whose first 12 bytes are ``head``; ``read(n)`` gives the bytes after them."""
    size, crc = struct.unpack("<QI", head)
    if masked(head[:8]) != crc:
        raise ValueError("a record's length is damaged")
    rest = read(size + 4)
    if len(rest) != size + 4 or struct.unpack("<I", rest[size:])[0] != masked(rest[:size]):
        raise ValueError("a record is damaged or cut")
    return rest[:size]


def pack(doc_id: int | None, ids: np.ndarray) -> bytes:
    short = not len(ids) or int(ids.max()) < 1 << 16
    return struct.pack("<bq", (doc_id is not None) | short << 1, doc_id or 0) + ids.astype("<u2" if short else "<u4").tobytes()


def unpack(data: bytes) -> tuple[int | None, np.ndarray]:
    flag, doc_id = struct.unpack_from("<bq", data)
    return (doc_id if flag & 1 else None), np.frombuffer(data, "<u2" if flag & 2 else "<u4", offset=9).astype("<u4")


def read_record(path: str, number: int) -> tuple[int | None, np.ndarray]:
    """Record ``number`` of a file, by its index."""
    fs, name = pafs.FileSystem.from_uri(path)
    with fs.open_input_file(f"{name}.idx") as f:
        offset, _ = struct.unpack("<QQ", f.read_at(16, number * 16))
    with fs.open_input_file(name) as f:
        f.seek(offset)
        return unpack(unframe(f.read(HEAD_SIZE), f.read))


class WordEncoder:
    """Ids of text by a tokenizer that drops white space; each run between ASCII white space is encoded once.

    Such runs never influence each other in a tokenizer whose pre-tokenizer drops white space. A mark behind a letter is a token of
    its own there (but for letters whose normal form ends in a sign), and ASCII letters are put in lower case anyway, so that runs share their stems. The cache of stems is emptied when full.
    """

    def __init__(self, path: str):
        self.stems: dict[str, bytes] = {}
        self.letters: dict[str, bool] = {}
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        column = pa.array(texts, pa.string())
        for space in "\t\n\r":
            column = pc.replace_substring(column, space, " ")
        runs = pc.split_pattern(column, " ")
        coded = runs.flatten().dictionary_encode()
        stem, tail = self._parts(coded.dictionary)
        stem, tail = stem.dictionary_encode(), tail.dictionary_encode()
        cells = self._ids_of(stem.dictionary.to_pylist()) + self._ids_of(tail.dictionary.to_pylist())
        # Ids of the distinct parts behind one another; a text's ids are gathered from there, stem and tail of each run.
        flat = np.frombuffer(b"".join(cells), "<u4")
        sizes = np.fromiter(map(len, cells), np.int64, len(cells)) // 4
        starts = np.cumsum(sizes) - sizes
        parts = np.stack((stem.indices.to_numpy(), tail.indices.to_numpy() + len(stem.dictionary)), axis=1)
        which = parts[coded.indices.to_numpy()].ravel()
        long = sizes[which]
        ends = np.cumsum(long)
        ids = flat[np.repeat(starts[which] - ends + long, long) + np.arange(ends[-1] if len(ends) else 0)]
        cuts = np.append(0, ends[1::2])[runs.offsets.to_numpy()]
        return [ids[a:b] for a, b in zip(cuts[:-1], cuts[1:])]

    def _ids_of(self, stems: list[str]) -> list[bytes]:
        """Ids (uint32, little endian) of distinct stems."""
        known = self.stems
        new = [x for x in stems if x not in known]
        if len(known) + len(new) > CACHED:
            known.clear()
            new = stems
        for x, e in zip(new, self.tokenizer.encode_batch_fast(new, add_special_tokens=False)):
            ids = e.ids
            known[x] = struct.pack(f"<{len(ids)}I", *ids)
        return [known[x] for x in stems]


    def _parts(self, runs: pa.Array) -> tuple[pa.Array, pa.Array]:
        """Stem and tail of each run: a mark that ends it behind a letter that stays one, else nothing. ASCII stems are in lower case, but for those that may be special tokens.

        A letter whose normal form ends in a sign (as the dot that lower case sets on some letters) shares the mark's piece, so it keeps the mark.
        """
        marked = pc.match_substring_regex(runs, r"\p{L}[.,;:!?]$")
        places = pc.indices_nonzero(marked)
        before = pc.utf8_slice_codeunits(runs.take(places), -2, -1).dictionary_encode()
        signs = np.array([not self._stays(c) for c in before.dictionary.to_pylist()], bool)
        if signs.any():
            keep = marked.to_numpy(zero_copy_only=False).copy()
            keep[places.to_numpy()[signs[before.indices.to_numpy()]]] = False
            marked = pa.array(keep)
        stem = pc.if_else(marked, pc.utf8_slice_codeunits(runs, 0, -1), runs)
        tail = pc.if_else(marked, pc.utf8_slice_codeunits(runs, -1), "")
        plain = pc.and_(pc.string_is_ascii(stem), pc.invert(pc.match_substring(stem, "<")))
        return pc.if_else(plain, pc.ascii_lower(stem), stem), tail

    def _stays(self, letter: str) -> bool:
        """Whether the normal form of a letter ends in a letter."""
        if letter not in self.letters:
            normal = self.tokenizer.normalizer.normalize_str(letter) if self.tokenizer.normalizer else letter
            self.letters[letter] = normal[-1:].isalpha()
        return self.letters[letter]


@lru_cache(2)
def encoder_of(path: str) -> WordEncoder:
    return WordEncoder(path)


class _Writer:
    def __init__(self, folder: str, part: int, name: str, seq: int):
        self.row = {"part": part, "seq": seq, "path": f"{folder}/part-{part:05d}-{seq:04d}-{name}.rec", "records": 0, "ids": 0, "bytes": 0}
        fs, path = pafs.FileSystem.from_uri(self.row["path"])
        fs.create_dir(os.path.dirname(path), recursive=True)
        self.data, self.index = fs.open_output_stream(path), fs.open_output_stream(f"{path}.idx")

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        record = frame(pack(doc_id, ids))
        self.index.write(struct.pack("<QQ", self.row["bytes"], len(record)))
        self.data.write(record)
        for k, v in (("records", 1), ("ids", len(ids)), ("bytes", len(record))):
            self.row[k] += v

    def close(self) -> dict:
        self.data.close()
        self.index.close()
        return self.row


def write_records(df: DataFrame, folder: str, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                  end_id: int | None = 2, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write the ids of all texts, in ascending order of the id, below ``folder``; returns the manifest, one row per file.

    Texts are dealt out by ranges of the id and encoded where they are written, so ids are never shuffled. A null text
    counts as empty; every row gives a record, repeated rows too. Other columns are not looked at.
    """
    order = (F.col("__id").asc_nulls_first(), F.col("__h"))
    rows = df.select(F.col(id_col).cast("bigint").alias("__id"), F.col(text_col).alias("__text"), F.xxhash64(text_col).alias("__h"))
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("__id", "__text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, name, seq, out = encoder_of(tokenizer_path), TaskContext.get().partitionId(), uuid.uuid4().hex, 0, None
        end, done = np.array([] if end_id is None else [end_id], "<u4"), []
        for batch in batches:
            for piece in slices(batch, 1):
                texts = [t or "" for t in piece.column(1).to_pylist()]
                for doc_id, ids in zip(piece.column(0).to_pylist(), encoder.encode(texts)):
                    if out is None:
                        out, seq = _Writer(folder, part, name, seq), seq + 1
                    out.add(doc_id, np.concatenate((ids, end)))
                    if out.row["bytes"] >= file_bytes:
                        done.append(out.close())
                        out = None
        if out is not None:
            done.append(out.close())
        yield pa.RecordBatch.from_pylist(done, schema=pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("path", pa.string()),
                                                                 ("records", pa.int64()), ("ids", pa.int64()), ("bytes", pa.int64())]))
    return materialise(dealt.mapInArrow(run, MANIFEST), "records")


def read_records(manifest: DataFrame, schema: str, digest) -> DataFrame:
    """``digest(doc_id, start, ids)`` of every record of the files named, as rows of ``schema``.

    ``start`` is the number of ids in all records before this one. Files are read as streams, each by one task, and
    every checksum is tested.
    """
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    files = manifest.select("path", "part", "seq", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("start"))
    out = T.StructType.fromDDL(schema)
    kinds = [to_arrow_type(f.dataType) for f in out.fields]
    batch_of = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=out.names)

    def run(batches):
        for batch in batches:
            for file in batch.to_pylist():
                fs, path = pafs.FileSystem.from_uri(file["path"])
                rows, start = [], file["start"]
                with fs.open_input_stream(path, buffer_size=1 << 20) as f:
                    while head := f.read(HEAD_SIZE):
                        doc_id, ids = unpack(unframe(head, f.read))
                        rows.append(digest(doc_id, start, ids))
                        start += len(ids)
                        if len(rows) >= 4096:
                            yield batch_of(rows)
                            rows = []
                if rows:
                    yield batch_of(rows)
    spark = manifest.sparkSession
    return files.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "path").mapInArrow(run, out)
