"""What several operators share: tables in the shared folder, text columns as arrays, words and hashes of whole batches.

Texts travel as UTF-8 bytes. A batch is handled in slices of a few MB, so a task's memory does not grow with its partition;
a single longer text is a slice of its own. A null text counts as an empty one unless an operator says otherwise.
"""

from __future__ import annotations

import re
import tempfile
import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tilesets import register

SLICE_BYTES = 2 << 20
U64 = np.uint64


# --- Tables ------------------------------------------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return register(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """A new path below the folder that the session names in spark.checkpoint.dir; one of our own only where none is set and driver
    and executors are one process."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="sparktiles-checkpoint-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return f"{folder}/llm-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """Write a table to the shared folder and go on from it: no lineage behind it, and lost executors cost only a read."""
    path = shared_folder(df.sparkSession)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fold(doc_id: str | Column, parts: int) -> Column:
    """crc32 of the id's decimal text, modulo `parts`; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary") if isinstance(doc_id, str) else doc_id) % parts


def hash_sample(rows: DataFrame, key: str, most: int, seed: str) -> DataFrame:
    """At most `most` rows, those of the smallest hash of their key: the same ones in every run and layout."""
    order = F.md5(F.concat(F.lit(seed), F.col(key).cast("string")).cast("binary"))
    return rows.withColumn("__order", order).orderBy("__order", key).limit(most).drop("__order")


def arrow_map(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]]], schema: str) -> DataFrame:
    """mapInArrow with state: `make` runs once per task and returns what is called with every non-empty batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            if batch.num_rows:
                yield from step(batch)

    return df.mapInArrow(run, schema)


# --- Text columns ------------------------------------------------------------------------------------------------------


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column and its row offsets, from 0; a null is an empty text."""
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    n, start = len(column), column.offset
    at = np.frombuffer(offsets, np.int64 if wide else np.int32, count=start + n + 1)[start:].astype(np.int64)
    if data is None or at[-1] == at[0]:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    return np.frombuffer(data, np.uint8, count=at[-1])[at[0] :], at - at[0]


def slices(offsets: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most `most` bytes each, one row at least."""
    low, n = 0, len(offsets) - 1
    while low < n:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + most, "right")) - 1)
        yield low, high
        low = high


def text_slices(batch: pa.RecordBatch, name: str = "text") -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Parts of a batch with the bytes and offsets of their texts."""
    data, at = text_bytes(batch.column(name))
    for low, high in slices(at):
        yield batch.slice(low, high - low), data[at[low] : at[high]], at[low : high + 1] - at[low]


def per_row(marks: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of a flag or number per byte, for each row."""
    total = np.zeros(len(marks) + 1, np.int64)
    np.cumsum(marks, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


# --- Hashes ------------------------------------------------------------------------------------------------------------


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others (two rounds of xor-shift and multiply)."""
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(32)
    x *= U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(32)
    return x


def multipliers(n: int, seed: int) -> np.ndarray:
    """Odd 64-bit numbers from a seed."""
    return mix(np.arange(1, n + 1, dtype=U64) + U64(seed * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) | U64(1)


def number_of(text: str) -> int:
    return zlib.crc32(text.encode())


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOW_BYTES = np.array([(1 << (8 * i)) - 1 for i in range(8)] + [(1 << 64) - 1], U64)


def span_hashes(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans, eight bytes a step; equal spans have equal hashes wherever they stand."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    out = mix(lengths.astype(U64) + U64(0x51ED270B))
    left, at, rows = lengths.copy(), starts.copy(), np.arange(len(starts))
    eight = np.arange(8)
    while len(rows):
        chunk = padded[at[:, None] + eight].view("<u8")[:, 0] & _LOW_BYTES[np.minimum(left, 8)]
        out[rows] = mix(out[rows] * U64(0x2545F4914F6CDD1D) + chunk)
        more = left > 8
        rows, at, left = rows[more], at[more] + 8, left[more] - 8
    return out


def distinct_spans(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of one span of each kind, kind of every span). Spans are grouped by hashes and then compared byte by byte."""
    _, first, group = np.unique(span_hashes(data, starts, lengths), return_index=True, return_inverse=True)
    like = first[group]
    same = lengths[like] == lengths
    if same.all():
        same = per_row(data[ranges(starts, lengths)] != data[ranges(starts[like], lengths)], np.concatenate([[0], np.cumsum(lengths)])) == 0
    odd = np.flatnonzero(~same)  # another span of the same hash: kinds of their own
    if len(odd):
        group = group.copy()
        group[odd] = len(first) + np.arange(len(odd))
        first = np.concatenate([first, odd])
    return first, group


class Words:
    """Maximal runs of bytes other than space and \\t..\\r, which never cross rows: places, hashes and the rows' ranges."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray) -> None:
        inside = ~_SPACE[data]
        cut = np.zeros(len(data) + 1, bool)
        cut[offsets] = True
        before = np.concatenate([[False], inside[:-1]]) if len(data) else inside
        self.starts = np.flatnonzero(inside & (~before | cut[:-1]))
        after = np.concatenate([inside[1:], [False]]) if len(data) else inside
        self.ends = np.flatnonzero(inside & (~after | cut[1:])) + 1
        self.data = data
        #: Row r has the words offsets[r] up to offsets[r + 1].
        self.offsets = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.offsets)

    def hashes(self) -> np.ndarray:
        return span_hashes(self.data, self.starts, self.ends - self.starts)

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)


def grams(hashes: np.ndarray, k: int, seed: int = 11) -> np.ndarray:
    """Hashes of k neighbours each, by the place of the first; the last k - 1 places have none."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    out = np.zeros(n, U64)
    for j, m in enumerate(multipliers(k, seed)):
        out += hashes[j : j + n] * m
    return mix(out)


def gram_places(offsets: np.ndarray, k: int) -> np.ndarray:
    """Places of k-grams that lie within one row, for rows given by item offsets."""
    counts = np.maximum(np.diff(offsets) - k + 1, 0)
    return ranges(offsets[:-1], counts)


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each start, `count` numbers each."""
    total = int(counts.sum())
    shift = np.repeat(starts - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) if len(counts) else np.zeros(0, np.int64)
    return shift + np.arange(total)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each `width` neighbours, by the place of the first."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


def binary_array(data: np.ndarray, offsets: np.ndarray, kind: pa.DataType | None = None) -> pa.Array:
    """A binary (or string) column from bytes and offsets, without a copy per row."""
    kind = kind or pa.binary()
    if len(data) >= 1 << 31:
        raise ValueError("a batch of over 2 GB")
    return pa.Array.from_buffers(kind, len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])
