"""Rows on their way to the tasks that encode them: packed batches instead of rows, so that a shuffle's files are a part as large."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

Batches = Iterator[pa.RecordBatch]
# Rows of a bucket, on average; it is put in order by one task at a time. Bytes of rows that a task gathers before it packs them.
BUCKET_ROWS, GATHERED_BYTES = 50_000, 64 << 20
# Packed rows that are handed on at a time, and bytes of a bucket from which on its keys are put in order one by one.
HANDED, WIDE_BYTES = 512, 64 << 20
PACKED_SCHEMA = "_task int, _bucket int, size long, planes boolean, rows binary"
PACKED_ARROW = pa.schema([("_task", pa.int32()), ("_bucket", pa.int32()), ("size", pa.int64()), ("planes", pa.bool_()), ("rows", pa.binary())])


def packed_bytes(data: bytes | np.ndarray | pa.Buffer) -> bytes:
    """Smaller, where that is so: bytes of the length they had before are as they were."""
    raw = pa.py_buffer(data)
    small = pa.Codec("zstd", 3).compress(raw, asbytes=True) if raw.size >= 256 else b""
    return small if 0 < len(small) < raw.size else raw.to_pybytes()


def unpacked_bytes(data: pa.Buffer, size: int) -> pa.Buffer:
    return data if data.size == size else pa.Codec("zstd").decompress(data, size)


def planes(data: pa.Buffer) -> np.ndarray:
    """The first bytes of all words of eight, then the second, and so on: numbers pack better that way, texts do not."""
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(-1, 8).T).reshape(-1)


def words(data: pa.Buffer) -> pa.Buffer:
    """What `planes` was made from."""
    return pa.py_buffer(np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T))


def _zoned(t: pa.DataType, zone: str) -> pa.DataType:
    """The type as Spark hands it to Python: timestamps are in the session's time zone."""
    inner = lambda f: f.with_type(_zoned(f.type, zone))
    if pa.types.is_timestamp(t):
        return pa.timestamp(t.unit, zone) if t.tz else t
    if pa.types.is_struct(t):
        return pa.struct([inner(f) for f in t])
    if pa.types.is_map(t):
        return pa.map_(inner(t.key_field), inner(t.item_field))
    return pa.list_(inner(t.value_field)) if pa.types.is_list(t) else t


def handed_schema(df: DataFrame) -> pa.Schema:
    """What Python gets of a table."""
    conf = df.sparkSession.conf
    large = conf.get("spark.sql.execution.arrow.useLargeVarTypes", "false") == "true"
    zone = conf.get("spark.sql.session.timeZone")
    return pa.schema([f.with_type(_zoned(f.type, zone)) for f in to_arrow_schema(df.schema, prefers_large_types=large)])


def _pack(names: list[str], order: list[str], tasks: int) -> Callable[[Batches], Batches]:
    """Rows by bucket, each bucket's of what a task has gathered in one value."""

    def pack(held: list[pa.RecordBatch]) -> Batches:
        rows = pa.concat_batches(held)
        held.clear()
        bucket, rows = rows.column("_bucket").to_numpy(), rows.select(names)
        keys = [rows.column(k) for k in order if pa.types.is_integer(rows.schema.field(k).type)]
        place = np.lexsort([*(k.fill_null(0).to_numpy() for k in reversed(keys)), bucket])
        bucket = bucket[place]
        heads = np.flatnonzero(np.diff(bucket, prepend=-1))
        ends = np.append(heads[1:], len(bucket))
        split = None
        for low in range(0, len(heads), HANDED):
            some = slice(low, low + HANDED)
            # Columns are moved for some buckets at a time.
            a = int(heads[low])
            part = rows.take(pa.array(place[a : ends[some][-1]]))
            raw = [part.slice(int(h) - a, int(e - h)).serialize() for h, e in zip(heads[some], ends[some], strict=True)]
            if split is None:
                split = len(packed_bytes(planes(raw[0]))) < len(packed_bytes(raw[0]))
            of, n = bucket[heads[some]], len(raw)
            columns = [pa.array(of % tasks, pa.int32()), pa.array(of, pa.int32()), pa.array([r.size for r in raw], pa.int64()), pa.array([split] * n)]
            yield pa.record_batch([*columns, pa.array([packed_bytes(planes(r) if split else r) for r in raw], pa.binary())], schema=PACKED_ARROW)

    def run(batches: Batches) -> Batches:
        held, size = [], 0
        for b in batches:
            if not b.num_rows:
                continue
            held.append(b)
            size += b.nbytes
            if size >= GATHERED_BYTES:
                yield from pack(held)
                size = 0
        if held:
            yield from pack(held)

    return run


def unpacked_rows(batches: Batches, schema: pa.Schema, key: list[str], order: list[str]) -> Batches:
    """The rows of each bucket as one batch, in order; nulls first. A bucket of over WIDE_BYTES is several, each of whole keys, so that no more than
    those are copied at once. The columns of `key` are integers without nulls."""

    def in_order(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.concat_batches(parts)
        return rows.take(pc.sort_indices(rows.select(order), [(k, "ascending") for k in order], null_placement="at_start"))

    def whole(parts: list[pa.RecordBatch]) -> Batches:
        size = sum(p.nbytes for p in parts)
        if size <= WIDE_BYTES:
            yield in_order(parts)
            return
        keys = np.concatenate([np.stack([p.column(k).to_numpy() for k in key], axis=1) for p in parts])
        _, of, n = np.unique(keys, axis=0, return_inverse=True, return_counts=True)
        # Keys go together up to about the bound, by the bytes that a row has on average.
        of = ((np.cumsum(n) - n) * (size // len(keys)) // max(1, WIDE_BYTES))[of.reshape(-1)]
        each = np.split(of, np.cumsum([p.num_rows for p in parts])[:-1])
        for i in np.unique(of).tolist():
            yield in_order([p.filter(pa.array(own == i)) for p, own in zip(parts, each, strict=True)])

    held, last = [], None
    for b in batches:
        data = b.column("rows")
        for i, (bucket, size, split) in enumerate(zip(*(b.column(k).to_pylist() for k in ("_bucket", "size", "planes")), strict=True)):
            if held and bucket != last:
                yield from whole(held)
                held = []
            last = bucket
            raw = unpacked_bytes(data[i].as_buffer(), size)
            held.append(pa.ipc.read_record_batch(words(raw) if split else raw, schema))
    if held:
        yield from whole(held)


def by_bucket(df: DataFrame, key: list[str | Column], order: list[str], total: int, tasks: int) -> tuple[DataFrame, pa.Schema]:
    """Packed rows in `tasks` partitions, by bucket: rows of one `key` are in one bucket. With the schema that `unpacked_rows` needs."""
    schema = handed_schema(df)
    buckets = max(tasks, -(-total // BUCKET_ROWS))
    dealt = df.withColumn("_bucket", F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int"))
    packed = dealt.mapInArrow(_pack(schema.names, order, tasks), PACKED_SCHEMA)
    return packed.repartitionById(tasks, "_task").sortWithinPartitions("_bucket"), schema
