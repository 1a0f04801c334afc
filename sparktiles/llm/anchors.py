"""Where texts may share a long passage: anchors, and which of them occur more than once.

Of every window of `window` items (bytes or words) the k-gram with the smallest hash is the anchor, the leftmost at a tie. Equal
windows have the same anchor at the same offset, so a passage shared by two texts has the same anchors in both; only about
2 / (window - k + 2) of all places are anchors, and only anchors travel. One shuffle by the anchor's hash tells which occur at
two places or more; nothing that is shared can be missed.

Texts are written once to a table bucketed by the document's order key, so that what is found out about a document, which is
small, is joined back to its text again and again without moving the text. Equal texts are found by SHA-256 first: only the
first of them has anchors, the others are copies as a whole. Groups of copies and passages that very many documents share
cost no more than one entry per task, because repeats within a task are settled there.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, gram_places, shared_folder, sliding_min, stored, text_slices

#: Order key of rows without an id: behind all others.
LAST = (1 << 63) - 1
#: Anchors that a task gathers before it hands them on.
GATHERED = 1 << 20


@dataclass
class Anchors:
    """Place of each anchor, the first and last window it stands for, its row, and its hash; by row and place."""

    at: np.ndarray
    first: np.ndarray
    last: np.ndarray
    row: np.ndarray
    key: np.ndarray

    def __getitem__(self, which: np.ndarray) -> Anchors:
        return Anchors(self.at[which], self.first[which], self.last[which], self.row[which], self.key[which])


def find_anchors(hashes: np.ndarray, offsets: np.ndarray, window: int, k: int) -> Anchors:
    """Anchors of rows given by item offsets, from the hash of the k-gram at every place."""
    starts = gram_places(offsets, window)
    none = np.zeros(0, np.int64)
    if not len(starts):
        return Anchors(none, none, none, none, np.zeros(0, U64))
    # Compared by their upper half, then by place: what a window chooses depends on the window alone.
    ranked = (hashes & U64(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype=U64)
    chosen = (sliding_min(ranked, window - k + 1)[starts] & U64(0xFFFFFFFF)).astype(np.int64)
    new = np.flatnonzero(np.concatenate([[True], chosen[1:] != chosen[:-1]]))
    at = chosen[new]
    last = starts[np.append(new[1:], len(starts)) - 1]
    return Anchors(at, starts[new], last, np.searchsorted(offsets, at, "right") - 1, hashes[at])


# --- Texts, bucketed by document, and copies ---------------------------------------------------------------------------


def bucketed(docs: DataFrame) -> DataFrame:
    """The documents with __okey (doc_id, nulls last) and __sha, as a table in the shared folder bucketed by __okey."""
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"llm_{uuid.uuid4().hex}"
    text = F.coalesce("text", F.lit("")).cast("binary")
    rows = docs.withColumns({"__okey": F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)), "__sha": F.unhex(F.sha2(text, 256))})
    rows.repartition(n, "__okey").write.bucketBy(n, "__okey").option("compression", "zstd").option("path", shared_folder(spark)).saveAsTable(name)
    return spark.table(name)


def first_texts(base: DataFrame) -> DataFrame:
    """__okey and __firsts, the hashes of those of its texts that no document before it has. Rows with the same id and text
    are one document."""
    firsts = base.groupBy("__sha").agg(F.min("__okey").alias("__okey"))
    return stored(firsts.groupBy("__okey").agg(F.collect_list("__sha").alias("__firsts")))


def with_facts(base: DataFrame, facts: DataFrame, how: str = "inner") -> DataFrame:
    """Texts joined with a table that has one small row per __okey. The table is moved to the buckets, the texts stay."""
    return base.join(facts.hint("shuffle_hash"), "__okey", how)


IS_FIRST = "array_contains(__firsts, __sha)"


# --- Which anchors repeat ----------------------------------------------------------------------------------------------

_PACKED = "bucket int, keys binary, places binary, wide boolean, counts binary, docs binary, sure boolean"
#: Bytes of a key that travel. Fewer only let through more anchors that do not repeat.
KEY_BYTES = 6


class _Gatherer:
    """Packs anchors by bucket. A key found twice within the task is settled: its places are sure, one entry still travels."""

    def __init__(self, buckets: int) -> None:
        self.buckets, self.parts, self.n = buckets, [], 0

    def add(self, okeys: np.ndarray, places: np.ndarray, keys: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.parts.append((okeys, places, keys))
        self.n += len(keys)
        if self.n >= GATHERED:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.n:
            return
        okeys, places, keys = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        self.parts, self.n = [], 0
        _, one, of, counts = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
        twice = counts[of] > 1
        yield from self._packed(okeys[one], places[one], keys[one], ((keys[one] >> U64(1)) % U64(self.buckets)).astype(np.int64), False, counts > 1)
        if twice.any():
            yield from self._packed(okeys[twice], places[twice], None, okeys[twice] % self.buckets, True, None)

    def _packed(self, okeys, places, keys, buckets, sure, settled) -> Iterator[pa.RecordBatch]:
        order = np.lexsort((okeys, buckets))
        buckets, okeys, places = buckets[order], okeys[order], places[order]
        first = np.flatnonzero(np.concatenate([[True], buckets[1:] != buckets[:-1]]))
        rows = []
        for low, high in zip(first, np.append(first[1:], len(buckets)), strict=True):
            docs, counts = np.unique(okeys[low:high], return_counts=True)
            key = b""
            if keys is not None:
                # The lowest bit says whether the key is settled; the other bits are the key.
                full = (keys[order[low:high]] & ~U64(1)) | settled[order[low:high]].astype(U64)
                key = full.view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES].tobytes()
            wide = bool(places[low:high].max() >> 16)
            place = places[low:high].astype(np.uint32 if wide else np.uint16)
            rows.append((int(buckets[low]), key, place.tobytes(), wide, counts.astype(np.uint32).tobytes(), docs.tobytes(), sure))
        kinds = (pa.int32(), pa.binary(), pa.binary(), pa.bool_(), pa.binary(), pa.binary(), pa.bool_())
        names = ["bucket", "keys", "places", "wide", "counts", "docs", "sure"]
        for low in range(0, len(rows), 256):
            columns = [pa.array(c, t) for c, t in zip(zip(*rows[low : low + 256], strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names)


def repeated_anchors(base: DataFrame, firsts: DataFrame, find: Callable[[np.ndarray, np.ndarray], tuple[Anchors, np.ndarray]]) -> DataFrame:
    """__okey and __places: the anchors, counted in items from the start of the text, whose hash occurs at two places or more.

    `find` gives the anchors of a slice of texts and the item offsets of its rows. Some of these may not repeat after all (a key
    is compared by 47 bits and its bucket, a document of several texts by its id alone); none that repeats is left out.
    """
    spark = base.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = with_facts(base.select("__okey", "__sha", "text"), firsts).filter(IS_FIRST).select("__okey", "text")

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered = _Gatherer(buckets)
        for batch in batches:
            for part, data, at in text_slices(batch):
                okeys = part.column("__okey").to_numpy()
                found, offsets = find(data, at)
                yield from gathered.add(okeys[found.row], found.at - offsets[found.row], found.key)
        yield from gathered.flush()

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        for batch in batches:
            for _, keys, places, wide, counts, docs, sure in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                okeys = np.repeat(np.frombuffer(docs, np.int64), np.frombuffer(counts, np.uint32))
                places = np.frombuffer(places, np.uint32 if wide else np.uint16)
                if sure:
                    yield _places(okeys, places)
                else:
                    full = np.zeros((len(places), 8), np.uint8)
                    full[:, :KEY_BYTES] = np.frombuffer(keys, np.uint8).reshape(-1, KEY_BYTES)
                    held.append((full.view(U64)[:, 0], okeys, places.astype(np.uint32)))
        if held:
            keys, okeys, places = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            _, of, counts = np.unique(keys >> U64(1), return_inverse=True, return_counts=True)
            # Settled ones have been handed out by their task already.
            again = (counts[of] > 1) & (keys & U64(1) == 0)
            for low in range(0, len(keys), GATHERED):
                some = slice(low, low + GATHERED)
                yield _places(okeys[some][again[some]], places[some][again[some]])

    packed = rows.mapInArrow(gather, _PACKED).repartitionById(buckets, "bucket")
    places = packed.mapInArrow(settle, "__okey long, place long")
    return stored(places.groupBy("__okey").agg(F.collect_set("place").alias("__places")))


def _places(okeys: np.ndarray, places: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(okeys), pa.array(places.astype(np.int64))], ["__okey", "place"])


def known_anchors(found: Anchors, offsets: np.ndarray, places: pa.Array) -> Anchors:
    """The anchors among the places of their row; `places` has a list per row."""
    lists = places.flatten().to_numpy()
    counts = np.array(places.value_lengths().fill_null(0))
    rows = np.repeat(np.arange(len(counts)), counts)
    return found[np.isin(found.at, offsets[rows] + lists)]
