"""Document fingerprints by Order MinHash.

A text's k-mers of words are numbered by occurrence, so that repeats count. For each of `sketches` hash functions the
`length` smallest numbered k-mers are selected, put back into the order of the text, and their tuple is hashed. Two texts agree in
a sketch only if they share those k-mers in the same order, so the share of equal sketches follows the edit distance, not only
the sets. A text of fewer than `k` words counts as one k-mer, the whole text; so an empty or null text has a fingerprint too.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import U64, Words, gram_places, grams, mix, multipliers, slices, span_hashes, stored, table, text_bytes

K, SKETCHES, LENGTH = 2, 64, 2
#: Words that stand without a space for longer than this are cut, so that scripts without spaces have k-mers.
LONGEST_WORD = 24
#: k-mers looked at together: bounds the memory of a long text.
BLOCK = 8192


class OrderMinHash:
    def __init__(self, k: int = K, sketches: int = SKETCHES, length: int = LENGTH, seed: int = 7) -> None:
        self.k, self.length = k, length
        self.functions = multipliers(sketches, seed)
        self.places = multipliers(length, seed + 1)

    def of(self, texts: list[bytes]) -> np.ndarray:
        """(texts, sketches) 16-bit numbers."""
        out = np.empty((len(texts), len(self.functions)), np.uint16)
        sizes = np.fromiter((len(t) for t in texts), np.int64, len(texts))
        at = np.concatenate([[0], np.cumsum(sizes)])
        for low, high in slices(at):
            out[low:high] = self._slice(texts[low:high], at[low : high + 1] - at[low])
        return out

    def _slice(self, texts: list[bytes], at: np.ndarray) -> np.ndarray:
        data = np.frombuffer(b"".join(texts), np.uint8)
        hashes, offsets = _tokens(data, at)
        places = gram_places(offsets, self.k)
        kmers = grams(hashes, self.k)[places] if len(places) else np.zeros(0, U64)
        counts = np.maximum(np.diff(offsets) - self.k + 1, 0)
        rows = np.repeat(np.arange(len(texts)), counts)
        numbered = mix(kmers + _occurrences(kmers, rows) * U64(0x9E3779B97F4A7C15))
        ends = np.cumsum(counts)
        whole = span_hashes(data, at[:-1], np.diff(at)) if not counts.all() else None
        out = np.empty((len(texts), len(self.functions)), np.uint16)
        for i, (end, n) in enumerate(zip(ends.tolist(), counts.tolist(), strict=True)):
            if n:
                out[i] = self._sketch(kmers[end - n : end], numbered[end - n : end])
            else:
                out[i] = self._sketch(whole[i : i + 1], whole[i : i + 1])
        return out

    def _sketch(self, kmers: np.ndarray, numbered: np.ndarray) -> np.ndarray:
        best = self._smallest(numbered, np.arange(min(BLOCK, len(kmers))))
        for low in range(BLOCK, len(kmers), BLOCK):
            found = self._smallest(numbered, np.arange(low, min(low + BLOCK, len(kmers))))
            both = np.concatenate([best, found], axis=1)
            order = np.argsort(numbered[both] * self.functions[:, None], axis=1, kind="stable")[:, : self.length]
            best = np.take_along_axis(both, order, axis=1)
        chosen = kmers[np.sort(best, axis=1)]
        return (mix((mix(chosen) * self.places[: chosen.shape[1]]).sum(axis=1, dtype=U64)) >> U64(48)).astype(np.uint16)

    def _smallest(self, numbered: np.ndarray, which: np.ndarray) -> np.ndarray:
        """(functions, length) places of the smallest values of each function; all places if there are fewer."""
        values = self.functions[:, None] * numbered[which][None, :]
        line, found = np.arange(len(values)), []
        for _ in range(min(self.length, len(which))):
            least = values.argmin(axis=1)
            found.append(which[least])
            values[line, least] = ~U64(0)
        return np.stack(found, axis=1)


def _tokens(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of words, long ones in parts, and the rows' ranges among them."""
    words = Words(data, at)
    lengths = words.ends - words.starts
    if not (lengths > LONGEST_WORD).any():
        return span_hashes(data, words.starts, lengths), words.offsets
    parts = -(-lengths // LONGEST_WORD)
    before = np.concatenate([[0], np.cumsum(parts)])
    nth = np.arange(before[-1]) - np.repeat(before[:-1], parts)
    starts = np.repeat(words.starts, parts) + nth * LONGEST_WORD
    return span_hashes(data, starts, np.minimum(np.repeat(words.ends, parts) - starts, LONGEST_WORD)), before[words.offsets]


def _occurrences(kmers: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """How many equal k-mers of the same row stand before each."""
    if not len(kmers):
        return kmers
    order = np.lexsort((kmers, rows))
    same = np.concatenate([[False], (kmers[order][1:] == kmers[order][:-1]) & (rows[order][1:] == rows[order][:-1])])
    first = np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))
    out = np.empty(len(kmers), U64)
    out[order] = (np.arange(len(order)) - first).astype(U64)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a == b).mean(axis=1)


# --- Spark -------------------------------------------------------------------------------------------------------------


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fingerprint (hex) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = OrderMinHash()
        for batch in batches:
            marks = hasher.of(_texts(batch))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), _hex(marks)], ["doc_id", "fingerprint"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, fingerprint string")


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    data, at = text_bytes(batch.column("text"))
    raw = memoryview(data)
    return [bytes(raw[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]


def _hex(marks: np.ndarray) -> pa.Array:
    return pa.array([m.astype(">u2").tobytes().hex() for m in marks], pa.string())


def edited(text: bytes, following: bytes) -> tuple[int, bytes]:
    """Code points of a text, and the text with its last quarter replaced by as many first code points of another."""
    own = text.decode()
    quarter = len(own) // 4
    # Four bytes a code point at most, so a long neighbour is not decoded whole; a cut last character is beyond the quarter.
    other = following[: 4 * quarter].decode(errors="ignore")[:quarter]
    return len(own), (own[: len(own) - quarter] + other).encode()


def _compared(ids: pa.Array, texts: list[bytes], following: list[bytes], hasher: OrderMinHash) -> Iterator[pa.RecordBatch]:
    """Result rows of texts and the texts behind them, in parts of some MB."""
    at = np.concatenate([[0], np.cumsum([len(t) + len(f) for t, f in zip(texts, following, strict=True)])])
    for low, high in slices(at, 8 << 20):
        own, after = texts[low:high], following[low:high]
        changed = [edited(t, f) for t, f in zip(own, after, strict=True)]
        # Neighbours share texts: those of `own` that are also `after` are hashed once.
        marks = hasher.of([*own, *(after[-1:] if own[1:] == after[:-1] else after), *(t for _, t in changed)])
        n = len(own)
        mine, other = marks[:n], marks[len(marks) - n :]
        beside = np.concatenate([mine[1:], marks[n : n + 1]]) if len(marks) == 2 * n + 1 else marks[n : 2 * n]
        columns = [
            ids.slice(low, n),
            pa.array([c for c, _ in changed], pa.int64()),
            pa.array([hashlib.sha256(t).hexdigest() for _, t in changed], pa.string()),
            _hex(mine),
            _hex(other),
            pa.array(likeness(mine, other)),
            pa.array(likeness(mine, beside)),
        ]
        yield pa.RecordBatch.from_arrays(columns, _NAMES)


_NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
_SCHEMA = "doc_id {}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def compare_with_edited(docs: DataFrame) -> DataFrame:
    """Every document against its edited text and the next document, in the order of doc_id (nulls first, equal ids by text).

    Documents are range-partitioned and sorted; within a partition a row's successor is the row behind it. The first and
    last text of each partition are handed on, and a join by partition number makes up the pairs across the edges, the last
    document's successor being the first. A single document is its own successor; no rows give none.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, part, held = OrderMinHash(), TaskContext.get().partitionId(), None

        def edge(name: str, doc_id: pa.Array, text: bytes) -> pa.RecordBatch:
            empty = [pa.nulls(1, t) for t in (pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())]
            return pa.RecordBatch.from_arrays([doc_id, *empty, pa.array([part], pa.int32()), pa.array([name]), pa.array([text.decode()])], names)

        names = [*_NAMES, "part", "edge", "text"]
        for batch in batches:
            if not batch.num_rows:
                continue
            texts, ids = _texts(batch), batch.column("doc_id")
            if held is None:
                yield edge("first", ids.slice(0, 1), texts[0])
            else:
                texts, ids = [held[1], *texts], pa.concat_arrays([held[0], ids])
            for done in _compared(ids.slice(0, len(texts) - 1), texts[:-1], texts[1:], hasher):
                n = done.num_rows
                more = [pa.array(np.full(n, part, np.int32)), pa.nulls(n, pa.string()), pa.nulls(n, pa.string())]
                yield pa.RecordBatch.from_arrays([*done.columns, *more], names)
            held = ids.slice(len(texts) - 1), texts[-1]
        if held is not None:
            yield edge("last", *held)

    both = stored(ordered.mapInArrow(run, _SCHEMA.format(kind) + ", part int, edge string, text string"))
    first = both.filter("edge = 'first'").select(F.col("part").alias("next_part"), F.col("text").alias("following"))
    last = both.filter("edge = 'last'").select("doc_id", "text", "part")
    numbers = both.filter("edge = 'first'").select("part")
    after = F.lead("part").over(Window.orderBy("part"))
    steps = numbers.withColumn("next_part", F.coalesce(after, F.min("part").over(Window.partitionBy())))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = OrderMinHash()
        for batch in batches:
            if batch.num_rows:
                following = _texts(batch.select(["following"]).rename_columns(["text"]))
                yield from _compared(batch.column("doc_id"), _texts(batch), following, hasher)

    pairs = last.join(steps, "part").join(first, "next_part").select("doc_id", "text", "following")
    inner = both.filter("edge IS NULL").select(*_NAMES)
    return inner.unionByName(pairs.mapInArrow(finish, _SCHEMA.format(kind)))


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_with_edited(table(spark, sf_dir, "documents"))
