"""Removal of repeated 100-byte strings by sorting suffixes.

The suffixes that are sorted are those that start at a repeated anchor (see anchors.py); every 100-byte string that occurs twice
contains one, at the same offset. With each suffix go the bytes in front of it that belong to the strings it stands for. Splitters
sampled from the suffixes' leading bytes range-partition them; as long as the leading bytes compared are those of the anchor, all
suffixes that could match are neighbours in one bucket, so what is left to compare across a boundary is nothing. A bucket sorts
its suffixes by multikey quicksort, eight bytes a key: only runs that are still equal are sorted by the next key. Common
prefixes of neighbours then cut the order into runs that agree in 100 - o bytes, for every offset o; together with the same
for the reversed bytes in front, runs are exactly the classes of equal 100-byte strings, and all but the earliest of each class
are repeats.

A null text is an empty one. Order is by doc_id, null ids last, texts of one id by their hash; rows with the same id and text are
one document. Texts under 100 bytes keep every byte.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .anchors import IS_FIRST, Anchors, bucketed, find_anchors, first_texts, known_anchors, repeated_anchors, with_facts
from .common import U64, hash_sample, mix, multipliers, ranges, span_hashes, stored, table, text_slices

WINDOW, K = 100, 32
#: Documents that splitters are sampled from, and leading bytes in the sample, at most.
SAMPLED_DOCS, SAMPLED_LEADS = 2_000, 50_000
_BYTE = mix(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))
_STEPS = multipliers(5, 23)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the 32 bytes from each place on, by doubling."""
    h, size = _BYTE[data], 1
    for m in _STEPS:
        if len(h) <= size:
            return np.zeros(0, U64)
        h = h[:-size] * m + h[size:]
        size *= 2
    return mix(h)


def byte_anchors(data: np.ndarray, at: np.ndarray) -> tuple[Anchors, np.ndarray]:
    return find_anchors(gram_hashes(data), at, WINDOW, K), at


# --- Sorting -----------------------------------------------------------------------------------------------------------


def multikey_sort(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, common): strings in ascending order, and how many bytes each has in common with the one before it.

    Keys are eight bytes, zero-padded; a string that ends is told from one that goes on with zeros by its length.
    """
    n = len(starts)
    order, common = np.arange(n), np.zeros(n, np.int64)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    #: Ends of the runs of strings that are equal so far; a run is handled as a block of `order`.
    run = np.zeros(n, np.int64)
    active, depth = np.arange(n), 0
    while len(active):
        which = order[active]
        left = lengths[which] - depth
        at = np.where(left > 0, starts[which] + depth, len(data))
        raw = padded[at[:, None] + np.arange(8)]
        raw[np.arange(8) >= left[:, None]] = 0
        keys = raw.view(">u8")[:, 0].astype(U64)
        held = np.clip(left, 0, 8)
        by = np.lexsort((held, keys, run[active]))
        order[active], keys, held, groups = which[by], keys[by], held[by], run[active]
        same_run = np.concatenate([[False], groups[1:] == groups[:-1]])
        differ = np.concatenate([[U64(0)], keys[1:] ^ keys[:-1]])
        agree = np.full(len(active), 8, np.int64)
        for byte in range(8):
            agree = np.where((agree == 8) & ((differ >> U64(56 - 8 * byte)) & U64(255) != 0), byte, agree)
        shorter = np.minimum(held, np.concatenate([[0], held[:-1]]))
        agree = np.minimum(agree, shorter)
        common[active] = np.where(same_run, depth + agree, common[active])
        equal = same_run & (agree == 8)
        run[active] = np.maximum.accumulate(np.where(equal, 0, active))
        # Only strings with an equal neighbour and bytes to come go on.
        more = (equal | np.append(equal[1:], False)) & (held == 8)
        active, depth = active[more], depth + 8
    return order, common


class SuffixBucket:
    """Suffixes of one bucket: span bytes, the length in front of the anchor, identity and place of the first window."""

    def __init__(self, data: np.ndarray, lengths: np.ndarray, front: np.ndarray, okeys: np.ndarray, tags: np.ndarray, first: np.ndarray) -> None:
        # Rows that repeat a document bring the same suffixes again; one of each is enough.
        order = np.lexsort((first + front, tags, okeys))
        same = np.zeros(len(order), bool)
        same[order[1:]] = True
        for x in (first + front, tags, okeys):
            same[order[1:]] &= x[order[1:]] == x[order[:-1]]
        one, starts = np.flatnonzero(~same), np.cumsum(lengths) - lengths
        self.data, self.lengths, self.front = data[ranges(starts[one], lengths[one])], lengths[one], front[one]
        self.okeys, self.tags, self.first = okeys[one], tags[one], first[one]
        self.starts = np.cumsum(self.lengths) - self.lengths

    def repeats(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(suffix, from, to): bytes of the suffix's document covered by a repeated string."""
        n = len(self.starts)
        right, agree = multikey_sort(self.data, self.starts + self.front, self.lengths - self.front)
        # The bytes in front, nearest first.
        back = self.starts.repeat(self.front) + self.front.repeat(self.front) - 1 - ranges(np.zeros(n, np.int64), self.front)
        left, agree_left = multikey_sort(self.data[back], np.cumsum(self.front) - self.front, self.front)
        rank = np.empty(n, np.int64)
        rank[np.lexsort((self.first + self.front, self.tags, self.okeys))] = np.arange(n)
        rest = self.lengths - self.front
        found: list[tuple[np.ndarray, int]] = []
        for offset in range(WINDOW - K + 1):
            able = (self.front >= offset) & (rest >= WINDOW - offset)
            if able.sum() < 2:
                continue
            after, before = np.empty(n, np.int64), np.empty(n, np.int64)
            after[right] = np.cumsum(agree < WINDOW - offset)
            before[left] = np.cumsum(agree_left < offset) if offset else 0
            which = np.flatnonzero(able)
            by = np.lexsort((rank[which], before[which], after[which]))
            which = which[by]
            again = (after[which][1:] == after[which][:-1]) & (before[which][1:] == before[which][:-1])
            found.append((which[1:][again], offset))
        if not found:
            return (np.zeros(0, np.int64),) * 3
        suffix = np.concatenate([w for w, _ in found])
        start = self.first[suffix] + self.front[suffix] - np.repeat([o for _, o in found], [len(w) for w, _ in found])
        # Windows of one suffix that overlap are one span.
        order = np.lexsort((start, suffix))
        suffix, start = suffix[order], start[order]
        new = np.concatenate([[True], (suffix[1:] != suffix[:-1]) | (start[1:] > start[:-1] + WINDOW)])
        heads = np.flatnonzero(new)
        return suffix[heads], start[heads], start[np.append(heads[1:], len(start)) - 1] + WINDOW


# --- Spark -------------------------------------------------------------------------------------------------------------

_PACKED = "bucket int, data binary, lengths binary, front binary, okeys binary, tags binary, first binary, done boolean"
_SPANS = "__okey long, tag long, start long, stop long"


def _tags(shas: pa.Array) -> np.ndarray:
    """The first eight bytes of each hash, in the hash's order."""
    return np.array([int.from_bytes(s[:8], "big") for s in shas.to_pylist()], U64)


def _splitters(base: DataFrame, places: DataFrame, n: int) -> np.ndarray:
    """Anchors' own bytes that cut the suffixes into about equal parts; a bounded sample of documents comes to the driver."""
    sample = hash_sample(places.select("__okey"), "__okey", SAMPLED_DOCS, "splitters")
    rows = base.select("__okey", "text").join(F.broadcast(sample.join(places, "__okey")), "__okey").select("__okey", "text", "__places")

    def leads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, at in text_slices(batch):
                found = known_anchors(byte_anchors(data, at)[0], at, part.column("__places"))
                raw = [data[a : a + K].tobytes() for a in found.at.tolist()]
                yield pa.RecordBatch.from_arrays([pa.array(raw, pa.binary())], ["lead"])

    got = hash_sample(rows.mapInArrow(leads, "lead binary").select(F.hex("lead").alias("lead")), "lead", SAMPLED_LEADS, "leads").collect()
    ordered = np.sort(np.array([bytes.fromhex(r.lead) for r in got], f"S{K}"))
    return np.unique(ordered[np.linspace(0, len(ordered) - 1, n + 1).astype(int)[1:-1]]) if len(ordered) else ordered


def repeated_spans(base: DataFrame, firsts: DataFrame) -> DataFrame:
    """__okey and __spans (tag, start, stop): bytes of first texts to remove, in any order, overlapping."""
    spark = base.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    places = repeated_anchors(base, firsts, byte_anchors)
    splitters = _splitters(base, places, n)
    facts = firsts.join(places, "__okey")
    rows = with_facts(base.select("__okey", "__sha", "text"), facts).filter(IS_FIRST).select("__okey", "__sha", "text", "__places")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, at in text_slices(batch):
                found = known_anchors(byte_anchors(data, at)[0], at, part.column("__places"))
                if len(found.at):
                    yield from _packed(found, data, at, part, splitters, n)

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            for _, data, lengths, front, okeys, tags, first, done in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                arrays = [np.frombuffer(x, t) for x, t in ((data, np.uint8), (lengths, np.int64), (front, np.int64), (okeys, np.int64), (tags, U64), (first, np.int64))]
                if done:
                    yield _spans(arrays[3], arrays[4], arrays[5], arrays[5] + arrays[1])
                else:
                    held.append(arrays)
        if held:
            bucket = SuffixBucket(*(np.concatenate(x) for x in zip(*held, strict=True)))
            held.clear()
            suffix, start, stop = bucket.repeats()
            yield _spans(bucket.okeys[suffix], bucket.tags[suffix], start, stop)

    spans = rows.mapInArrow(cut, _PACKED).repartitionById(n, "bucket").mapInArrow(settle, _SPANS)
    return stored(spans.groupBy("__okey").agg(F.collect_list(F.struct("tag", "start", "stop")).alias("__spans")))


def _packed(found: Anchors, data: np.ndarray, at: np.ndarray, part: pa.RecordBatch, splitters: np.ndarray, n: int) -> Iterator[pa.RecordBatch]:
    """Suffixes of a slice by bucket. Of equal ones only the earliest is sent on; the others' strings all start earlier."""
    okeys, tags = part.column("__okey").to_numpy()[found.row], _tags(part.column("__sha"))[found.row]
    first, lengths, front = found.first, found.last - found.first + WINDOW, found.at - found.first
    same = span_hashes(data, first, lengths) + mix(front.astype(U64))
    place = first - at[found.row]
    order = np.lexsort((place, tags, okeys, same))
    head = np.concatenate([[True], same[order][1:] != same[order][:-1]])
    earliest = order[np.flatnonzero(head)[np.cumsum(head) - 1]]
    # The same place once more, in a row that repeats the document, is no later one.
    alike = (okeys[order] == okeys[earliest]) & (tags[order] == tags[earliest]) & (place[order] == place[earliest])
    order, later = order[head | ~alike], ~head[head | ~alike]
    lead = data[found.at[:, None] + np.arange(K)].view(f"S{K}")[:, 0]
    bucket = np.searchsorted(splitters, lead, "right")
    rows = []
    for which, to, done in ((order[~later], bucket, False), (order[later], okeys % n, True)):
        if not len(which):
            continue
        which = which[np.argsort(to[which], kind="stable")]
        heads = np.flatnonzero(np.concatenate([[True], to[which][1:] != to[which][:-1]]))
        for low, high in zip(heads, np.append(heads[1:], len(which)), strict=True):
            i = which[low:high]
            text = b"" if done else data[ranges(first[i], lengths[i])].tobytes()
            arrays = (lengths[i], front[i], okeys[i], tags[i], place[i])
            rows.append((int(to[i[0]]), text, *(a.tobytes() for a in arrays), done))
    kinds = (pa.int32(), *[pa.binary()] * 6, pa.bool_())
    names = ["bucket", "data", "lengths", "front", "okeys", "tags", "first", "done"]
    columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
    yield pa.RecordBatch.from_arrays(columns, names)


def _spans(okeys: np.ndarray, tags: np.ndarray, start: np.ndarray, stop: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(okeys), pa.array(tags.view(np.int64)), pa.array(start), pa.array(stop)], ["__okey", "tag", "start", "stop"])


def united(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans in order, those that overlap or touch put together."""
    out: list[tuple[int, int]] = []
    for start, stop in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(stop, out[-1][1]))
        else:
            out.append((start, stop))
    return out


def _texts_and_spans(batch: pa.RecordBatch) -> Iterator[tuple[bytes, list[tuple[int, int]]]]:
    """Every row's bytes and the spans to take out of them."""
    raw = batch.column("text").cast(pa.binary()).to_pylist()
    shas, firsts, spans = (batch.column(c).to_pylist() for c in ("__sha", "__firsts", "__spans"))
    for text, sha, first, found in zip(raw, shas, firsts, spans, strict=True):
        text = text or b""
        if sha not in (first or ()):
            yield text, [(0, len(text))] if len(text) >= WINDOW else []
        else:
            tag = int(np.frombuffer(sha[:8], ">u8").astype(U64).view(np.int64)[0])
            yield text, united([(s["start"], s["stop"]) for s in found or () if s["tag"] == tag])


def _kept(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    edges = [0, *(e for s in spans for e in s), len(text)]
    return b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))


def _with_spans(docs: DataFrame) -> DataFrame:
    base = bucketed(docs)
    firsts = first_texts(base)
    facts = firsts.join(repeated_spans(base, firsts), "__okey", "left")
    return with_facts(base, facts, "left")


def removal_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(len(t), sum(b - a for a, b in s), len(s), hashlib.sha256(_kept(t, s)).hexdigest()) for t, s in _texts_and_spans(batch)]
            if rows:
                columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), (*[pa.int64()] * 3, pa.string()), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = _with_spans(docs.select("doc_id", "text")).select("doc_id", "text", "__sha", "__firsts", "__spans")
    return rows.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def without_repeats(docs: DataFrame) -> DataFrame:
    """The documents with repeated strings taken out of `text`, all columns kept. Where a cut leaves part of a character behind,
    that part goes too, so the text stays text. Null stays null."""

    names, schema = docs.columns, docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [_kept(t, s).decode(errors="ignore") if s else None for t, s in _texts_and_spans(batch)]
            old = batch.column("text")
            new = pa.array([o if t is None else t for t, o in zip(texts, old.to_pylist(), strict=True)], old.type)
            yield pa.RecordBatch.from_arrays([new if c == "text" else batch.column(c) for c in names], names)

    return _with_spans(docs).select(*names, "__sha", "__firsts", "__spans").mapInArrow(run, schema)


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removal_report(table(spark, sf_dir, "documents"))


OP2_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
places AS (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 99)) AS i FROM d WHERE len(h) >= 200),
strings AS (SELECT doc_id, i, md5(substr(h, 2 * i + 1, 200)) AS s FROM places),
repeated AS (SELECT doc_id, i FROM strings QUALIFY row_number() OVER (PARTITION BY s ORDER BY doc_id, i) > 1),
steps AS (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM repeated),
runs AS (SELECT doc_id, i, sum(CASE WHEN before IS NULL OR i > before + 100 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM steps),
spans AS (SELECT doc_id, run, min(i) AS low, max(i) + 100 AS high FROM runs GROUP BY doc_id, run),
edges AS (
  SELECT doc_id, low, high, coalesce(lag(high) OVER (PARTITION BY doc_id ORDER BY low), 0) AS from_byte FROM spans),
cuts AS (
  SELECT doc_id, count(*) AS n_spans, sum(high - low) AS n_removed, max(high) AS last,
         string_agg(substr(h, 2 * from_byte + 1, 2 * (low - from_byte)), '' ORDER BY low) AS kept
  FROM edges JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN cuts USING (doc_id)
"""
