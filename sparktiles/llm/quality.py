"""Quality rules: fixed rules on words and lines, then a log-likelihood ratio between trusted texts and the whole corpus.

Words and pairs of neighbouring words are hashed to a fixed number of buckets. One pass counts the buckets over all documents
(the raw multinomial) and over all documents labelled as good (the target); tasks add their counts up before the shuffle, and the
model is two fixed-length arrays. A second pass scores every document with the mean over its n-grams of log p_target - log p_raw
and keeps those at or above a threshold. The threshold comes from a fifth of the trusted documents that the target is not counted
from: the score that all but 1 % of those reach, less a margin, found by counting. So it follows how well the counts know a good
text that they have not seen, and is the same in every run.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import U64, Words, arrow_map, fold, grams, gram_places, mix, per_row, stored, table, text_slices

BUCKET_BITS = 16
#: The trusted documents that may fall short of the threshold before the margin is taken off it, and that margin.
SHORT, MARGIN = 0.01, 0.08
HELD_OUT = 5
#: Ids of trusted documents are broadcast up to this many; beyond, the texts are moved to them once.
BROADCAST_IDS = 200_000
SMOOTHING = 0.5

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_SCHEMA = "doc_id {}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, score double"


def ngram_buckets(words: Words, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words and word pairs of a slice, and the row of each."""
    places = gram_places(words.offsets, 2)
    pairs = grams(hashes, 2)[places] if len(places) else np.zeros(0, U64)
    rows = words.rows()
    shift = U64(64 - BUCKET_BITS)
    return np.concatenate([hashes >> shift, pairs >> shift]).astype(np.int64), np.concatenate([rows, rows[places]])


def trusted_ids(labels: DataFrame) -> DataFrame:
    """doc_id of all documents whose every label says quality 1, and whether it is held out; a null label says nothing."""
    good = labels.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("q")).filter("q = 1")
    return good.select("doc_id", (fold("doc_id", HELD_OUT) == 0).alias("__held"))


def _buckets(texts: DataFrame, count: str) -> DataFrame:
    """bucket and how often it occurs: one row per bucket that occurs in a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << BUCKET_BITS, np.int64)
        for batch in batches:
            for _, data, at in text_slices(batch):
                words = Words(data, at)
                counts += np.bincount(ngram_buckets(words, words.hashes())[0], minlength=len(counts))
        used = np.flatnonzero(counts)
        if len(used):
            yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], ["bucket", count])

    return texts.select("text").mapInArrow(run, f"bucket long, {count} long")


def count_buckets(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """bucket, n_raw, n_target: one row per bucket that occurs in `docs`. `trusted` has the texts of the trusted documents."""
    raw = _buckets(docs, "n_raw").withColumn("n_target", F.lit(0).cast("long"))
    target = _buckets(trusted.filter(~F.col("__held")), "n_target").select("bucket", F.lit(0).cast("long").alias("n_raw"), "n_target")
    return raw.unionByName(target).groupBy("bucket").agg(F.sum("n_raw").alias("n_raw"), F.sum("n_target").alias("n_target"))


def log_ratios(counts: DataFrame) -> np.ndarray:
    """log p_target - log p_raw by bucket; 0 everywhere when nothing is trusted. At most 2^BUCKET_BITS rows come to the driver."""
    raw, target = np.zeros(1 << BUCKET_BITS), np.zeros(1 << BUCKET_BITS)
    for bucket, n_raw, n_target in counts.collect():
        raw[bucket], target[bucket] = n_raw, n_target
    if not target.any():
        return np.zeros(len(raw))
    smooth = lambda n: np.log(n + SMOOTHING) - np.log(n.sum() + SMOOTHING * len(n))
    return smooth(target) - smooth(raw)


def repeated_words(words: Words, hashes: np.ndarray, size: int = 3) -> np.ndarray:
    """Which words lie in a window of `size` words that the same row has at least twice."""
    places = gram_places(words.offsets, size)
    covered = np.zeros(len(hashes) + 1, np.int64)
    if len(places):
        keys = mix(grams(hashes, size)[places] + words.rows()[places].astype(U64) * U64(0x9E3779B97F4A7C15))
        _, of, counts = np.unique(keys, return_inverse=True, return_counts=True)
        twice = places[counts[of] > 1]
        covered += np.bincount(twice, minlength=len(covered)) - np.bincount(twice + size, minlength=len(covered))
    return np.cumsum(covered)[:-1] > 0


def duplicate_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line of the text."""
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(lines) - len(set(lines))


def assess(docs: DataFrame, ratios: np.ndarray) -> DataFrame:
    """Every document's counts and score. A null or empty text has zero counts and score 0."""
    shared = docs.sparkSession.sparkContext.broadcast(ratios)

    def make():
        def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for part, data, at in text_slices(batch):
                words = Words(data, at)
                hashes = words.hashes()
                buckets, of = ngram_buckets(words, hashes)
                total = np.bincount(of, shared.value[buckets], minlength=part.num_rows)
                n = np.bincount(of, minlength=part.num_rows)
                in_words = np.zeros(len(data) + 1, np.int64)
                np.add.at(in_words, words.starts, 1)
                np.subtract.at(in_words, words.ends, 1)
                points = (np.cumsum(in_words)[:-1] > 0) & ((data & 0xC0) != 0x80)
                raw = memoryview(data)
                lines = [duplicate_lines(bytes(raw[a:b])) for a, b in zip(at[:-1], at[1:], strict=True)]
                columns = [words.counts, per_row(points, at), per_row(_SYMBOL[data], at), np.array(lines, np.int64)]
                columns += [per_row(repeated_words(words, hashes), words.offsets), total / np.maximum(n, 1)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *map(pa.array, columns)], _NAMES)

        return step

    return arrow_map(docs.select("doc_id", "text"), make, _SCHEMA.format(docs.schema["doc_id"].dataType.simpleString()))


_NAMES = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "score"]


#: Stretches that the range of scores is cut into for counting, and so few values are left that they are looked at.
STRETCHES, LEFT = 4096, 10_000


def ranked(scores: DataFrame, rank: int) -> float:
    """The value of `score` at a rank from 0 in ascending order. Values are counted by stretches of their range, then those in the stretch
    that holds the rank, until few or equal ones are left; the driver gets one row per stretch."""
    rows, before = scores, 0
    while True:
        n, low, high = rows.agg(F.count("*"), F.min("score"), F.max("score")).first()
        if low == high:
            return low
        if n <= LEFT:
            return sorted(r.score for r in rows.collect())[rank - before]
        part = F.least(F.floor((F.col("score") - low) / (high - low) * STRETCHES), F.lit(STRETCHES - 1))
        for stretch, found in sorted(tuple(r) for r in rows.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect()):
            if before + found > rank:
                break
            before += found
        rows = rows.filter(part == stretch)


def threshold(trusted: DataFrame, ratios: np.ndarray) -> float:
    """The score to reach; minus infinity when no trusted document is held out."""
    reached = stored(assess(trusted.filter("__held"), ratios).filter("n_words > 0").select("score"))
    place = SHORT * (reached.count() - 1)
    if place < 0:
        return float("-inf")
    low, high = ranked(reached, math.floor(place)), ranked(reached, math.ceil(place))
    # Between the two neighbours, as an exact percentile is.
    return (low if low == high else (math.ceil(place) - place) * low + (place - math.floor(place)) * high) - MARGIN


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document with its counts, `base_failed`, `score` and `kept`."""
    ids = stored(trusted_ids(labels))
    few = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    trusted = stored(docs.select("doc_id", "text").join(F.broadcast(ids) if few else ids, "doc_id"))
    ratios = log_ratios(stored(count_buckets(docs, trusted)))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (
        assess(docs, ratios)
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold(trusted, ratios)))
    )


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
