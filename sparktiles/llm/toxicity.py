"""Toxicity by a factorization machine over hashed terms.

Terms are words in lower case and their first 4, 5 and 6 bytes, hashed to 2^TERM_BITS. Document counts of each term on toxic and
other training rows tell which terms say anything; up to MODEL_TERMS of them are features, present or absent. The machine adds a
weight per term and, for every pair of terms in a text, the product of two learned vectors, computed as half of (square of the
sum - sum of squares); so an insult next to a group's name can weigh more than both alone.

It is fitted on at most TRAIN_ROWS labelled rows; the counts are added up by Spark, and what reaches the one fitting task is a
short list of features per row. Every document is scored over its whole text. A null or empty text gets the bias alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_map, fold, hash_sample, span_hashes, stored, table, text_slices

TERM_BITS = 18
#: Labelled rows that the machine is fitted on, and terms that it knows, at most.
TRAIN_ROWS, MODEL_TERMS = 20_000, 4096
#: Standard deviations that a term's share of toxic rows must be off the mean.
CLEAR = 4.0
FACTORS, EPOCHS, RATE, DECAY = 8, 12, 0.1, 1e-4
HOLD_OUT = 5

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LETTER = np.zeros(256, bool)
_LETTER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def terms(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed terms of a slice's texts and the row of each, repeats included."""
    inside = _LETTER[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[at] = True
    starts = np.flatnonzero(inside & (edge[:-1] | ~np.concatenate([[False], inside[:-1]]))) if len(data) else np.zeros(0, np.int64)
    ends = np.flatnonzero(inside & (edge[1:] | ~np.concatenate([inside[1:], [False]]))) + 1 if len(data) else starts
    rows = np.searchsorted(at, starts, "right") - 1
    low, lengths = _LOWER[data], ends - starts
    found, of = [span_hashes(low, starts, lengths)], [rows]
    for n in (4, 5, 6):
        longer = lengths > n
        # The length goes into the hash, so a first part is not the same term as a word of that length.
        found.append(span_hashes(low, starts[longer], np.full(int(longer.sum()), n)) * np.uint64(0x9E3779B97F4A7C15))
        of.append(rows[longer])
    return (np.concatenate(found) >> np.uint64(64 - TERM_BITS)).astype(np.int64), np.concatenate(of)


@dataclass
class Machine:
    """Place of each hashed term among the features (-1: none), and what was learned."""

    places: np.ndarray
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def features(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct features of each row: (rows, features), by row."""
        found, rows = terms(data, at)
        feature = self.places[found]
        known = feature >= 0
        n = max(1, len(self.weights))
        pairs = np.unique(rows[known] * n + feature[known])
        return pairs // n, pairs % n

    def score(self, rows: np.ndarray, features: np.ndarray, n: int) -> np.ndarray:
        z = self.bias + np.bincount(rows, self.weights[features], minlength=n)
        for v in self.factors.T:
            x = v[features]
            z += 0.5 * (np.bincount(rows, x, minlength=n) ** 2 - np.bincount(rows, x * x, minlength=n))
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit_machine(lists: list[np.ndarray], labels: np.ndarray, n_features: int, seed: int = 3) -> tuple[float, np.ndarray, np.ndarray]:
    """Bias, weights and factors by adaptive gradient steps on batches of rows, always in the same order."""
    draw = np.random.default_rng(seed)
    weights, factors = np.zeros(n_features), draw.normal(0, 0.05, (n_features, FACTORS))
    share = (labels.sum() + 0.5) / (len(labels) + 1)
    bias = float(np.log(share / (1 - share)))
    seen_w, seen_v, seen_b = np.full(n_features, 1e-6), np.full((n_features, FACTORS), 1e-6), 1e-6
    for _ in range(EPOCHS if n_features else 0):
        order = draw.permutation(len(lists))
        for low in range(0, len(order), 256):
            some = order[low : low + 256]
            counts = np.array([len(lists[i]) for i in some])
            features = np.concatenate([lists[i] for i in some]).astype(np.int64)
            rows = np.repeat(np.arange(len(some)), counts)
            v = factors[features]
            total = np.zeros((len(some), FACTORS))
            np.add.at(total, rows, v)
            squares = np.zeros(len(some))
            np.add.at(squares, rows, (v * v).sum(axis=1))
            z = bias + np.bincount(rows, weights[features], minlength=len(some)) + 0.5 * ((total * total).sum(axis=1) - squares)
            off = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - labels[some]) / len(some)
            grad_w = np.bincount(features, off[rows], minlength=n_features) + DECAY * weights / len(order) * len(some)
            grad_v = np.zeros((n_features, FACTORS))
            np.add.at(grad_v, features, off[rows, None] * (total[rows] - v))
            grad_v += DECAY * factors
            seen_w, seen_v, seen_b = seen_w + grad_w**2, seen_v + grad_v**2, seen_b + off.sum() ** 2
            weights -= RATE * grad_w / np.sqrt(seen_w)
            factors -= RATE * grad_v / np.sqrt(seen_v)
            bias -= RATE * float(off.sum() / np.sqrt(seen_b))
    return bias, weights, factors


# --- Spark -------------------------------------------------------------------------------------------------------------


def labelled(labels: DataFrame, train: Column | None = None, most: int = TRAIN_ROWS) -> DataFrame:
    """doc_id and toxic (0/1) of the training sample: one row per id, the highest of its labels, null labels left out."""
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    if train is not None:
        known = known.filter(train)
    rows = known.groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("__toxic"))
    return hash_sample(rows, "doc_id", most, "toxic")


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents per term, toxic and all, and the numbers of documents in row -1."""
    counts = np.zeros((2, 1 << TERM_BITS), np.int64)
    rows = np.zeros(2, np.int64)
    for batch in batches:
        for part, data, at in text_slices(batch):
            toxic = part.column("__toxic").to_numpy(zero_copy_only=False) == 1
            found, of = terms(data, at)
            pairs = np.unique((of << TERM_BITS) | found)
            found, of = pairs & ((1 << TERM_BITS) - 1), pairs >> TERM_BITS
            counts[0] += np.bincount(found[toxic[of]], minlength=1 << TERM_BITS)
            counts[1] += np.bincount(found, minlength=1 << TERM_BITS)
            rows += [toxic.sum(), len(toxic)]
    used = np.flatnonzero(counts[1])
    if rows[1]:
        columns = [np.concatenate([[-1], used]), *(np.concatenate([[n], c[used]]) for n, c in zip(rows, counts, strict=True))]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["term", "n_toxic", "n"])


def fit(docs: DataFrame, sample: DataFrame) -> Machine:
    """Learn from the texts of the sampled ids. The sample is broadcast: TRAIN_ROWS rows at most."""
    rows = stored(docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("text", "__toxic"))
    counts = stored(
        rows.mapInArrow(_count_terms, "term long, n_toxic long, n long").groupBy("term").agg(F.sum("n_toxic").alias("n_toxic"), F.sum("n").alias("n"))
    )
    total = counts.filter("term = -1").first()
    places = np.full(1 << TERM_BITS, -1, np.int64)
    if total is None or total.n_toxic in (0, total.n):
        share = (total.n_toxic + 0.5) / (total.n + 1) if total else 0.5 / 1000
        return Machine(places, float(np.log(share / (1 - share))), np.zeros(0), np.zeros((0, FACTORS)))
    p = total.n_toxic / total.n
    off = (F.col("n_toxic") - F.col("n") * p) / F.sqrt(F.col("n") * (p * (1 - p)))
    clear = counts.filter("term >= 0 AND n >= 3").withColumn("off", F.abs(off)).filter(F.col("off") >= CLEAR)
    chosen = [r.term for r in clear.orderBy(F.desc("off"), "term").limit(MODEL_TERMS).select("term").collect()]
    places[chosen] = np.arange(len(chosen))
    empty = Machine(places, 0.0, np.zeros(len(chosen)), np.zeros((len(chosen), FACTORS)))
    known = docs.sparkSession.sparkContext.broadcast(empty)

    def make():
        def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for part, data, at in text_slices(batch):
                of, features = known.value.features(data, at)
                cuts = np.searchsorted(of, np.arange(part.num_rows + 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(cuts), pa.array(features.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([part.column("__toxic"), lists], ["toxic", "features"])

        return step

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists, toxic = [], []
        for batch in batches:
            lists += [np.array(x, np.int64) for x in batch.column("features").to_pylist()]
            toxic += batch.column("toxic").to_pylist()
        # Tasks deliver in any order; the fit must not depend on it.
        order = sorted(range(len(lists)), key=lambda i: (toxic[i], lists[i].tobytes()))
        bias, weights, factors = fit_machine([lists[i] for i in order], np.array([toxic[i] for i in order], float), len(chosen))
        blob = np.concatenate([[bias], weights, factors.ravel()]).tobytes()
        yield pa.RecordBatch.from_arrays([pa.array([blob], pa.binary())], ["model"])

    short = arrow_map(rows, make, "toxic int, features array<int>")
    values = np.frombuffer(short.repartition(1).mapInArrow(learn, "model binary").first()[0])
    n = len(chosen)
    return Machine(places, float(values[0]), values[1 : n + 1], values[n + 1 :].reshape(n, FACTORS))


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """doc_id, score and predicted of every row."""
    known = docs.sparkSession.sparkContext.broadcast(machine)

    def make():
        def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for part, data, at in text_slices(batch):
                scores = known.value.score(*known.value.features(data, at), part.num_rows)
                columns = [part.column("doc_id"), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "score", "predicted"])

        return step

    kind = docs.schema["doc_id"].dataType.simpleString()
    return arrow_map(docs.select("doc_id", "text"), make, f"doc_id {kind}, score double, predicted int")


def without_toxic(docs: DataFrame, machine: Machine) -> DataFrame:
    """Rows whose text the machine does not call toxic, with all their columns."""
    known = docs.sparkSession.sparkContext.broadcast(machine)

    def make():
        def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for part, data, at in text_slices(batch):
                scores = known.value.score(*known.value.features(data, at), part.num_rows)
                yield part.filter(pa.array(scores < 0.5))

        return step

    return arrow_map(docs, make, docs.schema)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    machine = fit(docs, labelled(labels, fold("doc_id", HOLD_OUT) != 0))
    held = F.coalesce(fold("doc_id", HOLD_OUT) == 0, F.lit(False))
    return score(docs, machine).select("doc_id", held.alias("held_out"), "score", "predicted")
