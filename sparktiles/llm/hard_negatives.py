"""Hard negatives of labelled vectors, exact, by lists that the anchors of a cluster share.

Anchors are clustered by direction. For a cluster with centre c, whose members lie within an angle t of it, no member u has an inner
product with x above |u| |x| cos(max(0, angle(c, x) - t)). Candidates are sorted by |x| cos(...) once for the cluster; every member
walks that one list from the top, a stretch at a time, and stops when what the bound allows the rest can no longer enter its
results. The walk of positives goes over the anchor's own label and keeps the best; that of negatives goes over the other labels and
keeps, for each positive, the best inside its band of scores.

Spark deals the work out as a grid: groups of anchors by blocks of candidates, both of bounded size, so that a cell is one task's work
whatever the labels or clusters look like. Anchors go to all blocks, candidates to all groups; a cell returns a few rows for each
anchor, and a window over anchors keeps the first of them. The centres are fitted on at most FIT_ROWS anchors; they only steer how
far lists are walked, never what is found.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import arrow_map, hash_sample, stored, table

ANCHOR_EVERY = 50
POSITIVES, NEGATIVES = 5, 3
#: A negative's score in hundredths of the positive's.
LOWEST, HIGHEST = 50, 95
CLUSTERS, FIT_ROWS, FIT_ROUNDS = 16, 4096, 8
GROUP_ROWS, BLOCK_ROWS = 1 << 14, 1 << 16
STRETCH = 512
NONE = np.iinfo(np.int64).min
#: Scores are made in doubles and must be whole numbers below this.
EXACT = float(1 << 53)


# --- Vectors -----------------------------------------------------------------------------------------------------------


def whole_vectors(embeddings: DataFrame) -> DataFrame:
    """vec_id, label and `q` (floor(256 x) of every component, x as double) of the rows that take part."""
    x = F.col("embedding").cast("array<double>")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    part = embeddings.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite)
    label = F.col("label").cast("long")
    return part.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"),
        F.transform(x, lambda v: F.floor(v * 256.0).cast("long")).alias("q"),
    )


def matrix(rows: list) -> np.ndarray:
    """Vectors as rows of doubles; shorter ones end in zeros."""
    width = max((len(r) for r in rows), default=0)
    out = np.zeros((len(rows), width))
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out


def _same_width(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    width = max(a.shape[1], b.shape[1])
    return tuple(np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (a, b))


def _unit(m: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, norm, out=np.zeros_like(m), where=norm > 0)


def fit_centres(m: np.ndarray, k: int = CLUSTERS, rounds: int = FIT_ROUNDS) -> np.ndarray:
    """Unit centres by spherical k-means, begun at points that are far from each other; fewer than k where directions repeat."""
    unit = _unit(m)
    unit = unit[np.linalg.norm(unit, axis=1) > 0]
    if not len(unit):
        return np.zeros((1, m.shape[1]))
    centres = unit[:1]
    near = unit @ centres[0]
    while len(centres) < k and near.min() < 1 - 1e-9:
        centres = np.vstack([centres, unit[near.argmin()]])
        near = np.maximum(near, unit @ centres[-1])
    for _ in range(rounds):
        own = (unit @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, unit)
        moved = _unit(sums)
        centres = np.where(np.linalg.norm(moved, axis=1, keepdims=True) > 0, moved, centres)
    return centres


# --- Walks -------------------------------------------------------------------------------------------------------------


class Best:
    """The best `k` (score, id) of each of n rows: higher scores first, then smaller ids."""

    def __init__(self, n: int, k: int) -> None:
        self.score, self.id = np.full((n, k), NONE), np.full((n, k), np.iinfo(np.int64).max)

    @property
    def last(self) -> np.ndarray:
        return self.score[:, -1]

    def offer(self, rows: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        """`score` (rows by candidates, NONE where not allowed) of candidates `ids`."""
        k = self.score.shape[1]
        at, which = np.nonzero((score >= self.last[rows][:, None]) & (score > NONE))
        if not len(at):
            return
        rows_at = rows[at]
        touched = np.unique(rows_at)
        row = np.concatenate([rows_at, np.repeat(touched, k)])
        value = np.concatenate([score[at, which], self.score[touched].ravel()])
        ident = np.concatenate([ids[which], self.id[touched].ravel()])
        order = np.lexsort((ident, -np.maximum(value, NONE + 1), row))
        row, value, ident = row[order], value[order], ident[order]
        starts = np.searchsorted(row, touched)
        first = starts[:, None] + np.arange(k)
        self.score[touched], self.id[touched] = value[first], ident[first]


def cosine_limit(centre: np.ndarray, members: np.ndarray, candidates: np.ndarray, norms: np.ndarray) -> np.ndarray:
    """For each candidate, what no unit-length member's inner product with it can exceed."""
    spread = np.arccos(np.clip((_unit(members) @ centre).min(), -1, 1)) if centre.any() else np.pi
    cosine = np.divide(candidates @ centre, norms, out=np.ones(len(norms)), where=norms > 0)
    angle = np.arccos(np.clip(cosine, -1, 1))
    return norms * np.cos(np.maximum(0, angle - spread - 1e-6)) if centre.any() else norms


class Lists:
    """A block of candidates in the order of a cluster's bound."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, bound: np.ndarray) -> None:
        order = np.argsort(-bound, kind="stable")
        self.ids, self.vectors, self.bound, self.order = ids[order], vectors[order], bound[order], order

    def stretches(self) -> Iterator[slice]:
        for low in range(0, len(self.ids), STRETCH):
            yield slice(low, low + STRETCH)


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.rint(a @ b.T).astype(np.int64)


def walk_positives(ids: np.ndarray, members: np.ndarray, lists: Lists, k: int = POSITIVES) -> Best:
    """The best of candidates of one label for members of that label, never a row of the member's own id."""
    best, norms, active = Best(len(ids), k), np.linalg.norm(members, axis=1), np.arange(len(ids))
    for part in lists.stretches():
        limit = norms[active] * lists.bound[part.start]
        active = active[best.last[active] <= limit + 1 + 1e-6 * np.abs(limit)]
        if not len(active):
            break
        score = inner(members[active], lists.vectors[part])
        score[ids[active][:, None] == lists.ids[part][None, :]] = NONE
        best.offer(active, score, lists.ids[part])
    return best


def walk_negatives(labels: np.ndarray, members: np.ndarray, positives: np.ndarray, lists: Lists, list_labels: np.ndarray, k: int = NEGATIVES) -> list[Best]:
    """For each column of positive scores (NONE: none), the best candidates of other labels within its band."""
    low = -((-LOWEST * positives) // 100)
    high = HIGHEST * positives // 100
    real = (positives > NONE) & (low <= high)
    low, high = np.where(real, low, np.iinfo(np.int64).max), np.where(real, high, NONE)
    best = [Best(len(members), k) for _ in range(positives.shape[1])]
    norms, active = np.linalg.norm(members, axis=1), np.flatnonzero(real.any(axis=1))
    for part in lists.stretches():
        limit = norms[active] * lists.bound[part.start]
        limit = limit + 1 + 1e-6 * np.abs(limit)
        # What a positive still needs: its band's low end, or its last result so far; the least of its row counts.
        needs = np.column_stack([np.where(real[active, j], np.maximum(low[active, j], b.last[active]), np.iinfo(np.int64).max) for j, b in enumerate(best)])
        active = active[needs.min(axis=1) <= limit]
        if not len(active):
            break
        score = inner(members[active], lists.vectors[part])
        score[labels[active][:, None] == list_labels[lists.order[part]][None, :]] = NONE
        for j, b in enumerate(best):
            fit = (score >= low[active, j][:, None]) & (score <= high[active, j][:, None])
            if fit.any():
                b.offer(active, np.where(fit, score, NONE), lists.ids[part])
    return best


def _check(a: np.ndarray, b: np.ndarray) -> None:
    if len(a) and len(b) and np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * max(a.shape[1], 1) >= EXACT:
        raise ValueError("components too large: inner products must stay below 2^53")


def _cluster_lists(anchors: pd.DataFrame, block: pd.DataFrame, centres: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For each cluster of the anchors: their rows, their vectors, and the candidates' ids, vectors and bounds."""
    members, candidates = _same_width(matrix(list(anchors["q"])), matrix(list(block["q"])))
    _check(members, candidates)
    members, centres = _same_width(members, centres)
    candidates, _ = _same_width(candidates, centres)
    norms, ids = np.linalg.norm(candidates, axis=1), block["vec_id"].to_numpy()
    cluster = anchors["cluster"].to_numpy()
    for c in np.unique(cluster):
        rows = np.flatnonzero(cluster == c)
        yield rows, members[rows], ids, candidates, cosine_limit(centres[c], members[rows], candidates, norms)


def positives_of_cell(anchors: pd.DataFrame, block: pd.DataFrame, centres: np.ndarray) -> pd.DataFrame:
    out, labels, block_labels = [], anchors["label"].to_numpy(), block["label"].to_numpy()
    ids, aids = anchors["vec_id"].to_numpy(), anchors["aid"].to_numpy()
    for rows, members, list_ids, vectors, bound in _cluster_lists(anchors, block, centres):
        for label in np.unique(labels[rows]):
            mine, theirs = labels[rows] == label, np.flatnonzero(block_labels == label)
            best = walk_positives(ids[rows[mine]], members[mine], Lists(list_ids[theirs], vectors[theirs], bound[theirs]))
            at, slot = np.nonzero(best.score > NONE)
            out.append(pd.DataFrame({"aid": aids[rows[mine][at]], "positive_id": best.id[at, slot], "positive_score": best.score[at, slot]}))
    return pd.concat(out) if out else pd.DataFrame({"aid": [], "positive_id": [], "positive_score": []}, dtype="int64")


def negatives_of_cell(anchors: pd.DataFrame, block: pd.DataFrame, centres: np.ndarray) -> pd.DataFrame:
    out, labels, block_labels, aids = [], anchors["label"].to_numpy(), block["label"].to_numpy(), anchors["aid"].to_numpy()
    scores = np.full((len(anchors), POSITIVES), NONE)
    for i, found in enumerate(anchors["positive_scores"]):
        scores[i, : len(found)] = found
    for rows, members, list_ids, vectors, bound in _cluster_lists(anchors, block, centres):
        for j, best in enumerate(walk_negatives(labels[rows], members, scores[rows], Lists(list_ids, vectors, bound), block_labels)):
            at, slot = np.nonzero(best.score > NONE)
            out.append(pd.DataFrame({"aid": aids[rows[at]], "slot": np.full(len(at), j), "negative_id": best.id[at, slot], "negative_score": best.score[at, slot]}))
    return pd.concat(out) if out else pd.DataFrame({"aid": [], "slot": [], "negative_id": [], "negative_score": []}, dtype="int64")


# --- Spark -------------------------------------------------------------------------------------------------------------


def clustered(anchors: DataFrame, centres: np.ndarray) -> DataFrame:
    """Anchors with the number of their nearest centre."""
    schema = anchors.schema

    def make():
        def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            own, known = _same_width(matrix(batch.column("q").to_pylist()), centres)
            yield batch.append_column("cluster", pa.array((_unit(own) @ known.T).argmax(axis=1).astype(np.int32)))

        return step

    return arrow_map(anchors, make, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema) + ", cluster int")


def _grid(anchors: DataFrame, candidates: DataFrame, groups: int, blocks: int, cell, schema: str, centres: np.ndarray) -> DataFrame:
    """`cell(anchors, block, centres)` for every group of anchors and block of candidates."""
    everywhere = anchors.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).withColumn("group", _dealt("aid", groups))
    to_all = candidates.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).withColumn("block", F.pmod(F.xxhash64("vec_id", "label", "q"), F.lit(blocks)).cast("int"))

    def run(a: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        return cell(a, c, centres)

    return everywhere.groupBy("group", "block").cogroup(to_all.groupBy("group", "block")).applyInPandas(run, schema)


def _dealt(key: str, parts: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")


def mine(embeddings: DataFrame, anchor_every: int = ANCHOR_EVERY, group_rows: int = GROUP_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    `embeddings`: vec_id, embedding and label; other columns are ignored. Rows with a null id, label, vector or component, or one that is not
    finite, take no part; an empty vector is zero, and of vectors of different lengths the shorter ends in zeros. Other rows are those
    of another vec_id; a row that repeats an anchor whole is the same anchor, while repeated candidates each take a place. An anchor without
    positives, or a positive without negatives in its band (always where its score is below 0), gives no row. Inner products of
    2^53 or more are an error."""
    rows = stored(whole_vectors(embeddings))
    anchors = rows.filter(F.col("vec_id") % anchor_every == 0).distinct().withColumn("aid", F.xxhash64("vec_id", "label", "q"))
    sample = hash_sample(anchors, "aid", FIT_ROWS, "centres").select("q").toArrow().column("q").to_pylist()
    centres = fit_centres(matrix(sample))
    anchors = stored(clustered(anchors, centres))
    groups = max(1, -(-anchors.count() // group_rows))
    blocks = max(1, -(-rows.count() // block_rows), _parallel(rows))

    found = _grid(anchors, rows, groups, blocks, positives_of_cell, "aid long, positive_id long, positive_score long", centres)
    order = Window.partitionBy("aid").orderBy(F.desc("positive_score"), "positive_id")
    # Numbered within a subset as well, so that the number is both the limit and the slot.
    found = found.withColumn("slot", F.row_number().over(order)).filter(F.col("slot") <= POSITIVES)
    positives = stored(found.withColumn("slot", F.col("slot") - 1))
    scores = positives.groupBy("aid").agg(F.transform(F.array_sort(F.collect_list(F.struct("slot", "positive_score"))), lambda s: s["positive_score"]).alias("positive_scores"))

    searching = anchors.join(scores, "aid")
    negatives = _grid(searching, rows, groups, blocks, negatives_of_cell, "aid long, slot int, negative_id long, negative_score long", centres)
    order = Window.partitionBy("aid", "slot").orderBy(F.desc("negative_score"), "negative_id")
    ranked = negatives.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= NEGATIVES)
    named = positives.join(anchors.select("aid", F.col("vec_id").alias("anchor_id")), "aid")
    return ranked.join(named, ["aid", "slot"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def _parallel(rows: DataFrame) -> int:
    """Enough blocks that small tables occupy the cores, but none below 4,096 rows."""
    spark = rows.sparkSession
    return min(int(spark.sparkContext.defaultParallelism), -(-rows.count() // 4096))


#: The same over all pairs, for tables small enough for it.
OP13_SQL = """
WITH valid AS (
  SELECT CAST(vec_id AS BIGINT) AS vec_id,
         CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE CAST(label AS BIGINT) END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0
), pairs AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM valid a JOIN valid b ON a.vec_id <> b.vec_id
  WHERE a.vec_id % 50 = 0
), positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score
  FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.other_id) AS INTEGER) AS rank,
       n.other_id AS negative_id, p.positive_score, n.score AS negative_score
FROM positives p JOIN pairs n ON p.anchor_id = n.anchor_id AND NOT n.same
 AND 50 * p.positive_score <= 100 * n.score AND 100 * n.score <= 95 * p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.other_id) <= 3
"""


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine(table(spark, sf_dir, "embeddings"))
