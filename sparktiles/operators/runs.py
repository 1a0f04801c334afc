"""Tile tables along the Hilbert curve: identical runs and empty tiles (DEC-7, DEC-10)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import materialise

# Rows are ordered in blocks of 2^16 ids, which bounds what one task has to sort; runs go on over the edges of blocks.
RUN_BITS = 16
# A run is expanded in stretches of 2^16 ids, and a longer one in stretches of those, so that no row ever holds more numbers.
STRETCH_BITS = (48, 32, 16)


def drop_empty(tiles: DataFrame) -> DataFrame:
    """DEC-10."""
    return tiles.filter(F.octet_length("tile_data") > 0)


def collapse_runs(tiles: DataFrame, payload: str = "tile_data", bits: int = RUN_BITS) -> DataFrame:
    """DEC-7 on write: consecutive `tile_id`s with equal payloads become one row with `run_length`.

    Payloads are compared by a 256-bit digest. Runs are found block by block; then those that touch an edge of their block, two per
    block at most, are joined across edges in slices of the curve (`_joined_edges`).
    """
    block = F.shiftright("tile_id", bits)
    w = Window.partitionBy("_b").orderBy("tile_id")
    hashed = tiles.withColumns({"_b": block, "_h": F.sha2(F.col(payload).cast("binary"), 256)})
    follows = (F.lag("tile_id").over(w) == F.col("tile_id") - 1) & F.lag("_h").over(w).eqNullSafe(F.col("_h"))
    starts = hashed.withColumn("_start", F.when(~F.coalesce(follows, F.lit(False)), F.col("tile_id")))
    runs = starts.withColumn("_run", F.last("_start", ignorenulls=True).over(w))
    within = materialise(
        runs.groupBy("_b", F.col("_run").alias("tile_id")).agg(F.count("*").alias("run_length"), F.first("_h").alias("_h"), F.first(payload).alias(payload))
    )
    end = F.col("tile_id") + F.col("run_length")
    low = F.shiftleft("_b", bits)
    at_edge = within.filter((F.col("tile_id") == low) | (end == low + (1 << bits))).select("tile_id", "_h", end.alias("_end"))
    whole = within.join(_joined_edges(at_edge), "tile_id", "left").withColumn("_head", F.coalesce("_head", "tile_id"))
    return whole.groupBy(F.col("_head").alias("tile_id")).agg(F.sum("run_length").alias("run_length"), F.first(payload).alias(payload))


def _joined_edges(edges: DataFrame) -> DataFrame:
    """`tile_id` and `_head` of the runs (`tile_id`, `_end`, `_h`) that go on from the one before.

    Ranges of the curve are joined on their own; what one range hands to the next is one row per range, which the driver
    passes along: the end, digest and head of the range's last run.
    """
    ranged = materialise(edges.repartitionByRange("tile_id").withColumn("_p", F.spark_partition_id()))
    line = Window.partitionBy("_p").orderBy("tile_id")
    goes_on = (F.lag("_end").over(line) == F.col("tile_id")) & F.lag("_h").over(line).eqNullSafe(F.col("_h"))
    first = F.lag("tile_id").over(line).isNull()
    heads = ranged.withColumn("_head", F.when(~first & ~F.coalesce(goes_on, F.lit(False)), F.col("tile_id")))
    # No head: the run goes on from the first of its range, whose own head another range may hold.
    heads = heads.withColumn("_head", F.last("_head", ignorenulls=True).over(line))
    ends = heads.groupBy("_p").agg(
        F.min(F.struct("tile_id", "_h")).alias("first"), F.max(F.struct("tile_id", "_end", "_h", "_head")).alias("last")
    )
    carried, before = [], None
    for row in sorted(ends.collect(), key=lambda r: r["first"]["tile_id"]):  # one short row per range
        first, last = row["first"], row["last"]
        joins = before is not None and before[0] == first["tile_id"] and before[1] == first["_h"]
        head = before[2] if joins else first["tile_id"]
        carried.append((row["_p"], head))
        before = last["_end"], last["_h"], head if last["_head"] is None else last["_head"]
    handed = edges.sparkSession.createDataFrame(carried, "_p int, _from long")
    whole = heads.join(F.broadcast(handed), "_p").withColumn("_head", F.coalesce("_head", "_from"))
    return whole.filter("_head <> tile_id").select("tile_id", "_head")


def expand_runs(runs: DataFrame) -> DataFrame:
    """DEC-7 on read: one row per id of each run; a run length below 1 counts as 1."""
    rest = runs.withColumn("_n", F.greatest(F.col("run_length").cast("long"), F.lit(1).cast("long")))
    for bits in STRETCH_BITS:
        step = F.lit(1 << bits).cast("long")
        stretches = F.sequence(F.lit(0).cast("long"), F.shiftright(F.col("_n") - 1, bits))
        cut = rest.withColumn("_at", F.explode(stretches))
        start = F.shiftleft("_at", bits)
        rest = cut.withColumns({"tile_id": F.col("tile_id") + start, "_n": F.least(step, F.col("_n") - start)}).drop("_at")
    last = F.col("tile_id") + F.col("_n") - 1
    return rest.withColumn("tile_id", F.explode(F.sequence("tile_id", last))).drop("run_length", "_n")
