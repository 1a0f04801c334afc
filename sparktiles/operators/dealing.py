"""Dealing tiles out to tasks in ranges of the Hilbert curve, by how many rows they have."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.projection import with_tile_id, zoom_start

# Stretches of the curve that are counted at first, and into how many a crowded one is cut each time, in bits.
COARSE_BITS, FINE_BITS = 14, 5


def curve_bounds(counts: DataFrame, parts: int, maxzoom: int) -> list[int]:
    """First ids of all ranges but the first, for about equal sums of `n` over `zoom, tile_x, tile_y`.

    Rows are added up per stretch of the curve; stretches with more than a range's share are cut further, so the driver gets a number of
    sums that depends on `parts`, never on the number of tiles.
    """
    if parts < 2:
        return []
    ids = with_tile_id(counts.select("zoom", "tile_x", "tile_y", "n")).select("tile_id", "n")
    shift = max(0, (zoom_start(maxzoom + 1) - 1).bit_length() - COARSE_BITS)
    found = _sums(ids, shift)
    total = sum(n for _, n in found)
    share = max(1, -(-total // parts))
    done: list[tuple[int, int]] = []
    while True:
        done += [(block << shift, n) for block, n in found if n <= share or not shift]
        heavy = [block for block, n in found if n > share] if shift else []
        if not heavy:
            break
        finer = max(0, shift - FINE_BITS)
        chosen = counts.sparkSession.createDataFrame([(b,) for b in heavy], "_block long")
        inside = ids.withColumn("_block", F.shiftright("tile_id", shift)).join(F.broadcast(chosen), "_block").select("tile_id", "n")
        found, shift = _sums(inside, finer), finer
    starts, sums = np.array(sorted(done), np.int64).reshape(-1, 2).T
    # A stretch goes to the range in which its middle row lies.
    task = np.minimum((np.cumsum(sums) - (sums + 1) // 2) // share, parts - 1)
    firsts = np.flatnonzero(np.diff(task, prepend=0))
    return [int(s) for s in starts[firsts]]


def _sums(ids: DataFrame, shift: int) -> list[tuple[int, int]]:
    return [tuple(r) for r in ids.groupBy(F.shiftright("tile_id", shift).alias("b")).agg(F.sum("n").alias("n")).collect()]


def range_of(tile_id: str, bounds: list[int]) -> Column:
    """The number of the range an id lies in, found in two steps of about the square root of their number."""
    if not bounds:
        return F.lit(0)
    width = int(len(bounds) ** 0.5) + 1
    rows = [bounds[i : i + width] for i in range(0, len(bounds), width)]
    firsts = F.array(*(F.lit(r[0]).cast("long") for r in rows))
    table = F.array(*(F.array(*(F.lit(b).cast("long") for b in r)) for r in rows))
    upto = F.size(F.filter(firsts, lambda b: b <= F.col(tile_id)))
    inside = F.size(F.filter(F.element_at(table, F.greatest(upto, F.lit(1))), lambda b: b <= F.col(tile_id)))
    return F.when(upto == 0, F.lit(0)).otherwise((upto - 1) * width + inside)


def by_range(rows: DataFrame, bounds: list[int], *order: str) -> DataFrame:
    """Rows with `zoom, tile_x, tile_y` in ranges of the curve, in curve order (then `order`) inside each."""
    dealt = with_tile_id(rows).withColumn("_range", range_of("tile_id", bounds))
    return dealt.repartitionById(len(bounds) + 1, "_range").sortWithinPartitions("tile_id", *order).drop("tile_id", "_range")
