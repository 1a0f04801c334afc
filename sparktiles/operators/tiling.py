"""Zoom fan-out, thinning, buffering, clustering and density limits over point tables (TIL-1 to TIL-15).

A *point table* has `fid`, `wx`, `wy` and any attributes. A *tile point table* adds `zoom`, `tile_x`, `tile_y` and, after
`quantize_points`, `px`, `py`. Steps before the tile shuffle are projections and generators only. A low-zoom tile can hold
most rows of a table, so no step collects a tile: windows run over tiles only after counting them, and over even slices of the
curve order where a tile is too large.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.projection import WORLD_BITS, quantize, shift_left, shift_right, tile_of, with_morton
from ..options import ACCUMULATORS, MAX_BUILD_ZOOM, MAX_TILE_FEATURES, OptionError
from .tables import materialise

TILE = ["zoom", "tile_x", "tile_y"]


class TooManyFeatures(RuntimeError):
    """A tile that no zoom brings under its limit."""


# A window over one tile sorts at most this many rows in one task; larger ones are cut into slices.
HOT_TILE_ROWS = 1_000_000
# Fixed value: multiplier of the thinning hash.
HASH_MULTIPLIER = 2654435761


# --- TIL-1, TIL-8 ------------------------------------------------------------------------------------------------------


def _zoom_list(every: Column, fixed: Column | None) -> Column:
    """Rows that come with a zoom of their own (shapes already cut into tiles) keep just that one."""
    return every if fixed is None else F.when(fixed.isNotNull(), F.array(fixed)).otherwise(every)


def fan_out(df: DataFrame, minzoom: int, maxzoom: int, fixed: Column | None = None) -> DataFrame:
    """TIL-1: one copy of each row per zoom."""
    return df.withColumn("zoom", F.explode(_zoom_list(F.sequence(F.lit(minzoom), F.lit(maxzoom)), fixed)))


def thinning_hash(fid: Column) -> Column:
    """`fid * 2654435761 mod 2^32`, in halves so that no product leaves a LONG."""
    low = fid.bitwiseAND(F.lit(0xFFFF))
    high = F.shiftright(fid, 16).bitwiseAND(F.lit(0xFFFF))
    mask = F.lit((1 << 32) - 1)
    upper = F.shiftleft((high * HASH_MULTIPLIER).bitwiseAND(mask), 16)
    return (upper + low * HASH_MULTIPLIER).bitwiseAND(mask)


def thin_fan_out(
    df: DataFrame,
    minzoom: int,
    maxzoom: int,
    drop_rate: float = 2.5,
    base_zoom: int | None = None,
    key: Column | None = None,
    fixed: Column | None = None,
) -> DataFrame:
    """TIL-1 and TIL-8 in one step: a row starts at the first zoom that keeps it, so no dropped copy is ever made."""
    base = maxzoom if base_zoom is None else base_zoom
    h = thinning_hash(F.col("fid") if key is None else key)
    first = F.lit(maxzoom + 1)
    # Fixed value: 2^32, the range of the hash.
    for zoom in range(maxzoom, minzoom - 1, -1):
        kept = F.lit(True) if zoom >= base else h < F.lit(2.0**32 / drop_rate ** (base - zoom))
        first = F.when(kept, F.lit(zoom)).otherwise(first)
    start = df.withColumn("_first", first)
    start = start.filter((F.col("_first") <= maxzoom) if fixed is None else (F.col("_first") <= maxzoom) | fixed.isNotNull())
    return start.withColumn("zoom", F.explode(_zoom_list(F.sequence("_first", F.lit(maxzoom)), fixed))).drop("_first")


# --- TIL-2, TIL-4, TIL-7 -----------------------------------------------------------------------------------------------


def assign_tiles(df: DataFrame) -> DataFrame:
    """TIL-2: the one tile that holds each point."""
    z = F.col("zoom")
    return df.withColumns({"tile_x": tile_of(F.col("wx"), z), "tile_y": tile_of(F.col("wy"), z)})


def buffered_tiles(df: DataFrame, buffer: int = 5, fixed: tuple[Column, Column] | None = None) -> DataFrame:
    """TIL-4: every tile whose box, grown by buffer/256 of its side, holds the point. Rows with a `fixed` tile keep it."""
    z = F.col("zoom")
    grow = shift_left(F.lit(buffer).cast("long"), F.lit(24) - z)
    last = shift_left(F.lit(1).cast("long"), z) - 1

    def reach(w: str, given: Column | None) -> Column:
        low = F.greatest(F.lit(0).cast("long"), shift_right(F.col(w) - grow, F.lit(WORLD_BITS) - z)).cast("int")
        high = F.least(last, shift_right(F.col(w) + grow, F.lit(WORLD_BITS) - z)).cast("int")
        tiles = F.when(low == high, F.array(low)).otherwise(F.sequence(low, high))
        return tiles if given is None else F.when(given.isNotNull(), F.array(given)).otherwise(tiles)

    x, y = fixed or (None, None)
    return df.withColumn("tile_x", F.explode(reach("wx", x))).withColumn("tile_y", F.explode(reach("wy", y)))


def quantize_points(df: DataFrame) -> DataFrame:
    """TIL-7 for points."""
    z = F.col("zoom")
    return df.withColumns(
        {"px": quantize(F.col("wx"), F.col("tile_x"), z), "py": quantize(F.col("wy"), F.col("tile_y"), z)}
    )


def tile_pyramid(points: DataFrame, minzoom: int, maxzoom: int) -> DataFrame:
    """Rows per tile and zoom. Each zoom rolls up the one below it, so the points are counted once, not once per zoom."""
    finest = assign_tiles(points.withColumn("zoom", F.lit(maxzoom))).groupBy("tile_x", "tile_y").agg(F.count("*").alias("n"))
    levels = finest.withColumn("zoom", F.explode(F.sequence(F.lit(minzoom), F.lit(maxzoom))))
    up = F.lit(maxzoom) - F.col("zoom")
    return levels.groupBy(
        "zoom", shift_right(F.col("tile_x"), up).alias("tile_x"), shift_right(F.col("tile_y"), up).alias("tile_y")
    ).agg(F.sum("n").alias("n"))


# --- Ordered lookups inside a tile -------------------------------------------------------------------------------------


def tile_counts(df: DataFrame) -> DataFrame:
    return df.groupBy(*TILE).agg(F.count("*").alias("n"))


def fullest(counts: DataFrame) -> tuple[int, int]:
    """Rows of the fullest tile, and of all tiles."""
    row = counts.agg(F.max("n"), F.sum("n")).first()
    return row[0] or 0, row[1] or 0


def slice_count(total: int, hot_rows: int, tasks: int) -> int:
    """Into how many slices rows are cut where a tile is over `hot_rows`."""
    return min(-(-total // hot_rows), max(tasks, -(-total // HOT_TILE_ROWS)))


def _ordered(df: DataFrame, hot_rows: int, largest: int, total: int) -> DataFrame:
    """Rows with their place in line: `_b` numbers slices of (tile, curve key, id) order that one task can sort.

    Where every tile is small enough, a tile is a slice. Otherwise the slices are ranges of about `hot_rows` rows, however
    the rows are spread over tiles and positions, and are written down so that they cannot change later. A slice is a task and a
    file, so there are no more of them than the shuffles have tasks, or than it takes to give each HOT_TILE_ROWS.
    """
    keyed = with_morton(df)
    if largest <= hot_rows:
        return keyed.withColumn("_b", F.lit(0))
    slices = slice_count(total, hot_rows, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranged = keyed.repartitionByRange(slices, *TILE, "morton", "fid")
    return materialise(ranged.withColumn("_b", F.spark_partition_id()))


def _last_before(rows: DataFrame, value: Column, out: str, sliced: bool, keys: list[str]) -> DataFrame:
    """The last non-null `value` among earlier rows of the same `keys`, in (curve key, id) order."""
    before = (Window.unboundedPreceding, -1)
    w = Window.partitionBy(*keys, "_b").orderBy("morton", "fid").rowsBetween(*before)
    rows = rows.withColumn("_v", value)
    own = rows.withColumn(out, F.last("_v", ignorenulls=True).over(w)).drop("_v")
    if not sliced:
        return own
    # What each slice hands to the next: one row per slice and key.
    latest = F.max(F.when(F.col("_v").isNotNull(), F.struct("morton", "fid", "_v"))).alias("_m")
    ends = rows.groupBy(*keys, "_b").agg(latest)
    line = Window.partitionBy(*keys).orderBy("_b").rowsBetween(*before)
    handed = ends.select(*keys, "_b", F.last("_m._v", ignorenulls=True).over(line).alias("_q")).filter(F.col("_q").isNotNull())
    return own.join(handed, [*keys, "_b"], "left").withColumn(out, F.coalesce(out, "_q")).drop("_q")


def _top_per_tile(df: DataFrame, limit: int, hot_rows: int, largest: int) -> DataFrame:
    """Mark rows ranked within `limit` by (gap desc nulls first, fid)."""
    return keep_within(df.withColumn("_w", F.lit(1).cast("long")), limit, hot_rows, largest).drop("_w")


def keep_within(df: DataFrame, budgets: DataFrame | int, hot_rows: int, largest: int) -> DataFrame:
    """Mark as `kept` the rows of each tile, in (gap desc nulls first, fid) order, up to which the sum of `_w` stays within its budget.

    `budgets` is one number, or a table of `budget` by tile; a tile without one keeps all. Where a tile is too large for one task to
    sort, the cut-off is found by adding up: 16 bits of the order key at a time, the weights of a value are summed before the
    shuffle, until the rows that share the cut-off's leading bits are few enough to be put in line. Everything else is kept or
    not by comparing its leading bits; no task ever holds a tile's best.
    """
    order = [F.col("gap").desc_nulls_first(), F.col("fid")]
    line = Window.partitionBy(*TILE).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    fixed = isinstance(budgets, int)
    if largest <= hot_rows:
        allowed = df.withColumn("_need", F.lit(budgets).cast("long")) if fixed else df.join(budgets.withColumnRenamed("budget", "_need"), TILE, "left")
        return allowed.withColumn("kept", F.col("_need").isNull() | (F.sum("_w").over(line) <= F.col("_need"))).drop("_need")
    rows = materialise(df).withColumn("_d", F.concat(_digits(F.coalesce(-F.col("gap"), F.lit(-(2**63)))), _digits(F.col("fid"))))
    totals = rows.groupBy(*TILE).agg(F.sum("_w").alias("_s"), F.count("*").alias("n"))
    needed = totals.withColumn("_need", F.lit(budgets).cast("long")) if fixed else totals.join(budgets.withColumnRenamed("budget", "_need"), TILE)
    cut = needed.filter("_s > _need").select(*TILE, F.array().cast("array<int>").alias("_p"), "_need", "n")
    done, upto_value = None, Window.partitionBy(*TILE).orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    for i in range(DIGITS):
        inside = rows.select(*TILE, "_d", "_w").join(cut.drop("n"), TILE).filter(F.slice("_d", 1, i) == F.col("_p") if i else F.lit(True))
        sums = inside.groupBy(*TILE, "_p", "_need", F.col("_d")[i].alias("_v")).agg(F.sum("_w").alias("_s"), F.count("*").alias("n"))
        # The value at which the budget is passed; what comes before it fits.
        crossed = sums.withColumn("_to", F.sum("_s").over(upto_value)).filter("_to > _need AND _to - _s <= _need")
        found = materialise(crossed.select(*TILE, F.concat("_p", F.array("_v")).alias("_p"), (F.col("_need") - F.col("_to") + F.col("_s")).alias("_need"), "n"))
        small = found if i == DIGITS - 1 else found.filter(F.col("n") <= hot_rows)
        done = small if done is None else done.unionByName(small)
        cut = found.filter(F.col("n") > hot_rows)
        if i == DIGITS - 1 or cut.isEmpty():
            break
    marked = rows.join(done.drop("n"), TILE, "left").withColumn("_lead", F.slice("_d", 1, F.coalesce(F.size("_p"), F.lit(1))))
    clear = marked.filter("_p IS NULL OR _lead <> _p").withColumn("kept", F.col("_p").isNull() | (F.col("_lead") < F.col("_p")))
    close = marked.filter("_lead = _p").withColumn("kept", F.sum("_w").over(line) <= F.col("_need"))
    return clear.unionByName(close).drop("_d", "_p", "_need", "_lead")


# Digits of an order key: two 64-bit numbers, 16 bits each.
DIGITS = 8


def _digits(c: Column) -> Column:
    """A signed 64-bit number as four 16-bit digits in ascending order."""
    unsigned = c.cast("long").bitwiseXOR(F.lit(-(2**63)))
    return F.array(*(F.shiftrightunsigned(unsigned, s).bitwiseAND(F.lit(0xFFFF)).cast("int") for s in (48, 32, 16, 0)))


# --- TIL-9, TIL-10 -----------------------------------------------------------------------------------------------------


def _by_density(df: DataFrame, limit: int, hot_rows: int, budgets: DataFrame | int | None = None) -> tuple[DataFrame, bool]:
    """Tile points with `kept`: the `limit` of each tile that lie farthest behind their predecessor on the curve, and of those as
    many as have room in its budget of bytes (`_size`)."""
    largest, total = fullest(tile_counts(df))
    hot = largest > hot_rows
    rows = _ordered(df, hot_rows, largest, total)
    if largest <= limit and budgets is None:
        return rows.withColumn("kept", F.lit(True)), hot
    gaps = _last_before(rows, F.col("morton"), "_prev", hot, TILE)
    marked = gaps.withColumn("gap", F.col("morton") - F.col("_prev")).drop("_prev").withColumn("kept", F.lit(True))
    if largest > limit:
        marked = _top_per_tile(marked.drop("kept"), limit, hot_rows, largest)
    if budgets is not None:
        # Both cuts run along the same order, so what passes both is what passes the narrower one.
        weighed = marked.withColumnRenamed("kept", "_counted").withColumn("_w", F.col("_size").cast("long"))
        weighed = keep_within(weighed, budgets, hot_rows, largest)
        marked = weighed.withColumn("kept", F.col("kept") & F.col("_counted")).drop("_counted", "_w")
    return marked.drop("gap"), hot


def drop_densest(
    df: DataFrame, limit: int = MAX_TILE_FEATURES, hot_rows: int = HOT_TILE_ROWS, budgets: DataFrame | int | None = None
) -> DataFrame:
    """TIL-9. `fid` must be unique within a tile and not NULL. With `budgets` (bytes, for all tiles or as `budget` by tile) also
    TIL-12: the rows that stay have a `_size` of no more together."""
    marked, _ = _by_density(df, limit, hot_rows, budgets)
    return marked.filter("kept").select(*df.columns)


def coalesce_densest(
    df: DataFrame,
    limit: int = MAX_TILE_FEATURES,
    accumulate: dict[str, str] | None = None,
    hot_rows: int = HOT_TILE_ROWS,
    by: tuple[str, ...] = (),
    budgets: DataFrame | int | None = None,
) -> DataFrame:
    """TIL-10: what TIL-9 drops joins the nearest earlier survivor (of the same `by` columns).

    Output: the survivor's columns, `point_count`, accumulated attributes, and the members' distinct `parts` as one geometry;
    for points that is at most one per grid cell, which bounds the group. Needs `parts`.
    """
    marked, hot = _by_density(df, limit, hot_rows, budgets)
    own = F.when(F.col("kept"), F.col("fid"))
    joined = _last_before(marked, own, "_s", hot, [*TILE, *by]).withColumn("_s", F.coalesce(own, "_s"))
    group = [*TILE, *by, "_s"]
    attrs = accumulate or {}
    rest = [c for c in df.columns if c not in group and c not in attrs and c not in ("px", "py", "parts")]
    # Two steps, both combined before their shuffle: per distinct geometry, then per survivor. A member without an earlier
    # survivor of its kind falls to the lowest of its like.
    lead = F.min_by(F.struct(*rest), F.struct(~F.col("kept"), "morton", "fid")).alias("_row")
    rank = F.min(F.struct((~F.col("kept")).alias("k"), "morton", "fid")).alias("_rank")
    partial = joined.groupBy(*group, "parts").agg(lead, rank, F.count("*").alias("point_count"), *_first_stage(attrs))
    merged = partial.groupBy(*group).agg(
        F.min_by("_row", "_rank").alias("_row"),
        F.sum("point_count").alias("point_count"),
        F.flatten(F.sort_array(F.collect_list("parts"))).alias("parts"),
        *_second_stage(attrs),
    )
    return merged.select(*TILE, *by, "_row.*", "point_count", "parts", *attrs)


def _check(attrs: dict[str, str]) -> None:
    for name, how in attrs.items():
        if how not in ACCUMULATORS:
            raise OptionError(f"accumulation of {name!r} must be one of {', '.join(ACCUMULATORS)}, not {how!r}")


def _first_stage(attrs: dict[str, str]) -> list[Column]:
    """TIL-15, partial results per attribute."""
    _check(attrs)
    out = []
    for name, how in attrs.items():
        c = F.col(f"`{name}`")
        if how in ("sum", "min", "max", "count"):
            out.append(getattr(F, how)(c).alias(f"_a_{name}"))
        elif how == "mean":
            out += [F.sum(c.cast("double")).alias(f"_a_{name}"), F.count(c).alias(f"_n_{name}")]
        else:
            out.append(F.collect_list(c.cast("string")).alias(f"_a_{name}"))
    return out


def _second_stage(attrs: dict[str, str]) -> list[Column]:
    out = []
    for name, how in attrs.items():
        c = F.col(f"`_a_{name}`")
        if how in ("min", "max"):
            out.append(getattr(F, how)(c).alias(name))
        elif how in ("sum", "count"):
            out.append(F.sum(c).alias(name))
        elif how == "mean":
            out.append((F.sum(c) / F.sum(f"`_n_{name}`")).alias(name))
        else:
            out.append(F.array_join(F.sort_array(F.flatten(F.collect_list(c))), ",").alias(name))
    return out


def accumulate_columns(attrs: dict[str, str]) -> list[Column]:
    """TIL-15 in one aggregation. `concat` is the value itself, so it is as long as its group."""
    _check(attrs)
    out = []
    for name, how in attrs.items():
        c = F.col(f"`{name}`")
        if how == "concat":
            out.append(F.array_join(F.sort_array(F.collect_list(c.cast("string"))), ",").alias(name))
        else:
            out.append(getattr(F, how)(c).alias(name))
    return out


# --- TIL-14 ------------------------------------------------------------------------------------------------------------


def cluster_points(
    df: DataFrame,
    distance: int,
    accumulate: dict[str, str] | None = None,
    by: tuple[str, ...] = (),
    extra: tuple[Column, ...] = (),
) -> DataFrame:
    """TIL-14: one point per (zoom, cell of distance/256 tile) at the mean of its members, with `point_count`.

    The mean is exact in integers: offsets inside the cell are summed in two halves, so neither sum can overflow.
    """
    attrs = accumulate or {}
    z = F.col("zoom")
    size = shift_left(F.lit(distance).cast("long"), F.lit(24) - z)

    def cell(w: str) -> Column:
        return F.expr(f"`{w}` div (shiftleft({distance}L, 24 - zoom))")

    cells = df.withColumns({"cell_x": cell("wx"), "cell_y": cell("wy"), "_size": size})
    halves = []
    for axis in "xy":
        off = F.col(f"w{axis}") - F.col(f"cell_{axis}") * F.col("_size")
        halves += [
            F.sum(F.shiftright(off, 16)).alias(f"_h{axis}"),
            F.sum(off.bitwiseAND(F.lit(0xFFFF))).alias(f"_l{axis}"),
        ]
    out = cells.groupBy("zoom", *by, "cell_x", "cell_y").agg(
        *halves,
        F.count("*").alias("point_count"),
        *([F.min("fid").alias("fid")] if "fid" in df.columns else []),
        *accumulate_columns(attrs),
        *extra,
    )

    def mean(axis: str) -> Column:
        h, low = f"_h{axis}", f"_l{axis}"
        inner = f"({h} div point_count) * 65536 + (({h} % point_count) * 65536 + {low}) div point_count"
        return F.expr(f"cell_{axis} * shiftleft({distance}L, 24 - zoom) + {inner}")

    return out.withColumns({"wx": mean("x"), "wy": mean("y")}).drop("_hx", "_lx", "_hy", "_ly")


# --- TIL-11, TIL-12, TIL-13 --------------------------------------------------------------------------------------------


def extend_zooms(points: DataFrame, maxzoom: int, limit: int, buffer: int = 5, ceiling: int = MAX_BUILD_ZOOM, strict: bool = False) -> int:
    """TIL-11 for points (`wx`, `wy`): the first zoom from `maxzoom` on at which no tile is over `limit`, or `ceiling`, where `strict` makes
    a tile that is over even there an error.

    All points are counted once; after that only those in tiles over the limit, whose children alone can be over it.
    """
    left = points.select("wx", "wy").groupBy("wx", "wy").agg(F.count("*").alias("_n"))
    for zoom in range(maxzoom, ceiling + 1):
        if zoom == ceiling and not strict:
            break
        rows = buffered_tiles(left.withColumn("zoom", F.lit(zoom)), buffer)
        over = materialise(rows.groupBy(*TILE).agg(F.sum("_n").alias("n")).filter(F.col("n") > limit).select(*TILE))
        if over.isEmpty():
            return zoom
        left = materialise(rows.join(over, TILE, "left_semi").select("wx", "wy", "_n").distinct())
    if strict:
        raise TooManyFeatures(f"tiles have more than {limit} features even at zoom {ceiling}")
    return max(maxzoom, ceiling)


# What a feature takes in a tile at most, besides its geometry and texts: its own frame (id, type, lengths), a value with its tag numbers
# and its place in the table of values, and the coordinates of a point.
FEATURE_BYTES, VALUE_BYTES, POINT_BYTES = 30, 20, 7
# A coordinate of a line or ring, and the commands of a part.
COORDINATE_BYTES, PART_BYTES = 3, 12


def value_bytes(df: DataFrame) -> Column:
    """TIL-12: the most bytes that a row's id, type and properties (`props`) take when every value has to be listed for it alone."""
    total = F.lit(FEATURE_BYTES).cast("long")
    for f in df.schema["props"].dataType.fields:
        c = F.col(f"props.`{f.name}`")
        if isinstance(f.dataType, T.BinaryType):
            continue
        text = F.octet_length(c) if isinstance(f.dataType, T.StringType) else F.lit(0)
        if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            text = 2 * F.octet_length(F.to_json(c))
        total = total + F.when(c.isNull(), F.lit(0)).otherwise(text + VALUE_BYTES)
    return total


def geometry_bytes(df: DataFrame) -> Column:
    """TIL-12: the most bytes of a row's geometry, from `commands`, `parts` or a single point."""
    size = F.lit(POINT_BYTES)
    if "parts" in df.columns:
        each = F.aggregate("parts", F.lit(0), lambda n, part: n + F.size(part) * COORDINATE_BYTES + PART_BYTES)
        size = F.coalesce(each, size)
    if "commands" in df.columns:
        size = F.coalesce(F.octet_length("commands"), size)
    return size.cast("long")


def tile_caps(df: DataFrame, max_features: int = MAX_TILE_FEATURES) -> DataFrame:
    """TIL-12: tiles over the feature cap."""
    return tile_counts(df).filter(F.col("n") > max_features)


# The coarse tiles the spacing is measured in, and the highest zoom a guess may give.
GUESS_TILE_ZOOM = 4
GUESS_MAX_ZOOM = 14


def guess_maxzoom(points: DataFrame, hot_rows: int = HOT_TILE_ROWS) -> DataFrame:
    """TIL-13: one row, `maxzoom`.

    Only the side of powers of two on which the median spacing lies matters, so the median is found from counts and extremes
    per power of two: exact, and a few dozen rows rather than a sorted column.
    """
    p = assign_tiles(points.withColumn("zoom", F.lit(GUESS_TILE_ZOOM)))
    largest, total = fullest(tile_counts(p))
    rows = _ordered(p.select(*TILE, "fid", "wx", "wy"), hot_rows, largest, total)
    seq = _last_before(rows, F.struct("wx", "wy"), "_prev", largest > hot_rows, TILE)
    spacing = F.greatest(F.abs(F.col("wx") - F.col("_prev.wx")), F.abs(F.col("wy") - F.col("_prev.wy")))
    gaps = seq.filter(F.col("_prev").isNotNull()).select(spacing.alias("s"))
    # bin k holds [2^(k-1), 2^k); bin 0 holds 0
    bins = gaps.withColumn("bin", F.length(F.bin("s")) * (F.col("s") > 0).cast("int"))
    stats = bins.groupBy("bin").agg(F.count("*").alias("n"), F.min("s").alias("lo"), F.max("s").alias("hi"))
    # For each zoom z, T = 2^(20-z) is the first value of bin 21-z; at most 15 x 33 rows here.
    zooms = stats.withColumn("z", F.explode(F.sequence(F.lit(0), F.lit(GUESS_MAX_ZOOM))))
    below = F.col("bin") < F.lit(21) - F.col("z")
    side = zooms.groupBy("z").agg(
        F.sum("n").alias("total"),
        F.sum(F.when(below, F.col("n")).otherwise(0)).alias("under"),
        F.max(F.when(below, F.col("hi"))).alias("hi"),
        F.min(F.when(~below, F.col("lo"))).alias("lo"),
    )
    threshold = F.pow(F.lit(2.0), F.lit(20) - F.col("z"))
    met = (
        F.when(F.col("under") * 2 < F.col("total"), True)
        .when(F.col("under") * 2 > F.col("total"), False)
        .otherwise((F.col("hi") + F.col("lo")) / 2 >= threshold)
    )
    best = side.filter(met).agg(F.min("z").alias("z"))
    return best.select(F.coalesce("z", F.lit(GUESS_MAX_ZOOM)).cast("int").alias("maxzoom"))
