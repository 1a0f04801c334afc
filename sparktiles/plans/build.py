"""TIL-17: from any DataFrame with a geometry to a tile table, a container or GeoJSON."""

from __future__ import annotations

from dataclasses import dataclass, replace
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.mvt import POINT
from ..functions.projection import clamp_y, world_x, world_y, wrap_x
from ..operators import tiling
from ..operators.dealing import by_range, curve_bounds
from ..operators.decode import whole_tiles
from ..operators.encode import PIECE_ROWS, TASK_ROWS, encode_tiles, points_as_parts
from ..operators.features import LONLAT, features, property_fields
from ..operators.geojson import write_geojsonl
from ..operators.shapes import cut_level, tile_shapes, vertices
from ..operators.tables import materialise
from ..operators.tiling import FEATURE_BYTES, TILE
from ..options import MAX_BUILD_ZOOM, MAX_TILE_BYTES, MAX_TILE_FEATURES, Options, derive_layer_name, parse_options
from ..sources.tilesets import container_format, register, write_container, write_tiles

# Tiles named in an error about tiles over a cap, and the most layers a tileset may list in its metadata.
SHOWN_TILES, MAX_LAYERS = 10, 10_000
DEFAULT_DROP_RATE = 2.5
# Estimated bytes, in caps, that a tile is first cut to: packed, most tiles are then over the cap or not far below it.
PACKED = 6
NOTHING = "no features: the input has no row with a geometry to tile"


class TileBuildError(RuntimeError):
    """The tileset cannot be built as asked; nothing has been written."""


@dataclass
class TileBuild:
    """`tiles` come in ranges of the Hilbert curve and in its order. `stretches` are the same, large tiles in several rows, where a build was asked
    for them."""

    tiles: DataFrame
    metadata: dict[str, Any]
    minzoom: int
    maxzoom: int
    stretches: DataFrame | None = None


# --- Steps -------------------------------------------------------------------------------------------------------------


def point_features(feats: DataFrame) -> DataFrame:
    """Longitude/latitude features on the world grid; rows without a finite position have nothing to tile (FEA-5)."""
    located = feats.filter("abs(lon) < double('infinity') AND abs(lat) < double('infinity') AND NOT isnan(lon) AND NOT isnan(lat)")
    placed = {"wx": wrap_x(world_x(F.col("lon"))), "wy": clamp_y(world_y(F.col("lat")))}
    return located.withColumns(placed).drop("lon", "lat")


def representative_points(feats: DataFrame, kind: str) -> DataFrame:
    """One world position per feature (`fid`, `wx`, `wy`), for the questions about spacing and density."""
    if kind == LONLAT:
        return point_features(feats).select(F.col("rid").alias("fid"), "wx", "wy")
    first = vertices(feats, "rid").filter("member = 0 AND part = 0 AND ring = 0 AND pos = 0")
    return first.select(F.col("rid").alias("fid"), wrap_x(F.col("x")).alias("wx"), clamp_y(F.col("y")).alias("wy"))


def _zooms(df: DataFrame, opts: Options, maxzoom: int, fixed: Column | None = None) -> DataFrame:
    if not opts.thinning:
        return tiling.fan_out(df, opts.minzoom, maxzoom, fixed)
    key = F.coalesce("fid", F.xxhash64("props", "wx", "wy").bitwiseAND(F.lit(2**63 - 1)))
    rate = DEFAULT_DROP_RATE if opts.drop_rate is None else opts.drop_rate
    return tiling.thin_fan_out(df, opts.minzoom, maxzoom, rate, opts.base_zoom, key, fixed)


def tiled_points(points: DataFrame, opts: Options, maxzoom: int) -> DataFrame:
    """All Catalyst: zooms, clusters, buffered tiles and grid positions of point features."""
    spread = _zooms(points, opts, maxzoom)
    if opts.cluster_distance is not None:
        spread = clustered(spread, opts)
    tiled = tiling.quantize_points(tiling.buffered_tiles(spread, opts.buffer))
    if opts.coalesce_densest_as_needed:
        return points_as_parts(tiled).drop("px", "py")
    return tiled.withColumn("gtype", F.lit(POINT))


def tiled_shapes(feats: DataFrame, opts: Options, maxzoom: int) -> DataFrame:
    """Shapes cut into tiles by the geometry stage; its single points fanned out like any others, in the same pass."""
    encoded = not opts.coalesce_densest_as_needed  # joined shapes are put together from their parts
    form = "commands" if encoded else "parts"
    cut = tile_shapes(feats, opts.minzoom, maxzoom, opts.buffer, opts.simplification, encoded=encoded)
    if opts.cluster_distance is not None:
        cut = materialise(cut)
        points = cut.filter(F.col("zoom").isNull()).select("layer", "fid", "rid", "props", "wx", "wy")
        shapes = with_point_count(cut.filter(F.col("zoom").isNotNull()), F.lit(1).cast("long"))
        return shapes.unionByName(tiled_points(points, opts, maxzoom), allowMissingColumns=True)
    kept = {f"_{c}": F.col(c) for c in ("zoom", "tile_x", "tile_y", form)}
    own = cut.withColumns(kept).drop("zoom", "tile_x", "tile_y", form)
    spread = _zooms(own, opts, maxzoom, F.col("_zoom"))
    tiled = tiling.quantize_points(tiling.buffered_tiles(spread, opts.buffer, (F.col("_tile_x"), F.col("_tile_y"))))
    if encoded:
        return tiled.withColumn("commands", F.col("_commands")).drop(*kept)
    return tiled.withColumn("parts", F.coalesce("_parts", F.array(F.array("px", "py")))).drop("px", "py", *kept)


def _prop(name: str) -> str:
    return f"_prop_{name}"


def _own_properties(df: DataFrame) -> list[str]:
    return property_fields(df.schema["props"].dataType)


def with_point_count(df: DataFrame, count: Column, replaced: dict[str, Column] | None = None) -> DataFrame:
    """Properties with `point_count` added and accumulated values in place."""
    fields = [(replaced or {}).get(n, F.col(f"props.`{n}`")).alias(n) for n in _own_properties(df) if n != "point_count"]
    return df.withColumn("props", F.struct(*fields, count.alias("point_count")))


def _accumulated(df: DataFrame, opts: Options) -> tuple[DataFrame, dict[str, str], dict[str, Column]]:
    attrs = {n: how for n, how in opts.accumulate.items() if n in _own_properties(df)}
    wide = df.withColumns({_prop(n): F.col(f"props.`{n}`") for n in attrs}) if attrs else df
    return wide, {_prop(n): how for n, how in attrs.items()}, {n: F.col(f"`{_prop(n)}`") for n in attrs}


def clustered(points: DataFrame, opts: Options) -> DataFrame:
    """TIL-14 with TIL-15: other properties are those of the lowest row number."""
    wide, attrs, replaced = _accumulated(points, opts)
    lead = tuple(F.min_by(c, "rid").alias(c) for c in ("props",)) + (F.min("rid").alias("rid"),)
    made = tiling.cluster_points(wide.drop("fid"), opts.cluster_distance, attrs, ("layer",), lead)
    made = with_point_count(made, F.col("point_count"), replaced)
    return made.withColumn("fid", F.lit(None).cast("long")).drop("point_count", "cell_x", "cell_y", "_size", *attrs)


def thinned_by_density(tiled: DataFrame, opts: Options, limit: int, budgets: DataFrame | None = None) -> DataFrame:
    """TIL-9 or TIL-10, within `budgets` of bytes by tile. Ordered by row number, which is unique, where the feature id may not be."""
    keyed = tiled.withColumn("_id", F.col("fid")).withColumn("fid", F.col("rid"))
    if opts.coalesce_densest_as_needed:
        wide, attrs, replaced = _accumulated(keyed, opts)
        joined = tiling.coalesce_densest(wide, limit, attrs, by=("layer", "gtype"), budgets=budgets)
        counted = with_point_count(joined, F.col("point_count"), replaced).drop("point_count", *attrs)
    elif "commands" in tiled.columns:
        counted = tiling.drop_densest(keyed, limit, budgets=budgets)
    else:
        if budgets is None and tiling.fullest(tiling.tile_counts(tiled))[0] <= limit:
            return tiled
        # A point is in a tile once, so that row numbers say which rows stay; properties are not sorted and written with them.
        places = keyed.select(*TILE, "fid", "wx", "wy", *(["_size"] if budgets is not None else []))
        kept = materialise(tiling.drop_densest(places, limit, budgets=budgets).select(*TILE, "fid"))
        counted = keyed.join(kept, [*TILE, "fid"], "left_semi")
    return counted.withColumn("fid", F.col("_id")).drop("_id")


def tiles_within(tiled: DataFrame, opts: Options, limit: int, max_bytes: int) -> DataFrame:
    """TIL-12 with TIL-9 or TIL-10: tiles of no more than `max_bytes`, thinned like any others until they fit.

    What a feature takes is estimated from above, as if it shared no value with another. Only tiles whose estimates are over the cap can
    be too large; they are cut to PACKED times the cap, which bounds what a task has to encode, and those that are still over it
    once more in proportion to what they came to, and at last to what fits for certain.
    """
    rows = tiled.withColumn("_geometry", tiling.geometry_bytes(tiled))
    merging = opts.coalesce_densest_as_needed
    # Joined features keep all positions, so there only ids and properties can be saved.
    rows = materialise(rows.withColumn("_size", tiling.value_bytes(tiled) + (F.lit(0) if merging else F.col("_geometry"))))
    frame = sum(len(n.encode()) + 5 for n in _own_properties(rows)) + 64
    names = F.aggregate(F.collect_set("layer"), F.lit(0), lambda n, name: n + F.octet_length(name) + frame)
    fixed = names + (F.sum("_geometry") if merging else F.lit(0))
    totals = materialise(rows.groupBy(*TILE).agg(fixed.cast("long").alias("_fixed"), F.sum("_size").alias("_all")))
    room = max_bytes - max_bytes // 1000 - 32  # what gzip may add to bytes that do not pack
    budgets = totals.filter(F.col("_all") + F.col("_fixed") > room)
    budgets = budgets.select(*TILE, F.greatest(F.lit(0), F.lit(PACKED * max_bytes) - F.col("_fixed")).alias("budget"))
    made = None
    for attempt in range(3):
        fitting = rows
        if not merging:  # a feature that is over the budget alone would keep all others out
            fitting = rows.join(budgets, TILE, "left").filter("budget IS NULL OR _size <= budget").drop("budget")
        kept = materialise(thinned_by_density(fitting, opts, limit, budgets))
        tiles = materialise(encode_tiles(kept, *tiling.fullest(tiling.tile_counts(kept)), key="rid"))  # dealt out again by the caller
        size = F.octet_length("tile_data")
        good = tiles if attempt == 2 else tiles.filter(size <= max_bytes)
        made = good if made is None else made.unionByName(good)
        over = tiles.filter(size > max_bytes).select(*TILE, size.alias("_made"))
        if attempt == 2 or over.isEmpty():
            break
        over = materialise(over.join(kept.groupBy(*TILE).agg(F.sum("_size").alias("_kept")), TILE).join(totals, TILE))
        share = (F.col("_kept") + F.col("_fixed")) * (0.95 * max_bytes) / F.col("_made") if attempt == 0 else F.lit(room)
        budgets = over.select(*TILE, F.greatest(F.lit(0), F.floor(share) - F.col("_fixed")).alias("budget"))
        rows = materialise(rows.join(budgets.select(*TILE), TILE, "left_semi"))
    return capped(made, max_bytes)


def vector_layers(feats: DataFrame, minzoom: int, maxzoom: int, extra: dict[str, str]) -> list[dict]:
    """SNK-7: per layer the kinds of the properties that have a value anywhere."""
    kinds = {}
    props = feats.schema["props"].dataType
    for f in (props[n] for n in property_fields(props)):
        number = isinstance(f.dataType, T.NumericType)
        kinds[f.name] = "Number" if number else "Boolean" if isinstance(f.dataType, T.BooleanType) else "String"
    counts = feats.groupBy("layer").agg(
        F.count("*").alias("n"), *(F.count(f"props.`{n}`").alias(f"c{i}") for i, n in enumerate(kinds))
    )
    rows = counts.orderBy("layer").limit(MAX_LAYERS + 1).collect()  # one short row per layer
    if len(rows) > MAX_LAYERS:
        raise TileBuildError(f"more than {MAX_LAYERS} layers")
    out = []
    for row in rows:
        used = {n: kind for i, (n, kind) in enumerate(kinds.items()) if row[f"c{i}"]}
        out.append({"id": row["layer"], "minzoom": minzoom, "maxzoom": maxzoom, "fields": {**used, **extra}})
    return out


def extended(feats: DataFrame, kind: str, opts: Options, maxzoom: int) -> int:
    """TIL-11: the first zoom from `maxzoom` on whose tile rows need no thinning; an error when even the last zoom would be thinned.

    Points are counted by their buffered tiles, shapes by the tiles they are cut into. A tile's grown box lies inside its parent's, so
    only what lies in tiles over the limit is looked at again, one zoom on: all rows are tiled once, and then fewer and fewer.
    """
    limit = opts.tile_feature_limit
    if kind == LONLAT:
        return tiling.extend_zooms(point_features(feats).select("rid", "wx", "wy"), maxzoom, limit, opts.buffer, strict=True)
    left, points = feats, None
    for zoom in range(maxzoom, MAX_BUILD_ZOOM + 1):
        cut = materialise(cut_level(left, zoom, opts.buffer))
        if points is None:
            points = cut.filter("zoom IS NULL").select("rid", "wx", "wy")
        dots = tiling.buffered_tiles(points.withColumn("zoom", F.lit(zoom)), opts.buffer)
        pieces = cut.filter("zoom IS NOT NULL").select(*TILE, F.col("pending").isNotNull().cast("int").alias("_raw"))
        # A dot counts as a feature and as a piece. Small shapes may vanish at one zoom and be there at the next: what goes on are pieces.
        both = pieces.select(*TILE, (1 - F.col("_raw")).alias("_seen"), "_raw").unionByName(dots.select(*TILE, F.lit(1).alias("_seen"), F.lit(1).alias("_raw")))
        counts = materialise(both.groupBy(*TILE).agg(F.sum("_seen").alias("_seen"), F.sum("_raw").alias("_raw")))
        if counts.filter(F.col("_seen") > limit).isEmpty():
            return zoom
        over = counts.filter(F.greatest("_seen", "_raw") > limit).select(*TILE)
        left = cut.filter("pending IS NOT NULL").join(over, TILE, "left_semi")
        points = materialise(dots.join(over, TILE, "left_semi").select("rid", "wx", "wy").distinct())
    raise tiling.TooManyFeatures(f"tiles have more than {limit} features even at zoom {MAX_BUILD_ZOOM}")


def numbered_by_content(feats: DataFrame, has_ids: bool) -> DataFrame:
    """`rid` is the feature's id where it has one of its own, else a negative hash of what the row holds, so that ties of thinning
    fall the same way in every layout of the input. Equal rows are told apart by a count; which is which makes no difference.

    The count runs on two levels: rows of one content are numbered within each partition of the written table, behind those of
    the partitions before it, so that even a content that a third of all rows share is not one task's.
    """
    geometry = [c for c in feats.columns if c not in ("layer", "fid", "props")]
    hashed = materialise(feats.withColumns({"_content": F.xxhash64("layer", "fid", F.to_json("props"), *geometry), "_p": F.spark_partition_id()}))
    before = Window.partitionBy("_content").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    each = hashed.groupBy("_content", "_p").agg(F.count("*").alias("_n"))
    offsets = each.select("_content", "_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    nth = F.row_number().over(Window.partitionBy("_content", "_p").orderBy("_p"))
    numbered = hashed.join(offsets, ["_content", "_p"]).withColumn("_nth", F.col("_before") + nth)
    numbered = numbered.withColumn("rid", F.xxhash64("_content", "_nth").bitwiseOR(F.lit(-(2**63))))
    if not has_ids:
        return numbered.select(*feats.columns, "rid")
    shared = hashed.filter(F.col("fid").isNotNull()).groupBy("fid").agg(F.count("*").alias("_shared")).filter("_shared > 1")
    # Rows without an id match nothing; they are given keys of their own, or one task would get them all.
    keyed = numbered.withColumn("_key", F.coalesce("fid", F.col("rid"))).join(shared.withColumnRenamed("fid", "_key"), "_key", "left")
    own = F.when(F.col("fid").isNotNull() & F.col("_shared").isNull(), F.col("fid")).otherwise(F.col("rid"))
    return keyed.withColumn("rid", own).select(*feats.columns, "rid")


def dealt_out(feats: DataFrame) -> DataFrame:
    """Fan-out multiplies the rows, so a table read from fewer files than there are cores is dealt out before it, not after.

    Files are counted, not partitions: asking an adaptive plan for its partitions would run it.
    """
    cores = feats.sparkSession.sparkContext.defaultParallelism
    tasks = max(cores, int(feats.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return feats.repartition(tasks, "rid") if 0 < len(feats.inputFiles()) < cores else feats


# --- The build ---------------------------------------------------------------------------------------------------------


def build(df: DataFrame, layer: str = "features", options: Options | None = None, stretches: bool = False, **given: Any) -> TileBuild:
    """Tile table and metadata of a DataFrame. The table is lazy; zoom guesses, counts and metadata are small jobs run here."""
    opts = options or parse_options(given)
    register(df.sparkSession)
    feats, binding = features(df, opts, opts.layer or layer)
    dense = opts.drop_densest_as_needed or opts.coalesce_densest_as_needed
    if dense:
        feats = materialise(numbered_by_content(feats, opts.id_column is not None))
    else:
        feats = dealt_out(feats.withColumn("rid", F.monotonically_increasing_id()))
    limit = opts.tile_feature_limit
    maxzoom = opts.maxzoom
    if maxzoom is None:
        maxzoom = max(opts.minzoom, tiling.guess_maxzoom(representative_points(feats, binding.kind)).first()[0])
    if dense and opts.extend_zooms_if_still_dropping:
        try:
            maxzoom = extended(feats, binding.kind, opts, maxzoom)
        except tiling.TooManyFeatures as e:
            raise TileBuildError(str(e)) from None

    def tiled(source: DataFrame) -> DataFrame:
        if binding.kind == LONLAT:
            made = tiled_points(point_features(source), opts, maxzoom)
        else:
            made = materialise(tiled_shapes(source, opts, maxzoom))
        return made

    def described(tiles: DataFrame) -> TileBuild:
        counted = opts.cluster_distance is not None or opts.coalesce_densest_as_needed
        extra = {"point_count": "Number"} if counted else {}
        metadata = {
            "name": opts.name or opts.layer or layer,
            "description": opts.description,
            "attribution": opts.attribution,
            "minzoom": opts.minzoom,
            "maxzoom": maxzoom,
            "vector_layers": vector_layers(feats, opts.minzoom, maxzoom, extra),
        }
        return TileBuild(tiles, {k: v for k, v in metadata.items() if v is not None}, opts.minzoom, maxzoom)

    rows = tiled(feats)
    if dense and not opts.no_tile_size_limit:
        tiles = tiles_within(rows, opts, min(limit, MAX_TILE_FEATURES) if not opts.no_feature_limit else limit, MAX_TILE_BYTES)
        if not opts.allow_empty and tiles.isEmpty():
            raise TileBuildError(NOTHING)
        sizes = tiles.select(*TILE, F.octet_length("tile_data").cast("long").alias("n"))
        total = sizes.agg(F.sum("n")).first()[0] or 0
        return described(by_range(tiles, dealt_by_counts(sizes, total // FEATURE_BYTES, maxzoom)))
    if dense:
        rows = thinned_by_density(rows, opts, limit)
    counts = materialise(tiling.tile_counts(rows))
    largest, total = tiling.fullest(counts)
    if largest == 0 and not opts.allow_empty:
        raise TileBuildError(NOTHING)
    if not opts.no_feature_limit and largest > MAX_TILE_FEATURES:
        over = counts.filter(F.col("n") > MAX_TILE_FEATURES).orderBy("zoom", "tile_x", "tile_y").limit(SHOWN_TILES)
        shown = ", ".join(f"{r.zoom}/{r.tile_x}/{r.tile_y} ({r.n} features)" for r in over.collect())
        raise TileBuildError(f"could not make tile {shown}: more than {MAX_TILE_FEATURES} features")
    if largest > PIECE_ROWS and binding.kind == LONLAT and not dense:
        feats = materialise(feats)  # row numbers choose the piece, so they must not change under a retry
        rows = tiled(feats)
    cut = stretches and opts.no_tile_size_limit and largest > PIECE_ROWS
    tiles = encode_tiles(rows, largest, total, key="rid", bounds=dealt_by_counts(counts, total, maxzoom), stretches=cut)
    if not opts.no_tile_size_limit:
        tiles = capped(tiles, MAX_TILE_BYTES)
    return replace(described(whole_tiles(tiles)), stretches=tiles) if cut else described(tiles)


def dealt_by_counts(counts: DataFrame, total: int, maxzoom: int) -> list[int]:
    """Ranges of the curve with about equal rows, as many as the rows ask for."""
    spark = counts.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // TASK_ROWS))
    return curve_bounds(counts, tasks, maxzoom)


def capped(tiles: DataFrame, max_bytes: int) -> DataFrame:
    """TIL-12, bytes: a tile over the cap fails the job that writes it."""
    size = F.octet_length("tile_data")
    address = F.concat_ws("/", "zoom", "tile_x", "tile_y")
    message = F.concat(F.lit("could not make tile "), address, F.lit(f": more than {max_bytes} bytes"))
    checked = F.when(size > max_bytes, F.raise_error(message).cast("binary")).otherwise(F.col("tile_data"))
    return tiles.withColumn("tile_data", checked)


def build_tiles(df: DataFrame, **options: Any) -> DataFrame:
    """The tile table only."""
    return build(df, **options).tiles


def write_tileset(df: DataFrame, path: str, **options: Any) -> TileBuild:
    """Query result to tileset. `x.mbtiles` or `x.pmtiles` is a folder of shards, or one file with `shards=1`; any other path
    becomes a Parquet tile table."""
    opts = parse_options(options)
    try:
        fmt = container_format(path)
    except ValueError:
        fmt = None
    made = build(df, derive_layer_name(path.rstrip("/")), replace(opts), stretches=fmt is not None and opts.shards != 1)
    if opts.keep_geojson:
        write_geojsonl(df, opts.keep_geojson, opts)
    if fmt is None:
        write_tiles(made.tiles, path, made.metadata, opts.force, dealt=True)
        return made
    tiles = made.tiles if made.stretches is None else made.stretches
    write_container(tiles, path, made.metadata, opts.force, single=opts.shards == 1, fmt=fmt, dealt=True)
    return made
