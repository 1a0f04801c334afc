
from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import sparktiles as st  # noqa: E402
from sparktiles.functions.projection import (  # noqa: E402
    flip_rows,
    from_tile_id,
    project_world,
    to_lonlat,
    with_tile_id,
)
from sparktiles.operators import analytics, runs, shapes, tiling  # noqa: E402
from sparktiles.operators.encode import encode_tiles, points_as_parts  # noqa: E402
from sparktiles.operators.features import points_from  # noqa: E402
from sparktiles.operators.tables import shared_folder  # noqa: E402
from sparktiles.options import ACCUMULATORS  # noqa: E402

try:
    import sparktiles.llm.queries as llm
except ModuleNotFoundError as gone:  # the operators for training data are a package that may be absent as a whole
    if not (gone.name or "").startswith("sparktiles.llm") and gone.name != "corpus_pipeline":
        raise
    llm = None

TILE = ["zoom", "tile_x", "tile_y"]

# --- Spark side: point tables ------------------------------------------------------------------------------------------


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _located(df: DataFrame, k1: str, k2: str, *attributes: str) -> DataFrame:
    """The same pseudo-random position formula as `POINTS` below."""
    lon = f"cast((({k1}) * 7919 + ({k2}) * 104729) % 3600000 as double) / 10000 - 180 as lon"
    lat = f"cast((({k1}) * 15485863 + ({k2}) * 32452843) % 1700000 as double) / 10000 - 85 as lat"
    return df.selectExpr(f"{k1} as fid", lon, lat, *attributes)


def _customer(spark: SparkSession, sf: str) -> DataFrame:
    return _located(_table(spark, sf, "customer"), "c_custkey", "c_nationkey", "c_name", "c_acctbal", "c_mktsegment")


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return _located(_table(spark, sf, "events"), "event_id", "user_id", "user_id", "event_type", "value")


def _orders(spark: SparkSession, sf: str) -> DataFrame:
    return _located(
        _table(spark, sf, "orders"), "o_orderkey", "o_custkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"
    )


def _lineitem(spark: SparkSession, sf: str) -> DataFrame:
    return _located(_table(spark, sf, "lineitem"), "l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")


def _at(points: DataFrame, zoom: int) -> DataFrame:
    return project_world(points).withColumn("zoom", F.lit(zoom))


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{uuid.uuid4().hex}/{name}"


# --- Spark side: geometries --------------------------------------------------------------------------------------------


@F.pandas_udf(T.BinaryType())
def _wkb(kind: pd.Series, parts: pd.Series) -> pd.Series:
    """WKB of a fixture: kind 2 line, 3 polygon, 6 multi-polygon of one-ring members; parts are x0,y0,x1,y1,... arrays."""
    import struct

    import numpy as np

    def ring(part) -> bytes:
        xy = np.asarray(part, "<f8")
        return struct.pack("<I", len(xy) // 2) + xy.tobytes()

    def one(k: int, rings) -> bytes:
        if k == 2:
            return struct.pack("<BI", 1, 2) + ring(rings[0])
        if k == 3:
            return struct.pack("<BII", 1, 3, len(rings)) + b"".join(map(ring, rings))
        members = (struct.pack("<BII", 1, 3, 1) + ring(r) for r in rings)
        return struct.pack("<BII", 1, 6, len(rings)) + b"".join(members)

    return pd.Series([one(k, p) for k, p in zip(kind, parts)])


def _square(x: Column, y: Column, half: Column) -> Column:
    corners = ((-1, -1), (1, -1), (1, 1), (-1, 1), (-1, -1))
    return F.array(*(c for i, j in corners for c in (x + half * i, y + half * j)))


def _suppliers(spark: SparkSession, sf: str) -> DataFrame:
    s = _located(_table(spark, sf, "supplier"), "s_suppkey", "s_nationkey")
    return s.withColumn("half", 0.5 + (F.col("fid") % 7) * 0.25)


def _squares(spark: SparkSession, sf: str, holes: bool = False) -> DataFrame:
    s = _suppliers(spark, sf)
    rings = F.array(_square(F.col("lon"), F.col("lat"), F.col("half")))
    if holes:
        inner = F.array(_square(F.col("lon"), F.col("lat"), F.col("half") / 2))
        rings = F.when(F.col("fid") % 3 == 0, F.concat(rings, inner)).otherwise(rings)
    return s.select("fid", _wkb(F.lit(3), rings).alias("geom"))


def _multi(spark: SparkSession, sf: str) -> DataFrame:
    s = _suppliers(spark, sf)
    one = F.array(_square(F.col("lon"), F.col("lat"), F.lit(1.0)))
    two = F.concat(one, F.array(_square(F.col("lon") + 3, F.col("lat"), F.lit(1.0))))
    many = F.col("fid") % 5 == 0
    return s.select("fid", _wkb(F.when(many, 6).otherwise(3), F.when(many, two).otherwise(one)).alias("geom"))


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    """One line per customer with at least two orders, through their positions in date order."""
    o = _orders(spark, sf)
    stops = F.sort_array(F.collect_list(F.struct("o_orderdate", "fid", "lon", "lat")))
    routes = o.groupBy("o_custkey").agg(stops.alias("stops")).filter(F.size("stops") > 1)
    flat = F.flatten(F.transform("stops", lambda s: F.array(s.lon, s.lat)))
    return routes.select(F.col("o_custkey").alias("fid"), _wkb(F.lit(2), F.array(flat)).alias("geom"))


# --- Queries: projection, tiles, thinning ------------------------------------------------------------------------------


def q_points_resolved(spark: SparkSession, sf: str) -> DataFrame:
    c = _customer(spark, sf)
    gappy = c.withColumn("lon", F.when(F.col("fid") % 10 != 0, F.col("lon")))
    placed = points_from(gappy).withColumn("zoom", F.lit(10))
    return tiling.assign_tiles(placed).select("fid", "has_geometry", "tile_x", "tile_y")


def q_project_world(spark: SparkSession, sf: str) -> DataFrame:
    return project_world(_events(spark, sf)).select("fid", "wx", "wy")


def q_project_edges(spark: SparkSession, sf: str) -> DataFrame:
    wide = _events(spark, sf).withColumns({"lon": F.col("lon") * 2.5, "lat": F.col("lat") * 1.25})
    return project_world(wide).select("fid", "wx", "wy")


def q_tile_pyramid(spark: SparkSession, sf: str) -> DataFrame:
    return tiling.tile_pyramid(project_world(_lineitem(spark, sf)).select("wx", "wy"), 0, 8)


def q_tile_assignment(spark: SparkSession, sf: str) -> DataFrame:
    spread = tiling.fan_out(project_world(_customer(spark, sf)), 0, 14)
    return tiling.assign_tiles(spread).select("fid", *TILE)


def q_tile_buffer_dup(spark: SparkSession, sf: str) -> DataFrame:
    spread = tiling.fan_out(project_world(_events(spark, sf)).select("fid", "wx", "wy"), 0, 10)
    tiled = tiling.buffered_tiles(spread, 5)
    return tiled.groupBy(*TILE).agg(F.count("*").alias("n"), F.sum("fid").alias("fids"))


def q_quantize_z14(spark: SparkSession, sf: str) -> DataFrame:
    tiled = tiling.quantize_points(tiling.assign_tiles(_at(_orders(spark, sf), 14)))
    return tiled.select("fid", "tile_x", "tile_y", "px", "py")


def q_drop_rate_thin(spark: SparkSession, sf: str) -> DataFrame:
    thin = tiling.thin_fan_out(_events(spark, sf).select("fid"), 0, 10, 2.5, 8)
    return thin.groupBy("zoom").agg(F.count("*").alias("n"), F.sum("fid").alias("fids"))


def _z2_z6(points: DataFrame) -> DataFrame:
    spread = project_world(points).withColumn("zoom", F.explode(F.array(F.lit(2), F.lit(6))))
    return tiling.assign_tiles(spread)


def q_drop_densest(spark: SparkSession, sf: str) -> DataFrame:
    return tiling.drop_densest(_z2_z6(_customer(spark, sf)), 20).select(*TILE, "fid")


def q_drop_densest_hot(spark: SparkSession, sf: str) -> DataFrame:
    """The form for tiles too large for one task, forced on small ones."""
    return tiling.drop_densest(_z2_z6(_events(spark, sf)), 20, hot_rows=500).select(*TILE, "fid")


def _coalesced(points: DataFrame, hot_rows: int) -> DataFrame:
    tiled = points_as_parts(tiling.quantize_points(_z2_z6(points)))
    made = tiling.coalesce_densest(tiled, 20, {"user_id": "sum"}, hot_rows)
    return made.select(*TILE, "fid", "point_count", "user_id", F.size("parts").alias("positions"))


def q_coalesce_densest(spark: SparkSession, sf: str) -> DataFrame:
    return _coalesced(_events(spark, sf), tiling.HOT_TILE_ROWS)


def q_coalesce_densest_hot(spark: SparkSession, sf: str) -> DataFrame:
    return _coalesced(_events(spark, sf), 500)


def q_cluster_points(spark: SparkSession, sf: str) -> DataFrame:
    spread = tiling.fan_out(project_world(_events(spark, sf)), 0, 6)
    made = tiling.cluster_points(spread, 8, {"user_id": "sum"})
    return made.select("zoom", "cell_x", "cell_y", "wx", "wy", "point_count", "fid", "user_id")


def q_accumulate_attr(spark: SparkSession, sf: str) -> DataFrame:
    e = project_world(_events(spark, sf)).withColumn("zoom", F.lit(2))
    named = e.select("fid", "wx", "wy", "zoom", *(F.col("user_id").alias(f"u_{n}") for n in ACCUMULATORS))
    how = {f"u_{n}": n for n in ACCUMULATORS}
    made = tiling.cluster_points(named, 32, how)
    return made.select("cell_x", "cell_y", "u_sum", "u_min", "u_max", F.round("u_mean", 6).alias("u_mean"), "u_count", "u_concat")


def q_guess_maxzoom(spark: SparkSession, sf: str) -> DataFrame:
    return tiling.guess_maxzoom(project_world(_orders(spark, sf)).select("fid", "wx", "wy"))


def q_guess_maxzoom_hot(spark: SparkSession, sf: str) -> DataFrame:
    return tiling.guess_maxzoom(project_world(_orders(spark, sf)).select("fid", "wx", "wy"), hot_rows=50)


def q_extend_zooms(spark: SparkSession, sf: str) -> DataFrame:
    points = project_world(_events(spark, sf)).select("fid", "wx", "wy")
    zoom = tiling.extend_zooms(points, 4, 20)
    counts = tiling.tile_counts(tiling.buffered_tiles(points.withColumn("zoom", F.lit(zoom)), 5))
    return counts.groupBy("zoom").agg(F.max("n").alias("largest"), F.count("*").alias("tiles"))


def q_tile_caps(spark: SparkSession, sf: str) -> DataFrame:
    spread = tiling.fan_out(project_world(_lineitem(spark, sf)).select("wx", "wy"), 0, 6)
    return tiling.tile_caps(tiling.buffered_tiles(spread, 5), 300)


# --- Queries: addresses ------------------------------------------------------------------------------------------------


def q_tms_flip(spark: SparkSession, sf: str) -> DataFrame:
    tiled = tiling.assign_tiles(tiling.fan_out(project_world(_customer(spark, sf)), 0, 14))
    return flip_rows(tiled, row="tile_y", out="tile_row").select("fid", "zoom", "tile_row")


def q_inverse_project(spark: SparkSession, sf: str) -> DataFrame:
    tiled = tiling.quantize_points(tiling.assign_tiles(_at(_events(spark, sf), 14)))
    back = to_lonlat(tiled.drop("lon", "lat"))
    return back.select("fid", F.round("lon", 5).alias("lon"), F.round("lat", 5).alias("lat"))


def q_hilbert_ids(spark: SparkSession, sf: str) -> DataFrame:
    return with_tile_id(tiling.assign_tiles(_at(_events(spark, sf), 9))).select("fid", "tile_id")


def q_hilbert_inverse(spark: SparkSession, sf: str) -> DataFrame:
    tiled = tiling.assign_tiles(tiling.fan_out(project_world(_customer(spark, sf)), 0, 14))
    return from_tile_id(with_tile_id(tiled).select("fid", "tile_id")).select("fid", *TILE)


def _curve_payloads(spark: SparkSession, sf: str) -> DataFrame:
    """A tile table with few distinct payloads: whether a z9 tile holds more than one row."""
    counts = tiling.tile_counts(tiling.assign_tiles(_at(_lineitem(spark, sf), 9)))
    return with_tile_id(counts.withColumn("tile_data", F.when(F.col("n") > 1, "many").otherwise("one").cast("binary")))


def q_collapse_runs(spark: SparkSession, sf: str) -> DataFrame:
    made = runs.collapse_runs(_curve_payloads(spark, sf))
    return made.select("tile_id", "run_length", F.col("tile_data").cast("string").alias("payload"))


def q_expand_runs(spark: SparkSession, sf: str) -> DataFrame:
    made = runs.expand_runs(runs.collapse_runs(_curve_payloads(spark, sf)))
    return made.select("tile_id", F.col("tile_data").cast("string").alias("payload"))


def q_drop_empty(spark: SparkSession, sf: str) -> DataFrame:
    gaps = _curve_payloads(spark, sf).withColumn("tile_data", F.when(F.col("n") > 1, F.col("tile_data")).otherwise(F.lit(b"")))
    return runs.drop_empty(gaps).select("tile_id", "n")


# --- Queries: GeoJSON --------------------------------------------------------------------------------------------------


def q_geojson_points(spark: SparkSession, sf: str) -> DataFrame:
    return st.geojson_lines(_customer(spark, sf), id_column="fid")


def q_geojson_nulls(spark: SparkSession, sf: str) -> DataFrame:
    c = _customer(spark, sf)
    gappy = c.withColumns(
        {"lat": F.when(F.col("fid") % 7 != 0, F.col("lat")), "c_name": F.when(F.col("fid") % 3 != 0, F.col("c_name"))}
    )
    return st.geojson_lines(gappy, coordinate_precision=2)


def q_geojson_squares(spark: SparkSession, sf: str) -> DataFrame:
    return st.geojson_lines(_squares(spark, sf), geometry_column="geom", coordinate_precision=3)


def q_geojson_text(spark: SparkSession, sf: str) -> DataFrame:
    text = F.format_string('{"type": "Point",\n "coordinates": [%d, %d]}', F.col("fid") % 180, F.col("c_nationkey"))
    c = _table(spark, sf, "customer").withColumnRenamed("c_custkey", "fid")
    return st.geojson_lines(c.select(text.alias("geojson"), "fid", "c_mktsegment"))


# --- Queries: encode, decode, containers -------------------------------------------------------------------------------


def _sized_events(spark: SparkSession, sf: str) -> DataFrame:
    rows = _z2_z6(_events(spark, sf)).withColumn("props", F.struct("user_id", "event_type", "value"))
    return rows.withColumn("_size", tiling.value_bytes(rows) + tiling.geometry_bytes(rows))


def q_tile_caps_bytes(spark: SparkSession, sf: str) -> DataFrame:
    """The features that stay when tiles are thinned to a budget of estimated bytes."""
    return tiling.drop_densest(_sized_events(spark, sf), budgets=20_000).select(*TILE, "fid", F.col("_size").alias("bytes"))


def q_tile_caps_bytes_hot(spark: SparkSession, sf: str) -> DataFrame:
    """The form for tiles too large for one task, and a count limit that cuts deeper in some tiles."""
    made = tiling.drop_densest(_sized_events(spark, sf), 150, hot_rows=300, budgets=20_000)
    return made.select(*TILE, "fid", F.col("_size").alias("bytes"))


def _encodable(points: DataFrame, maxzoom: int, layer: Column, *props: str) -> DataFrame:
    spread = tiling.fan_out(project_world(points), 0, maxzoom)
    tiled = points_as_parts(tiling.quantize_points(tiling.buffered_tiles(spread, 5)))
    return tiled.select(*TILE, layer.alias("layer"), "fid", "gtype", "parts", F.struct(*props).alias("props"))


def _positions(features: DataFrame) -> DataFrame:
    """World integers of decoded points, next to their address."""
    key = features.withColumn("key", F.struct("feature_id", *TILE))
    return shapes.vertices(key, "key").select(
        F.col("key.feature_id").alias("fid"), *(F.col(f"key.{c}").alias(c) for c in TILE), "x", "y"
    )


def q_tile_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    tiles = encode_tiles(_encodable(_orders(spark, sf), 5, F.lit("orders"), "o_orderstatus", "o_totalprice"), stretches=True)
    return _positions(st.decode_tiles(tiles, []))


def q_tile_roundtrip_pieces(spark: SparkSession, sf: str) -> DataFrame:
    """Tiles cut into pieces by several tasks and strung together again; the attributes have to survive that."""
    rows = _encodable(_orders(spark, sf), 3, F.lit("orders"), "o_orderstatus", "o_totalprice", "o_custkey")
    kinds = [("o_orderstatus", "string"), ("o_totalprice", "double"), ("o_custkey", "double")]
    out = st.decode_tiles(encode_tiles(rows, piece_rows=500, stretches=True), kinds)
    return out.select(F.col("feature_id").alias("fid"), *TILE, "o_orderstatus", "o_totalprice", "o_custkey")


def _container(spark: SparkSession, points: DataFrame, fmt: str, **options) -> str:
    path = _scratch(spark, f"points.{fmt}")
    st.write_tileset(points, path, id_column="fid", **options)
    return path


def q_mbtiles_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    out = st.read_mbtiles(spark, _container(spark, _customer(spark, sf), "mbtiles", maxzoom=6))
    return out.select("layer", *TILE, "feature_id", "c_name", "c_acctbal", "c_mktsegment")


def q_pmtiles_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    out = st.read_pmtiles(spark, _container(spark, _events(spark, sf), "pmtiles", maxzoom=6, layer="events"), zoom=4)
    return out.select("layer", *TILE, "feature_id", "user_id", "event_type", "value")


def q_mbtiles_tiles(spark: SparkSession, sf: str) -> DataFrame:
    path = _container(spark, _customer(spark, sf), "mbtiles", maxzoom=7)
    return st.read_mbtiles_tiles(spark, path).filter("zoom >= 3 AND zoom < 6").select(*TILE)


def q_pmtiles_tiles(spark: SparkSession, sf: str) -> DataFrame:
    return st.read_pmtiles_tiles(spark, _container(spark, _customer(spark, sf), "pmtiles", maxzoom=7)).select(*TILE)


def q_container_diff(spark: SparkSession, sf: str) -> DataFrame:
    points = _customer(spark, sf)
    a = st.read_tileset(spark, _container(spark, points, "mbtiles", maxzoom=5))
    b = st.read_tileset(spark, _container(spark, points, "pmtiles", maxzoom=5, shards=1))
    # One side lacks every tenth customer, so the answer is those copies and nothing else.
    fewer = b.filter(F.col("feature_id") % 10 != 0)
    return st.tileset_diff(a, fewer).groupBy("side", "feature_id", *TILE).agg(F.sum("n").alias("n"))


def q_layer_selection(spark: SparkSession, sf: str) -> DataFrame:
    path = _container(spark, _orders(spark, sf), "mbtiles", maxzoom=4, layer_column="o_orderstatus")
    return st.read_mbtiles(spark, path, layer="f").groupBy("layer", *TILE).agg(F.count("*").alias("n"))


def q_tile_table(spark: SparkSession, sf: str) -> DataFrame:
    path = _scratch(spark, "tiles")
    st.write_tileset(_customer(spark, sf), path, id_column="fid", maxzoom=5, drop_rate=2.0)
    return st.decode_tiles(st.read_tiles(spark, path), []).select(*TILE, "feature_id")


def q_build_clustered(spark: SparkSession, sf: str) -> DataFrame:
    made = st.build(_events(spark, sf), maxzoom=4, buffer=0, cluster_distance=16, accumulate={"user_id": "sum"})
    out = st.decode_tiles(made.tiles, [("point_count", "double"), ("user_id", "double")])
    return out.groupBy("zoom").agg(
        F.count("*").alias("n"), F.sum("point_count").alias("points"), F.sum("user_id").alias("user_ids")
    )


def q_build_densest(spark: SparkSession, sf: str) -> DataFrame:
    made = st.build(_events(spark, sf), maxzoom=5, drop_densest_as_needed=True, tile_feature_limit=50, id_column="fid")
    return st.decode_tiles(made.tiles, []).select(*TILE, "feature_id")


# --- Queries: shapes ---------------------------------------------------------------------------------------------------


def q_shape_tiles(spark: SparkSession, sf: str) -> DataFrame:
    cut = shapes.tile_shapes(_squares(spark, sf), 0, 7, buffer=5, simplification=0.0, split_zoom=4)
    flat = F.flatten("parts")
    xs, ys = F.filter(flat, lambda _, i: i % 2 == 0), F.filter(flat, lambda _, i: i % 2 == 1)
    return cut.select(
        "fid",
        *TILE,
        F.array_min(xs).alias("x0"),
        F.array_max(xs).alias("x1"),
        F.array_min(ys).alias("y0"),
        F.array_max(ys).alias("y1"),
    )


def q_vertices(spark: SparkSession, sf: str) -> DataFrame:
    return shapes.vertices(_lines(spark, sf), "fid").select("fid", "pos", "x", "y")


def q_line_tiles(spark: SparkSession, sf: str) -> DataFrame:
    cut = shapes.tile_shapes(_lines(spark, sf), 0, 6, buffer=0, simplification=0.0)
    return cut.groupBy("zoom").agg(F.count_distinct("fid").alias("features"))


def q_hole_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    made = st.build(_squares(spark, sf, holes=True), id_column="fid", maxzoom=0)
    back = st.decode_tiles(made.tiles, []).select("feature_id", "geom")
    rings = shapes.vertices(back, "feature_id").groupBy("feature_id").agg((F.max("ring") + 1).alias("rings"))
    return rings.select(F.col("feature_id").alias("fid"), "rings")


def q_geometry_profile(spark: SparkSession, sf: str) -> DataFrame:
    whole = _multi(spark, sf).unionByName(_lines(spark, sf)).unionByName(_squares(spark, sf))
    broken = whole.withColumn("geom", F.when(F.col("fid") % 11 == 0, F.substring("geom", 1, 20)).otherwise(F.col("geom")))
    profile = shapes.geometry_profile(broken)
    return profile.groupBy("geom_type", "has_z", "is_empty", F.col("error").isNotNull().alias("malformed")).agg(
        F.sum("n").alias("n")
    )


# --- Queries: analytics ------------------------------------------------------------------------------------------------


def _feature_rows(spark: SparkSession, sf: str, minzoom: int, maxzoom: int) -> DataFrame:
    """Feature rows as a tileset read gives them: thinned by zoom, copied by buffers."""
    thin = tiling.thin_fan_out(project_world(_events(spark, sf)), minzoom, maxzoom, 2.0)
    tiled = tiling.buffered_tiles(thin, 5)
    return tiled.select(
        F.col("event_type").alias("layer"), *TILE, F.col("fid").alias("feature_id"), "user_id", "event_type", "value"
    )


def q_dedupe_features(spark: SparkSession, sf: str) -> DataFrame:
    return analytics.dedupe_features(_feature_rows(spark, sf, 8, 8)).select("layer", *TILE, "feature_id", "user_id")


def q_feature_counts(spark: SparkSession, sf: str) -> DataFrame:
    return analytics.feature_counts(_feature_rows(spark, sf, 0, 8))


def q_has_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return analytics.has_duplicates(_feature_rows(spark, sf, 0, 8))


def q_feature_survival(spark: SparkSession, sf: str) -> DataFrame:
    return analytics.feature_survival(_feature_rows(spark, sf, 0, 8))


def q_layer_profile(spark: SparkSession, sf: str) -> DataFrame:
    rows = _feature_rows(spark, sf, 8, 8)
    return analytics.layer_profile(rows, ["user_id", "event_type"], approximate=False)


def q_tile_size_report(spark: SparkSession, sf: str) -> DataFrame:
    tiled = tiling.assign_tiles(tiling.fan_out(project_world(_lineitem(spark, sf)), 0, 7))
    counts = tiling.tile_counts(tiled)
    digits = counts.withColumn("tile_data", F.concat_ws("/", *TILE, "n").cast("binary"))
    return analytics.tile_size_report(digits)


def q_stray_addresses(spark: SparkSession, sf: str) -> DataFrame:
    path = _container(spark, _customer(spark, sf), "pmtiles", maxzoom=6)
    # Without the tiles of the western half, all features there are stray.
    east = st.read_pmtiles_tiles(spark, path).filter("tile_x >= 32")
    return analytics.stray_addresses(st.read_pmtiles(spark, path), east)


def q_tile_nested_props(spark: SparkSession, sf: str) -> DataFrame:
    """Structs with a date, arrays and maps come back as JSON text."""
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("fid") % 9).cast("int"))
    rows = _events(spark, sf).select(
        "fid",
        "lon",
        "lat",
        F.struct(day.alias("day"), F.col("user_id").alias("n")).alias("what"),
        F.array(F.col("fid") % 7, F.lit(None)).alias("list"),
        F.create_map("event_type", F.lit(True)).alias("flags"),
    )
    tiles = st.build(rows, id_column="fid", minzoom=3, maxzoom=3).tiles
    out = st.decode_tiles(tiles, [("what", "string"), ("list", "string"), ("flags", "string")])
    return out.select("feature_id", *TILE, "what", "list", "flags")


def q_tile_underscore_prop(spark: SparkSession, sf: str) -> DataFrame:
    rows = _events(spark, sf).select("fid", "lon", "lat", F.col("event_type").alias("_"), F.concat(F.lit("u"), "user_id").alias("a"))
    tiles = st.build(rows, id_column="fid", minzoom=3, maxzoom=3).tiles
    return st.decode_tiles(tiles, [("_", "string"), ("a", "string")]).select("feature_id", *TILE, "_", "a")


def q_overwrite_forms(spark: SparkSession, sf: str) -> DataFrame:
    """One file, then shards over it, then fewer rows over those."""
    points = _customer(spark, sf).select("fid", "lon", "lat")
    path = _container(spark, points, "mbtiles", maxzoom=4, shards=1)
    st.write_tileset(points, path, id_column="fid", maxzoom=4)
    st.write_tileset(points.filter("fid % 2 = 0"), path, id_column="fid", maxzoom=4)
    return st.read_mbtiles(spark, path).select("feature_id", "tile_x", "tile_y")


def q_extend_zooms_shapes(spark: SparkSession, sf: str) -> DataFrame:
    """Squares of a few degrees: the first zoom at which no tile holds pieces of more than the limit."""
    made = st.build(
        _squares(spark, sf), id_column="fid", simplification=0.0, maxzoom=1, drop_densest_as_needed=True,
        extend_zooms_if_still_dropping=True, tile_feature_limit=_square_limit(spark, sf),
    )
    return spark.range(1).select(F.lit(made.maxzoom).alias("maxzoom"))


def _square_limit(spark: SparkSession, sf: str) -> int:
    return max(2, _table(spark, sf, "supplier").count() // 10)


def q_closed_rings(spark: SparkSession, sf: str) -> DataFrame:
    made = st.build(_squares(spark, sf, holes=True), id_column="fid", minzoom=3, maxzoom=5)
    return analytics.closed_rings(st.decode_tiles(made.tiles, []))


def q_closed_rings_open(spark: SparkSession, sf: str) -> DataFrame:
    """Rings of which every fifth lacks its last vertex, in layers with and without such a one; lines do not count."""
    s = _suppliers(spark, sf)
    ring = _square(F.col("lon"), F.col("lat"), F.col("half"))
    drawn = F.when(F.col("fid") % 5 == 0, F.slice(ring, 1, 8)).otherwise(ring)
    layer = F.when(F.col("fid") % 5 == 0, "open").when(F.col("fid") % 5 < 3, "closed").otherwise("lines")
    kind = F.when(F.col("fid") % 5 < 3, 3).otherwise(2)
    return analytics.closed_rings(s.select(layer.alias("layer"), _wkb(kind, F.array(drawn)).alias("geom")))


# --- Queries: rules and edges ------------------------------------------------------------------------------------------


def _zigzags(spark: SparkSession, sf: str) -> DataFrame:
    """A line per customer with a vertex per order, up and down by far more or far less than the tolerance."""
    orders = _table(spark, sf, "orders").groupBy("o_custkey").agg(F.count("*").cast("int").alias("n")).filter("n > 1")
    high = F.when(F.col("o_custkey") % 2 == 0, 0.2).otherwise(0.01)
    steps = F.sequence(F.lit(0), F.col("n") - 1)
    flat = F.flatten(F.transform(steps, lambda k: F.array(F.lit(1.0) + k * 0.1, F.lit(3.0) + (k % 2) * high)))
    return orders.select(F.col("o_custkey").alias("fid"), _wkb(F.lit(2), F.array(flat)).alias("geom"))


def q_simplify_zigzags(spark: SparkSession, sf: str) -> DataFrame:
    """TIL-6: the places of the vertices that stay, with a tolerance of four grid steps below the highest zoom."""
    cut = shapes.tile_shapes(_zigzags(spark, sf), 4, 5, buffer=0, simplification=4.0)
    xs = F.filter(F.col("parts")[0], lambda _, i: i % 2 == 0)
    return cut.select("fid", "zoom", F.size(xs).alias("vertices"), F.array_min(xs).alias("first"), F.array_max(xs).alias("last"))


def _level_lines(spark: SparkSession, sf: str) -> DataFrame:
    """A line along a parallel for every customer, some degrees long."""
    c = _customer(spark, sf)
    west = F.col("lon") * 0.9
    flat = F.array(west, F.col("lat"), west + 0.5 + F.col("fid") % 7, F.col("lat"))
    return c.select("fid", _wkb(F.lit(2), F.array(flat)).alias("geom"))


def q_line_tiles_by_address(spark: SparkSession, sf: str) -> DataFrame:
    cut = shapes.tile_shapes(_level_lines(spark, sf), 0, 8, buffer=0, simplification=0.0)
    return cut.select("fid", *TILE, F.array_min(F.col("parts")[0]).alias("least"), F.size(F.col("parts")[0]).alias("numbers"))


def q_tile_size_report_tiles(spark: SparkSession, sf: str) -> DataFrame:
    """Sizes of real tiles as a container gives them back: unpacked, with nothing but ids and positions."""
    path = _container(spark, _customer(spark, sf).select("fid", "lon", "lat"), "pmtiles", maxzoom=5)
    return analytics.tile_size_report(st.read_pmtiles_tiles(spark, path))


def q_project_edge_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Positions at and beyond the clamps, not finite ones and missing ones."""
    kind = F.col("fid") % 9
    c = _customer(spark, sf)
    lon, lat = F.col("lon"), F.col("lat")
    nan, inf = F.lit(float("nan")), F.lit(float("inf"))
    x = F.when(kind == 0, 180.0).when(kind == 1, -180.0).when(kind == 2, lon + 200).when(kind == 3, nan).when(kind == 4, -inf).when(kind == 5, F.lit(None)).otherwise(lon)
    y = F.when(kind == 0, 85.0).when(kind == 1, -85.0).when(kind == 6, 89.95).when(kind == 7, nan).when(kind == 8, -inf).otherwise(lat)
    return project_world(c.withColumns({"lon": x, "lat": y})).select("fid", "wx", "wy")


def q_geojson_tiles(spark: SparkSession, sf: str) -> DataFrame:
    """FEA-4: tiles from GeoJSON text that runs over several lines."""
    c = _table(spark, sf, "customer")
    text = F.format_string('{"type":\n"Point","coordinates":\r\n[%d, %d]}', F.col("c_custkey") % 180, F.col("c_nationkey"))
    tiles = st.build(c.select(F.col("c_custkey").alias("fid"), text.alias("geometry")), id_column="fid", minzoom=4, maxzoom=4).tiles
    return _positions(st.decode_tiles(tiles, []))


def q_explicit_pair_tiles(spark: SparkSession, sf: str) -> DataFrame:
    """FEA-1, FEA-3: a stated pair of whole-number columns goes before a column that is named like a geometry."""
    c = _table(spark, sf, "customer")
    rows = c.select(F.col("c_custkey").alias("fid"), (F.col("c_custkey") % 170).alias("a"), F.col("c_nationkey").alias("b"), F.col("c_name").alias("lon"))
    tiles = st.build(rows, id_column="fid", longitude="a", latitude="b", minzoom=4, maxzoom=4).tiles
    return st.decode_tiles(tiles, [("lon", "string")]).select(F.col("feature_id").alias("fid"), *TILE, "lon")


def q_failed_overwrite(spark: SparkSession, sf: str) -> DataFrame:
    """SNK-8: an overwrite of which a task fails, after which the old set is read."""
    points = _customer(spark, sf).select("fid", "lon", "lat")
    path = _container(spark, points, "mbtiles", maxzoom=4)
    tiles = st.read_mbtiles_tiles(spark, path)
    broken = tiles.withColumn("tile_data", F.when(F.col("tile_x") == 15, F.raise_error("no such tile").cast("binary")).otherwise(F.lit(b"x")))
    try:
        st.write_container(broken, path)
    except Exception as e:  # noqa: BLE001
        if "no such tile" not in str(e):
            raise
    return st.read_mbtiles(spark, path).select("feature_id", "tile_x", "tile_y")


def q_write_errors(spark: SparkSession, sf: str) -> DataFrame:
    """SNK-9 and TIL-18: what is said to an empty input and to bad options, with the rows that were looked at."""
    points = _customer(spark, sf)
    cases = {
        "empty": (points.filter("fid < 0"), {}),
        "unknown": (points, {"nope": 1}),
        "lon without lat": (points, {"lon": "lon"}),
        "no such column": (points, {"id_column": "nothing"}),
        "two values": (points, {"name": ["a", "b"]}),
        "zooms": (points, {"minzoom": 5, "maxzoom": 3}),
        "number": (points, {"maxzoom": "deep"}),
    }
    said = []
    for case, (rows, options) in cases.items():
        try:
            st.build(rows, **options)
            said.append((case, "none"))
        except (st.OptionError, st.TileBuildError) as e:
            said.append((case, type(e).__name__))
    rows = points.agg(F.count("*").alias("rows"))
    return spark.createDataFrame(said, "case string, error string").crossJoin(F.broadcast(rows))


def q_geojson_ordered(spark: SparkSession, sf: str) -> DataFrame:
    """SNK-10: lines in the order of a column, by part file and place in it."""
    path = _scratch(spark, "ordered.geojsonl")
    st.write_geojsonl(_customer(spark, sf).select("fid", "lon", "lat"), path, order_by="fid")
    lines = spark.read.text(path).select("value", F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("at"))
    number = F.regexp_extract("value", r'"fid":(\d+)', 1).cast("long")
    # In an ordered export every line of a file is above the one before it, and files do not overlap.
    w = Window.partitionBy("file").orderBy("at")
    risen = lines.select("file", number.alias("fid"), (number > F.lag(number).over(w)).alias("up"))
    files = risen.groupBy("file").agg(F.min("fid").alias("low"), F.max("fid").alias("high"), F.count("*").alias("n"), F.coalesce(F.bool_and("up"), F.lit(True)).alias("up"))
    overlap = files.alias("a").join(files.alias("b"), F.expr("a.file < b.file AND a.low <= b.high AND b.low <= a.high")).agg(F.count("*").alias("overlaps"))
    return files.agg(F.sum("n").alias("lines"), F.bool_and("up").alias("ascending")).crossJoin(overlap)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def shipped(run: Callable) -> Callable:
        def wrapped(spark: SparkSession, sf: str) -> DataFrame:
            return run(st.register(spark), sf)

        return wrapped

    return {name[2:]: shipped(run) for name, run in globals().items() if name.startswith("q_")} | (llm.queries() if llm else {})


def entry(spark: SparkSession) -> DataFrame:
    return q_tile_pyramid(st.register(spark), "/root/testdata/sf0.001")


# --- Oracle SQL --------------------------------------------------------------------------------------------------------


def _points(table: str, k1: str, k2: str, columns: str = "", scale: tuple[float, float] = (1, 1)) -> str:
    extra = f", {columns}" if columns else ""
    return f"""
    located AS (
      SELECT {k1} AS fid,
        (CAST((({k1}) * 7919 + ({k2}) * 104729) % 3600000 AS DOUBLE) / 10000 - 180) * {scale[0]} AS lon,
        (CAST((({k1}) * 15485863 + ({k2}) * 32452843) % 1700000 AS DOUBLE) / 10000 - 85) * {scale[1]} AS lat{extra}
      FROM {table})"""


def _grid(source: str, name: str, lon: str = "lon", lat: str = "lat") -> str:
    """World coordinates: unwrapped `ux`, `uy`, and `wx`, `wy` inside the world."""
    return f"""
    {name}_raw AS (
      SELECT *, CAST(4294967296 AS DOUBLE) * ((greatest(-360, least(360, {lon})) + 180) / 360) AS vx,
        CAST(4294967296 AS DOUBLE) * (1 - ln(tan(greatest(-89.9, least(89.9, {lat})) * pi() / 180)
          + 1 / cos(greatest(-89.9, least(89.9, {lat})) * pi() / 180)) / pi()) / 2 AS vy
      FROM {source}),
    {name}_round AS (
      SELECT * EXCLUDE (vx, vy),
        CAST(CASE WHEN vx >= 0 THEN floor(vx + 0.5) ELSE -floor(0.5 - vx) END AS BIGINT) AS ux,
        CAST(CASE WHEN vy >= 0 THEN floor(vy + 0.5) ELSE -floor(0.5 - vy) END AS BIGINT) AS uy
      FROM {name}_raw),
    {name} AS (
      SELECT *, ux & 4294967295 AS wx, greatest(0, least(4294967295, uy)) AS wy FROM {name}_round)"""


_CUSTOMER = _points("customer", "c_custkey", "c_nationkey", "c_name, c_acctbal, c_mktsegment")
_EVENTS = _points("events", "event_id", "user_id", "user_id, event_type, value")
_ORDERS = _points("orders", "o_orderkey", "o_custkey", "o_custkey, o_orderstatus, o_totalprice, o_orderdate")
_LINEITEM = _points("lineitem", "l_orderkey", "l_linenumber", "l_quantity, l_returnflag")
_WORLD = _grid("located", "world")


def _spread(low: int, high: int) -> str:
    return f"""
    spread AS (SELECT *, CAST(z AS INTEGER) AS zoom FROM world, (SELECT unnest(range({low}, {high + 1})) AS z))"""


_ASSIGNED = """
    tiled AS (
      SELECT *, CAST(wx >> (32 - zoom) AS INTEGER) AS tile_x, CAST(wy >> (32 - zoom) AS INTEGER) AS tile_y FROM spread)"""
_BUFFERED = """
    wide AS (
      SELECT *, unnest(range(greatest(0, (wx - (5 << (24 - zoom))) >> (32 - zoom)),
        1 + least((1 << zoom) - 1, (wx + (5 << (24 - zoom))) >> (32 - zoom)))) AS tx FROM spread),
    tiled AS (
      SELECT * EXCLUDE (tx), CAST(tx AS INTEGER) AS tile_x, CAST(unnest(range(
        greatest(0, (wy - (5 << (24 - zoom))) >> (32 - zoom)),
        1 + least((1 << zoom) - 1, (wy + (5 << (24 - zoom))) >> (32 - zoom)))) AS INTEGER) AS tile_y FROM wide)"""


def _side(zoom: str = "zoom") -> str:
    return f"(CAST(1 AS BIGINT) << (32 - {zoom}))"


_BUFFERED = _BUFFERED.replace("(5 << (24 - zoom))", "(CAST(5 AS BIGINT) << (24 - zoom))").replace(
    "(1 << zoom)", "(CAST(1 AS BIGINT) << zoom)"
)
_QUANTIZED = f"""
    grid AS (
      SELECT *, CAST((wx - CAST(tile_x AS BIGINT) * {_side()}) >> (20 - zoom) AS INTEGER) AS px,
        CAST((wy - CAST(tile_y AS BIGINT) * {_side()}) >> (20 - zoom) AS INTEGER) AS py FROM tiled)"""


def _morton(source: str, name: str) -> str:
    """Bit interleave in five steps, one nested select each, so that the text stays short."""
    steps = ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555))
    text = f"SELECT *, wx >> 2 AS ma, wy >> 2 AS mb FROM {source}"
    for shift, mask in steps:
        text = (
            f"SELECT * EXCLUDE (ma, mb), (ma | (ma << {shift})) & {mask} AS ma, (mb | (mb << {shift})) & {mask} AS mb "
            f"FROM ({text})"
        )
    return f"\n    {name} AS (SELECT * EXCLUDE (ma, mb), ma | (mb << 1) AS morton FROM ({text}))"


def _ranked(limit: int) -> str:
    return f"""
    gaps AS (
      SELECT *, morton - lag(morton) OVER (PARTITION BY zoom, tile_x, tile_y ORDER BY morton, fid) AS gap,
        count(*) OVER (PARTITION BY zoom, tile_x, tile_y) AS tile_n FROM keyed),
    marked AS (
      SELECT *, tile_n <= {limit} OR row_number() OVER (PARTITION BY zoom, tile_x, tile_y
        ORDER BY gap DESC NULLS FIRST, fid) <= {limit} AS kept FROM gaps)"""


def _within(budget: int, limit: int) -> str:
    return f"""
    gaps AS (
      SELECT *, morton - lag(morton) OVER (PARTITION BY zoom, tile_x, tile_y ORDER BY morton, fid) AS gap,
        CAST(37 + CASE WHEN user_id IS NULL THEN 0 ELSE 20 END + CASE WHEN value IS NULL THEN 0 ELSE 20 END
          + CASE WHEN event_type IS NULL THEN 0 ELSE 20 + strlen(event_type) END AS BIGINT) AS bytes FROM keyed),
    placed AS (
      SELECT *, sum(bytes) OVER line AS upto, row_number() OVER line AS place FROM gaps
      WINDOW line AS (PARTITION BY zoom, tile_x, tile_y ORDER BY gap DESC NULLS FIRST, fid ROWS UNBOUNDED PRECEDING))
    SELECT zoom, tile_x, tile_y, fid, bytes FROM placed WHERE upto <= {budget} AND place <= {limit}"""


_TWO_ZOOMS = """
    spread AS (SELECT *, CAST(z AS INTEGER) AS zoom FROM world, (SELECT unnest([2, 6]) AS z))"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


def _thin(low: int, high: int, rate: float, base: int) -> str:
    return f"""
    hashed AS (SELECT *, CAST((CAST(fid AS HUGEINT) * 2654435761) % 4294967296 AS BIGINT) AS h FROM world),
    spread AS (
      SELECT *, CAST(z AS INTEGER) AS zoom FROM hashed, (SELECT unnest(range({low}, {high + 1})) AS z)
      WHERE z >= {base} OR h < CAST(4294967296 AS DOUBLE) / pow(CAST({rate} AS DOUBLE), {base} - z))"""


def _hilbert(source: str, name: str, zoom: int) -> str:
    text = f"SELECT *, CAST(tile_x AS BIGINT) AS hx, CAST(tile_y AS BIGINT) AS hy, CAST(0 AS BIGINT) AS hd FROM {source}"
    for level in range(zoom - 1, -1, -1):
        s = 1 << level
        text = (
            f"SELECT *, (hx >> {level}) & 1 AS rx, (hy >> {level}) & 1 AS ry FROM ({text})"
        )
        text = (
            f"SELECT * EXCLUDE (hx, hy, hd, rx, ry), hd + {s * s} * xor(3 * rx, ry) AS hd, "
            f"CASE WHEN ry = 1 THEN hx & {s - 1} WHEN rx = 1 THEN {s - 1} - (hy & {s - 1}) ELSE hy & {s - 1} END AS hx, "
            f"CASE WHEN ry = 1 THEN hy & {s - 1} WHEN rx = 1 THEN {s - 1} - (hx & {s - 1}) ELSE hx & {s - 1} END AS hy "
            f"FROM ({text})"
        )
    start = ((1 << (2 * zoom)) - 1) // 3
    return f"\n    {name} AS (SELECT * EXCLUDE (hx, hy, hd), {start} + hd AS tile_id FROM ({text}))"


def _payload_sql() -> str:
    counted = """
    counted AS (
      SELECT zoom, tile_x, tile_y, count(*) AS n, CASE WHEN count(*) > 1 THEN 'many' ELSE 'one' END AS payload
      FROM tiled GROUP BY zoom, tile_x, tile_y)"""
    return _with(_LINEITEM, _WORLD, _spread(9, 9), _ASSIGNED, counted, _hilbert("counted", "curve", 9))


def _number(c: str, places: int) -> str:
    """Fixed decimals, without trailing zeros and without a negative zero."""
    text = f"regexp_replace(printf('%.{places}f', {c}), '\\.?0+$', '')"
    return f"CASE WHEN {text} = '-0' THEN '0' ELSE {text} END"


def _pair(x: str, y: str, places: int = 7) -> str:
    return f"'[' || {_number(x, places)} || ',' || {_number(y, places)} || ']'"


def _geojson_points() -> str:
    point = f"""'{{"type":"Point","coordinates":' || {_pair("lon", "lat")} || '}}'"""
    return f"""{_with(_CUSTOMER)}
    SELECT '{{"type":"Feature","id":' || fid || ',"geometry":' || {point} || ',"properties":{{"c_name":"' || c_name
      || '","c_acctbal":' || printf('%.15g', c_acctbal) || ',"c_mktsegment":"' || c_mktsegment || '"}}}}' AS line FROM located"""


def _geojson_nulls() -> str:
    point = f"""'{{"type":"Point","coordinates":' || {_pair("lon", "lat", 2)} || '}}'"""
    return f"""{_with(_CUSTOMER)}
    SELECT '{{"type":"Feature","geometry":' || CASE WHEN fid % 7 <> 0 THEN {point} ELSE 'null' END
      || ',"properties":{{"fid":' || fid || CASE WHEN fid % 3 <> 0 THEN ',"c_name":"' || c_name || '"' ELSE '' END
      || ',"c_acctbal":' || printf('%.15g', c_acctbal) || ',"c_mktsegment":"' || c_mktsegment || '"}}}}' AS line FROM located"""


_SUPPLIERS = _points("supplier", "s_suppkey", "s_nationkey")


def _level_lines_sql() -> str:
    """Pieces of lines along a parallel: one in every tile they cross, unless it is a single step of the grid."""
    ends = """
    ends AS (SELECT fid, lon * 0.9 AS lon, lat, lon * 0.9 + 0.5 + fid % 7 AS lon2, lat AS lat2 FROM located)"""
    low = _grid("ends", "low")
    high = _grid("low", "high", "lon2", "lat2").replace("SELECT *, CAST(4294967296", "SELECT * EXCLUDE (ux, uy, wx, wy), ux AS x0, uy AS y0, CAST(4294967296", 1)
    return f"""{_with(_CUSTOMER, ends, low, high)},
    spread AS (SELECT fid, x0, ux AS x1, uy AS y, CAST(z AS INTEGER) AS zoom FROM high, (SELECT unnest(range(0, 9)) AS z)),
    tiled AS (SELECT *, unnest(range(x0 >> (32 - zoom), 1 + (x1 >> (32 - zoom)))) AS tx FROM spread),
    cut AS (
      SELECT fid, zoom, tx, y >> (32 - zoom) AS ty, (y >> (20 - zoom)) & 4095 AS py,
        (greatest(x0, tx << (32 - zoom)) - (tx << (32 - zoom))) >> (20 - zoom) AS px,
        (least(x1, (tx + 1) << (32 - zoom)) - (tx << (32 - zoom))) >> (20 - zoom) AS px2 FROM tiled)
    SELECT fid, zoom, CAST(tx AS INTEGER) AS tile_x, CAST(ty AS INTEGER) AS tile_y, CAST(least(px, py) AS INTEGER) AS least,
      CAST(4 AS INTEGER) AS numbers FROM cut WHERE px < px2"""


def _varint(v: str) -> str:
    return f"(CASE WHEN {v} < 128 THEN 1 WHEN {v} < 16384 THEN 2 WHEN {v} < 2097152 THEN 3 WHEN {v} < 268435456 THEN 4 ELSE 5 END)"


def _real_sizes_sql() -> str:
    """Bytes of a tile by the format: features of id, type and one point, in a layer of their name without keys."""
    zigzag = "(CASE WHEN {0} >= 0 THEN 2 * {0} ELSE -2 * {0} - 1 END)"
    x, y = _varint(zigzag.format("px")), _varint(zigzag.format("py"))
    return f"""{_with(_CUSTOMER, _WORLD, _spread(0, 5), _BUFFERED, _QUANTIZED)},
    bodies AS (SELECT zoom, tile_x, tile_y, (1 + {_varint("fid")}) + 2 + (2 + 1 + {x} + {y}) AS body FROM grid),
    layers AS (SELECT zoom, sum(1 + {_varint("body")} + body) + 2 + length('points') + 5 AS layer FROM bodies GROUP BY zoom, tile_x, tile_y),
    sized AS (SELECT zoom, CAST(1 + {_varint("layer")} + layer AS INTEGER) AS size FROM layers)
    SELECT zoom, count(*) AS tiles, CAST(sum(size) AS BIGINT) AS bytes, max(size) AS largest, quantile_cont(size, 0.5) AS median FROM sized GROUP BY zoom"""


def _geojson_squares() -> str:
    corners = ((-1, -1), (1, -1), (1, 1), (-1, 1), (-1, -1))
    ring = " || ',' || ".join(_pair(f"(lon + half * {i})", f"(lat + half * {j})", 3) for i, j in corners)
    return f"""{_with(_SUPPLIERS)}
    SELECT '{{"type":"Feature","geometry":{{"type":"Polygon","coordinates":[[' || {ring} || ']]}},"properties":{{"fid":' || fid
      || '}}}}' AS line FROM (SELECT *, 0.5 + CAST(fid % 7 AS DOUBLE) * 0.25 AS half FROM located)"""


def _shape_tiles() -> str:
    """Axis-parallel squares: the clipped piece of a tile is the overlap of two boxes."""
    corner = """
    boxes AS (SELECT fid, lon - half AS lon, lat + half AS lat, lon + half AS lon2, lat - half AS lat2
      FROM (SELECT *, 0.5 + CAST(fid % 7 AS DOUBLE) * 0.25 AS half FROM located))"""
    low, high = _grid("boxes", "low"), _grid("low", "high", "lon2", "lat2").replace("SELECT *, CAST(4294967296", "SELECT * EXCLUDE (ux, uy, wx, wy), ux AS x0, uy AS y0, CAST(4294967296", 1)
    return f"""{_with(_SUPPLIERS, corner, low, high)},
    shifted AS (
      SELECT fid, x0 + k * 4294967296 AS x0, ux + k * 4294967296 AS x1, y0, uy AS y1
      FROM high, (SELECT unnest([-1, 0, 1]) AS k)),
    spread AS (
      SELECT *, CAST(z AS INTEGER) AS zoom, CAST(1 AS BIGINT) << (32 - z) AS s, CAST(5 AS BIGINT) << (24 - z) AS b
      FROM shifted, (SELECT unnest(range(0, 8)) AS z) WHERE x1 >= 0 AND x0 < 4294967296),
    wide AS (
      SELECT *, unnest(range(greatest(0, (x0 - b) // s - 1), 1 + least((1 << zoom) - 1, (x1 + b) // s))) AS tx FROM spread),
    tiled AS (
      SELECT *, unnest(range(greatest(0, (y0 - b) // s - 1), 1 + least((1 << zoom) - 1, (y1 + b) // s))) AS ty FROM wide),
    cut AS (
      SELECT fid, zoom, tx, ty, (greatest(x0, tx * s - b) - tx * s) >> (20 - zoom) AS x0,
        (least(x1, (tx + 1) * s + b) - tx * s) >> (20 - zoom) AS x1,
        (greatest(y0, ty * s - b) - ty * s) >> (20 - zoom) AS y0, (least(y1, (ty + 1) * s + b) - ty * s) >> (20 - zoom) AS y1
      FROM tiled WHERE greatest(x0, tx * s - b) < least(x1, (tx + 1) * s + b)
        AND greatest(y0, ty * s - b) < least(y1, (ty + 1) * s + b))
    SELECT fid, zoom, CAST(tx AS INTEGER) AS tile_x, CAST(ty AS INTEGER) AS tile_y, CAST(x0 AS INTEGER) AS x0,
      CAST(x1 AS INTEGER) AS x1, CAST(y0 AS INTEGER) AS y0, CAST(y1 AS INTEGER) AS y1
    FROM cut WHERE x0 < x1 AND y0 < y1"""


def _profile_sql() -> str:
    return """
    WITH lines AS (
      SELECT o_custkey AS fid FROM orders GROUP BY o_custkey HAVING count(*) > 1),
    shapes AS (
      SELECT s_suppkey AS fid, CASE WHEN s_suppkey % 5 = 0 THEN 'MultiPolygon' ELSE 'Polygon' END AS kind FROM supplier
      UNION ALL SELECT fid, 'LineString' FROM lines
      UNION ALL SELECT s_suppkey, 'Polygon' FROM supplier)
    SELECT CASE WHEN fid % 11 <> 0 THEN kind END AS geom_type, CASE WHEN fid % 11 <> 0 THEN false END AS has_z,
      CASE WHEN fid % 11 <> 0 THEN false END AS is_empty, fid % 11 = 0 AS malformed, count(*) AS n
    FROM shapes GROUP BY ALL"""


def _rows_sql(low: int, high: int) -> str:
    return _with(_EVENTS, _WORLD, _thin(low, high, 2.0, high), _BUFFERED) + """,
    rows AS (SELECT event_type AS layer, zoom, tile_x, tile_y, fid AS feature_id, user_id, event_type FROM tiled)"""


def _extend_sql() -> str:
    return f"""{_with(_EVENTS, _WORLD, _spread(4, 16), _BUFFERED)},
    counts AS (SELECT zoom, tile_x, tile_y, count(*) AS n FROM tiled GROUP BY ALL),
    zooms AS (SELECT zoom, max(n) AS largest, count(*) AS tiles FROM counts GROUP BY zoom)
    SELECT zoom, largest, tiles FROM zooms WHERE largest <= 20 ORDER BY zoom LIMIT 1"""


def _extend_shapes_sql() -> str:
    return f"""
    WITH counts AS (SELECT zoom, tile_x, tile_y, count(*) AS n FROM ({_shape_tiles()}) WHERE zoom >= 1 GROUP BY ALL),
    zooms AS (SELECT zoom, max(n) AS largest FROM counts GROUP BY zoom)
    SELECT min(zoom) AS maxzoom FROM zooms WHERE largest <= (SELECT greatest(2, count(*) // 10) FROM supplier)"""


def _guess_sql() -> str:
    return f"""{_with(_ORDERS, _WORLD, _spread(4, 4), _ASSIGNED, _morton("tiled", "keyed"))},
    steps AS (
      SELECT greatest(abs(wx - lag(wx) OVER w), abs(wy - lag(wy) OVER w)) AS s FROM keyed
      WINDOW w AS (PARTITION BY tile_x, tile_y ORDER BY morton, fid)),
    median AS (SELECT quantile_cont(s, 0.5) AS m FROM steps WHERE s IS NOT NULL)
    SELECT CAST(coalesce(min(z), 14) AS INTEGER) AS maxzoom
    FROM median, (SELECT unnest(range(0, 15)) AS z) WHERE m >= pow(2.0, 20 - z)"""


def _coalesce_sql() -> str:
    return f"""{_with(_EVENTS, _WORLD, _TWO_ZOOMS, _ASSIGNED, _QUANTIZED, _morton("grid", "keyed"), _ranked(20))},
    owned AS (
      SELECT *, last_value(CASE WHEN kept THEN fid END IGNORE NULLS) OVER (PARTITION BY zoom, tile_x, tile_y
        ORDER BY morton, fid ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS owner FROM marked)
    SELECT zoom, tile_x, tile_y, owner AS fid, count(*) AS point_count, CAST(sum(user_id) AS BIGINT) AS user_id,
      CAST(count(DISTINCT px * 100000 + py) AS INTEGER) AS positions
    FROM owned GROUP BY zoom, tile_x, tile_y, owner"""


def _cell(distance: int, zoom: str) -> str:
    return f"(CAST({distance} AS BIGINT) << (24 - {zoom}))"


def oracle_sql() -> dict[str, str]:
    return _tile_sql() | (llm.oracle_sql() if llm else {})


def _tile_sql() -> dict[str, str]:
    cell8, cell32 = _cell(8, "zoom"), _cell(32, "2")
    buffered_events = _with(_EVENTS, _WORLD, _spread(0, 10), _BUFFERED)
    copies = f"{_with(_CUSTOMER, _WORLD, _spread(6, 6), _BUFFERED)}"
    addresses = _with(_CUSTOMER, _WORLD, _spread(0, 7), _BUFFERED) + " SELECT DISTINCT zoom, tile_x, tile_y FROM tiled"
    clusters = f"""{_with(_EVENTS, _WORLD, _spread(0, 4))},
    cells AS (SELECT zoom, count(*) AS n, sum(user_id) AS u FROM spread
      GROUP BY zoom, wx // {_cell(16, "zoom")}, wy // {_cell(16, "zoom")})
    SELECT zoom, count(*) AS n, CAST(sum(n) AS DOUBLE) AS points, CAST(sum(u) AS DOUBLE) AS user_ids FROM cells GROUP BY zoom"""
    return {
        "points_resolved": f"""{_with(_CUSTOMER, _WORLD)}
            SELECT fid, fid % 10 <> 0 AS has_geometry, CASE WHEN fid % 10 <> 0 THEN CAST(wx >> 22 AS INTEGER) END AS tile_x,
              CASE WHEN fid % 10 <> 0 THEN CAST(wy >> 22 AS INTEGER) END AS tile_y FROM world""",
        "project_world": f"{_with(_EVENTS, _WORLD)} SELECT fid, wx, wy FROM world",
        "project_edges": f"""{_with(_points("events", "event_id", "user_id", scale=(2.5, 1.25)), _WORLD)}
            SELECT fid, wx, wy FROM world""",
        "tile_pyramid": f"""{_with(_LINEITEM, _WORLD, _spread(0, 8), _ASSIGNED)}
            SELECT zoom, tile_x, tile_y, count(*) AS n FROM tiled GROUP BY zoom, tile_x, tile_y""",
        "tile_assignment": f"""{_with(_CUSTOMER, _WORLD, _spread(0, 14), _ASSIGNED)}
            SELECT fid, zoom, tile_x, tile_y FROM tiled""",
        "tile_buffer_dup": f"""{buffered_events}
            SELECT zoom, tile_x, tile_y, count(*) AS n, CAST(sum(fid) AS BIGINT) AS fids FROM tiled GROUP BY zoom, tile_x, tile_y""",
        "quantize_z14": f"""{_with(_ORDERS, _WORLD, _spread(14, 14), _ASSIGNED, _QUANTIZED)}
            SELECT fid, tile_x, tile_y, px, py FROM grid""",
        "drop_rate_thin": f"""{_with(_EVENTS, _WORLD, _thin(0, 10, 2.5, 8))}
            SELECT zoom, count(*) AS n, CAST(sum(fid) AS BIGINT) AS fids FROM spread GROUP BY zoom""",
        "drop_densest": f"""{_with(_CUSTOMER, _WORLD, _TWO_ZOOMS, _ASSIGNED, _morton("tiled", "keyed"), _ranked(20))}
            SELECT zoom, tile_x, tile_y, fid FROM marked WHERE kept""",
        "drop_densest_hot": f"""{_with(_EVENTS, _WORLD, _TWO_ZOOMS, _ASSIGNED, _morton("tiled", "keyed"), _ranked(20))}
            SELECT zoom, tile_x, tile_y, fid FROM marked WHERE kept""",
        "coalesce_densest": _coalesce_sql(),
        "coalesce_densest_hot": _coalesce_sql(),
        "cluster_points": f"""{_with(_EVENTS, _WORLD, _spread(0, 6))}
            SELECT zoom, wx // {cell8} AS cell_x, wy // {cell8} AS cell_y, CAST(sum(wx) // count(*) AS BIGINT) AS wx,
              CAST(sum(wy) // count(*) AS BIGINT) AS wy, count(*) AS point_count, min(fid) AS fid,
              CAST(sum(user_id) AS BIGINT) AS user_id
            FROM spread GROUP BY zoom, spread.wx // {cell8}, spread.wy // {cell8}""",
        "accumulate_attr": f"""{_with(_EVENTS, _WORLD)}
            SELECT wx // {cell32} AS cell_x, wy // {cell32} AS cell_y, CAST(sum(user_id) AS BIGINT) AS u_sum,
              min(user_id) AS u_min, max(user_id) AS u_max, round(avg(user_id), 6) AS u_mean, count(user_id) AS u_count,
              string_agg(CAST(user_id AS VARCHAR), ',' ORDER BY CAST(user_id AS VARCHAR)) AS u_concat
            FROM world GROUP BY wx // {cell32}, wy // {cell32}""",
        "guess_maxzoom": _guess_sql(),
        "guess_maxzoom_hot": _guess_sql(),
        "extend_zooms": _extend_sql(),
        "tile_caps": f"""{_with(_LINEITEM, _WORLD, _spread(0, 6), _BUFFERED)}
            SELECT zoom, tile_x, tile_y, count(*) AS n FROM tiled GROUP BY zoom, tile_x, tile_y HAVING count(*) > 300""",
        "tile_caps_bytes": _with(_EVENTS, _WORLD, _TWO_ZOOMS, _ASSIGNED, _morton("tiled", "keyed"), _within(20_000, 200_000)),
        "tile_caps_bytes_hot": _with(_EVENTS, _WORLD, _TWO_ZOOMS, _ASSIGNED, _morton("tiled", "keyed"), _within(20_000, 150)),
        "tms_flip": f"""{_with(_CUSTOMER, _WORLD, _spread(0, 14), _ASSIGNED)}
            SELECT fid, zoom, CAST((1 << zoom) - 1 - tile_y AS INTEGER) AS tile_row FROM tiled""",
        "inverse_project": f"""{_with(_EVENTS, _WORLD, _spread(14, 14), _ASSIGNED, _QUANTIZED)}
            SELECT fid, round((tile_x + CAST(px AS DOUBLE) / 4096) / 16384 * 360 - 180, 5) AS lon,
              round(degrees(atan(sinh(pi() * (1 - 2 * (tile_y + CAST(py AS DOUBLE) / 4096) / 16384)))), 5) AS lat FROM grid""",
        "hilbert_ids": f"""{_with(_EVENTS, _WORLD, _spread(9, 9), _ASSIGNED, _hilbert("tiled", "curve", 9))}
            SELECT fid, tile_id FROM curve""",
        "hilbert_inverse": f"""{_with(_CUSTOMER, _WORLD, _spread(0, 14), _ASSIGNED)}
            SELECT fid, zoom, tile_x, tile_y FROM tiled""",
        "collapse_runs": f"""{_payload_sql()},
            starts AS (
              SELECT *, CASE WHEN coalesce(lag(tile_id) OVER w = tile_id - 1 AND lag(payload) OVER w = payload, false)
                THEN 0 ELSE 1 END AS fresh FROM curve WINDOW w AS (ORDER BY tile_id)),
            numbered AS (SELECT *, sum(fresh) OVER (ORDER BY tile_id) AS run FROM starts)
            SELECT min(tile_id) AS tile_id, CAST(count(*) AS BIGINT) AS run_length, any_value(payload) AS payload
            FROM numbered GROUP BY run""",
        "expand_runs": f"{_payload_sql()} SELECT tile_id, payload FROM curve",
        "drop_empty": f"{_payload_sql()} SELECT tile_id, n FROM curve WHERE n > 1",
        "geojson_points": _geojson_points(),
        "geojson_nulls": _geojson_nulls(),
        "geojson_squares": _geojson_squares(),
        "geojson_text": """SELECT '{"type":"Feature","geometry":{"type": "Point",  "coordinates": [' || c_custkey % 180 || ', '
              || c_nationkey || ']},"properties":{"fid":' || c_custkey || ',"c_mktsegment":"' || c_mktsegment || '"}}' AS line
            FROM customer""",
        "tile_roundtrip": f"""{_with(_ORDERS, _WORLD, _spread(0, 5), _BUFFERED, _QUANTIZED)}
            SELECT fid, zoom, tile_x, tile_y, tile_x * {_side()} + px * (CAST(1 AS BIGINT) << (20 - zoom)) AS x,
              tile_y * {_side()} + py * (CAST(1 AS BIGINT) << (20 - zoom)) AS y FROM grid""",
        "tile_roundtrip_pieces": f"""{_with(_ORDERS, _WORLD, _spread(0, 3), _BUFFERED)}
            SELECT fid, zoom, tile_x, tile_y, o_orderstatus, o_totalprice, CAST(o_custkey AS DOUBLE) AS o_custkey FROM tiled""",
        "mbtiles_roundtrip": f"""{copies}
            SELECT 'points' AS layer, zoom, tile_x, tile_y, fid AS feature_id, c_name, c_acctbal, c_mktsegment FROM tiled""",
        "pmtiles_roundtrip": f"""{_with(_EVENTS, _WORLD, _spread(4, 4), _BUFFERED)}
            SELECT 'events' AS layer, zoom, tile_x, tile_y, fid AS feature_id, CAST(user_id AS DOUBLE) AS user_id, event_type,
              value FROM tiled""",
        "mbtiles_tiles": f"SELECT * FROM ({addresses}) WHERE zoom >= 3 AND zoom < 6",
        "pmtiles_tiles": addresses,
        "container_diff": f"""{_with(_CUSTOMER, _WORLD, _spread(5, 5), _BUFFERED)}
            SELECT 'left' AS side, fid AS feature_id, zoom, tile_x, tile_y, count(*) AS n FROM tiled WHERE fid % 10 = 0
            GROUP BY fid, zoom, tile_x, tile_y""",
        "layer_selection": f"""{_with(_ORDERS, _WORLD, _spread(4, 4), _BUFFERED)}
            SELECT o_orderstatus AS layer, zoom, tile_x, tile_y, count(*) AS n FROM tiled WHERE o_orderstatus = 'F'
            GROUP BY o_orderstatus, zoom, tile_x, tile_y""",
        "tile_table": f"""{_with(_CUSTOMER, _WORLD, _thin(0, 5, 2.0, 5), _BUFFERED)}
            SELECT zoom, tile_x, tile_y, fid AS feature_id FROM tiled""",
        "build_clustered": clusters,
        "build_densest": f"""{_with(_EVENTS, _WORLD, _spread(0, 5), _BUFFERED, _morton("tiled", "keyed"), _ranked(50))}
            SELECT zoom, tile_x, tile_y, fid AS feature_id FROM marked WHERE kept""",
        "shape_tiles": _shape_tiles(),
        "vertices": f"""{_with(_ORDERS, _WORLD)}
            SELECT o_custkey AS fid, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, fid) - 1 AS INTEGER) AS pos,
              ux AS x, uy AS y FROM (SELECT *, count(*) OVER (PARTITION BY o_custkey) AS stops FROM world) AS world
            WHERE stops > 1""",
        "line_tiles": f"""{_with(_ORDERS, _WORLD, _spread(0, 6))},
            cells AS (
              SELECT zoom, o_custkey, count(DISTINCT CAST(ux >> (20 - zoom) AS HUGEINT) * 1000000000 + (uy >> (20 - zoom))) AS n
              FROM spread GROUP BY zoom, o_custkey)
            SELECT zoom, count(*) AS features FROM cells WHERE n > 1 GROUP BY zoom""",
        "hole_roundtrip": "SELECT s_suppkey AS fid, CASE WHEN s_suppkey % 3 = 0 THEN 2 ELSE 1 END AS rings FROM supplier",
        "geometry_profile": _profile_sql(),
        "dedupe_features": f"""{_rows_sql(8, 8)},
            first AS (SELECT *, row_number() OVER (PARTITION BY layer, feature_id ORDER BY zoom, tile_x, tile_y) AS r FROM rows)
            SELECT layer, zoom, tile_x, tile_y, feature_id, user_id FROM first WHERE r = 1""",
        "feature_counts": f"""{_rows_sql(0, 8)}
            SELECT layer, zoom, count(DISTINCT feature_id) AS features FROM rows GROUP BY layer, zoom""",
        "has_duplicates": f"""{_rows_sql(0, 8)}
            SELECT layer, zoom, count(*) > count(DISTINCT feature_id) AS duplicated FROM rows GROUP BY layer, zoom""",
        "feature_survival": f"""{_rows_sql(0, 8)},
            firsts AS (SELECT layer, feature_id, min(zoom) AS first_zoom FROM rows GROUP BY layer, feature_id)
            SELECT layer, first_zoom, count(*) AS features FROM firsts GROUP BY layer, first_zoom""",
        "layer_profile": f"""{_rows_sql(8, 8)}
            SELECT layer, 'user_id' AS attribute, count(user_id) AS n, CAST(min(user_id) AS VARCHAR) AS min,
              CAST(max(user_id) AS VARCHAR) AS max, count(DISTINCT user_id) AS "distinct" FROM rows GROUP BY layer
            UNION ALL SELECT layer, 'event_type', count(event_type), min(event_type), max(event_type),
              count(DISTINCT event_type) FROM rows GROUP BY layer""",
        "tile_size_report": f"""{_with(_LINEITEM, _WORLD, _spread(0, 7), _ASSIGNED)},
            sized AS (
              SELECT zoom, length(zoom || '/' || tile_x || '/' || tile_y || '/' || count(*)) AS size FROM tiled
              GROUP BY zoom, tile_x, tile_y)
            SELECT zoom, count(*) AS tiles, CAST(sum(size) AS BIGINT) AS bytes, CAST(max(size) AS INTEGER) AS largest,
              quantile_cont(size, 0.5) AS median FROM sized GROUP BY zoom""",
        "stray_addresses": f"""{_with(_CUSTOMER, _WORLD, _spread(6, 6), _BUFFERED)}
            SELECT DISTINCT zoom, tile_x, tile_y FROM tiled WHERE tile_x < 32""",
        "tile_nested_props": f"""{_with(_EVENTS, _WORLD, _spread(3, 3), _BUFFERED)}
            SELECT fid AS feature_id, zoom, tile_x, tile_y, '{{"day":"2024-01-0' || (fid % 9 + 1) || '","n":' || user_id || '}}' AS what,
              '[' || (fid % 7) || ',null]' AS list, '{{"' || event_type || '":true}}' AS flags FROM tiled""",
        "tile_underscore_prop": f"""{_with(_EVENTS, _WORLD, _spread(3, 3), _BUFFERED)}
            SELECT fid AS feature_id, zoom, tile_x, tile_y, event_type AS _, 'u' || user_id AS a FROM tiled""",
        "overwrite_forms": f"""{_with(_CUSTOMER, _WORLD, _spread(4, 4), _BUFFERED)}
            SELECT fid AS feature_id, tile_x, tile_y FROM tiled WHERE fid % 2 = 0""",
        "extend_zooms_shapes": _extend_shapes_sql(),
        "closed_rings_open": """SELECT CASE WHEN s_suppkey % 5 = 0 THEN 'open' WHEN s_suppkey % 5 < 3 THEN 'closed' ELSE 'lines' END AS layer,
              CASE WHEN max(s_suppkey % 5) < 3 THEN min(s_suppkey % 5) > 0 END AS closed
            FROM supplier GROUP BY ALL""",
        "simplify_zigzags": """WITH lines AS (SELECT o_custkey AS fid, count(*) AS n FROM orders GROUP BY o_custkey HAVING count(*) > 1),
            zooms AS (SELECT *, CAST(z AS INTEGER) AS zoom, 360.0::DOUBLE / (1 << z) AS side FROM lines, (SELECT unnest([4, 5]) AS z))
            SELECT fid, zoom, CAST(CASE WHEN zoom = 5 OR fid % 2 = 0 THEN n ELSE 2 END AS INTEGER) AS vertices,
              CAST(floor(1.0::DOUBLE / side * 4096) AS INTEGER) AS first, CAST(floor((1.0::DOUBLE + (n - 1) * 0.1::DOUBLE) / side * 4096) AS INTEGER) AS last
            FROM zooms""",
        "line_tiles_by_address": _level_lines_sql(),
        "tile_size_report_tiles": _real_sizes_sql(),
        "project_edge_rows": f"""{_with(_CUSTOMER)},
            edges AS (
              SELECT fid, CASE fid % 9 WHEN 0 THEN 180 WHEN 1 THEN -180 WHEN 2 THEN lon + 200 WHEN 3 THEN 720 WHEN 4 THEN 720
                  WHEN 5 THEN NULL ELSE lon END AS lon,
                CASE fid % 9 WHEN 0 THEN 85 WHEN 1 THEN -85 WHEN 6 THEN 89.9 WHEN 7 THEN 89.9 WHEN 8 THEN 89.9 ELSE lat END AS lat
              FROM located),
            world_raw AS (
              SELECT fid, CAST(4294967296 AS DOUBLE) * ((CASE WHEN lon = 720 THEN 720 ELSE greatest(-360, least(360, lon)) END + 180) / 360) AS vx, lon,
                CAST(4294967296 AS DOUBLE) * (1 - ln(tan(lat * pi() / 180) + 1 / cos(lat * pi() / 180)) / pi()) / 2 AS vy FROM edges)
            SELECT fid, CASE WHEN lon IS NOT NULL THEN CAST(CASE WHEN vx >= 0 THEN floor(vx + 0.5) ELSE -floor(0.5 - vx) END AS BIGINT) & 4294967295 END AS wx,
              greatest(0, least(4294967295, CAST(CASE WHEN vy >= 0 THEN floor(vy + 0.5) ELSE -floor(0.5 - vy) END AS BIGINT))) AS wy FROM world_raw""",
        "geojson_tiles": f"""WITH located AS (SELECT c_custkey AS fid, CAST(c_custkey % 180 AS DOUBLE) AS lon, CAST(c_nationkey AS DOUBLE) AS lat FROM customer),
            {_with(_WORLD, _spread(4, 4), _BUFFERED, _QUANTIZED).removeprefix("WITH ")}
            SELECT fid, zoom, tile_x, tile_y, tile_x * {_side()} + px * (CAST(1 AS BIGINT) << (20 - zoom)) AS x,
              tile_y * {_side()} + py * (CAST(1 AS BIGINT) << (20 - zoom)) AS y FROM grid""",
        "explicit_pair_tiles": f"""WITH located AS (SELECT c_custkey AS fid, CAST(c_custkey % 170 AS DOUBLE) AS lon, CAST(c_nationkey AS DOUBLE) AS lat, c_name FROM customer),
            {_with(_WORLD, _spread(4, 4), _BUFFERED).removeprefix("WITH ")}
            SELECT fid, zoom, tile_x, tile_y, c_name AS lon FROM tiled""",
        "failed_overwrite": f"""{_with(_CUSTOMER, _WORLD, _spread(4, 4), _BUFFERED)}
            SELECT fid AS feature_id, tile_x, tile_y FROM tiled""",
        "write_errors": """SELECT "case", error, (SELECT count(*) FROM customer) AS rows FROM (VALUES ('empty', 'TileBuildError'),
              ('unknown', 'OptionError'), ('lon without lat', 'OptionError'), ('no such column', 'OptionError'), ('two values', 'OptionError'),
              ('zooms', 'OptionError'), ('number', 'OptionError')) AS t("case", error)""",
        "geojson_ordered": "SELECT count(*) AS lines, true AS ascending, CAST(0 AS BIGINT) AS overlaps FROM customer",
        "closed_rings": "SELECT 'features' AS layer, count(*) > 0 AS closed FROM supplier",
    }
