"""Zoom rules, buffers, thinning, clipping; the forms for crowded tiles against the plain ones."""

from __future__ import annotations

from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

import sparktiles as st
from sparktiles.functions import shapes as sh
from sparktiles.functions.projection import project_world, to_lonlat
from sparktiles.functions.ragged import offsets_of
from sparktiles.operators import runs, tiling
from sparktiles.operators.encode import encode_tiles, points_as_parts
from sparktiles.operators.shapes import tile_shapes


def test_projection_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, 0.0, 0.0), (1, 180.0, 85.0), (2, 200.0, 10.0), (3, 10.0, 89.95), (4, nan, 1.0), (5, None, 1.0), (6, 10.0, -inf)]
    got = {r.i: (r.wx, r.wy) for r in project_world(spark.createDataFrame(rows, "i int, lon double, lat double")).collect()}
    assert got[0] == (2**31, 2**31) and got[1][0] == 0
    assert got[2][0] == round(2**32 * 20 / 360) and got[3][1] == 0
    assert got[4][0] == 2**31 and got[5][0] is None and got[6][1] == 0


def test_buffer_pair(spark):
    df = spark.createDataFrame([(1, 0.0219, 0.01), (2, 0.0220, 0.01)], "fid long, lon double, lat double")
    tiled = tiling.buffered_tiles(project_world(df).withColumn("zoom", F.lit(14)), 5)
    assert sorted((r.fid, r.tile_x) for r in tiled.collect()) == [(1, 8192), (1, 8193), (2, 8192), (2, 8193)]
    assert tiling.buffered_tiles(project_world(df).withColumn("zoom", F.lit(14)), 0).count() == 2


def test_thinning_is_nested(spark):
    df = spark.range(1, 5000).select(F.col("id").alias("fid"))
    thin = tiling.thin_fan_out(df, 0, 6, 2.5)
    zooms = {z: {r.fid for r in thin.filter(F.col("zoom") == z).collect()} for z in (0, 3, 5, 6)}
    assert zooms[0] <= zooms[3] <= zooms[5] <= zooms[6] and len(zooms[6]) == 4999
    assert abs(len(zooms[5]) / 4999 - 0.4) < 0.03


@pytest.fixture(scope="module")
def crowd(spark):
    """A third of the rows at one position, the rest spread."""
    i = F.col("id")
    hot = i % 3 == 0
    lon = F.when(hot, F.lit(12.5)).otherwise(((i * 7919) % 3600000) / 10000.0 - 180)
    lat = F.when(hot, F.lit(41.9)).otherwise(((i * 15485863) % 1700000) / 10000.0 - 85)
    df = spark.range(3000).select(i.alias("fid"), lon.alias("lon"), lat.alias("lat"), (i % 10).alias("v"))
    return tiling.assign_tiles(tiling.fan_out(project_world(df), 0, 2)).cache()


@pytest.mark.parametrize("limit", [5, 700])
def test_crowded_tiles_agree_with_plain(crowd, limit):
    plain = tiling.drop_densest(crowd, limit)
    sliced = tiling.drop_densest(crowd, limit, hot_rows=200)
    assert plain.exceptAll(sliced).count() == 0 and sliced.exceptAll(plain).count() == 0
    assert tiling.tile_counts(plain).agg(F.max("n")).first()[0] <= limit
    parts = points_as_parts(tiling.quantize_points(crowd)).drop("px", "py")
    a = tiling.coalesce_densest(parts, limit, {"v": "sum"})
    b = tiling.coalesce_densest(parts, limit, {"v": "sum"}, hot_rows=200)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert a.agg(F.sum("point_count")).first()[0] == crowd.count()
    assert a.agg(F.sum("v")).first()[0] == crowd.agg(F.sum("v")).first()[0]


def test_slices_are_no_more_than_tasks_need(crowd):
    """A slice is a task and a file: 3,000 rows in slices of 2 would be 1,500 of either."""
    largest, total = tiling.fullest(tiling.tile_counts(crowd))
    rows = tiling._ordered(crowd, 2, largest, total)
    assert rows.select("_b").distinct().count() <= int(crowd.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    assert tiling.slice_count(9_000_000, 50, 200) == 200 and tiling.slice_count(600, 200, 200) == 3
    assert tiling.slice_count(10**9, 10**6, 200) == 1000


def test_properties_are_not_sorted_with_the_places(spark, monkeypatch):
    """TIL-9 in a build ranks rows by number and position alone, and keeps what it kept with all columns."""
    from sparktiles.operators import tiling as operators

    seen = []
    plain = operators.drop_densest
    monkeypatch.setattr(operators, "drop_densest", lambda df, *a, **k: seen.append(df.columns) or plain(df, *a, **k))
    df = spark.range(400).selectExpr("id % 390 as fid", "double(id * 7 % 90) as lon", "double(id * 11 % 60) as lat", "concat('p', id % 3) as p")
    made = st.build(df, id_column="fid", maxzoom=2, drop_densest_as_needed=True, tile_feature_limit=40)
    got = st.decode_tiles(made.tiles, [("p", "string")])
    assert seen and all("props" not in columns for columns in seen)
    assert got.groupBy("zoom", "tile_x", "tile_y").count().agg(F.max("count")).first()[0] == 40
    assert got.filter("p IS NULL").count() == 0


def test_gap_order_by_brute_force(crowd):
    """TIL-9 spelled out in Python for one tile."""
    from sparktiles.functions.projection import with_morton

    rows = sorted((r.morton, r.fid) for r in with_morton(crowd.filter("zoom = 0")).collect())
    gaps = [(None if i == 0 else m - rows[i - 1][0], f) for i, (m, f) in enumerate(rows)]
    order = sorted(gaps, key=lambda g: (0 if g[0] is None else 1, -(g[0] or 0), g[1]))
    got = {r.fid for r in tiling.drop_densest(crowd.filter("zoom = 0"), 50, hot_rows=100).collect()}
    assert got == {f for _, f in order[:50]}


def test_pieces_agree_with_whole(spark, crowd):
    rows = points_as_parts(tiling.quantize_points(crowd)).select(
        "zoom", "tile_x", "tile_y", F.concat(F.lit("l"), F.col("v") % 2).alias("layer"), "fid", "gtype", "parts",
        F.struct("v", F.when(F.col("fid") % 5 > 0, F.col("fid").cast("string")).alias("s")).alias("props"),
    )
    kinds = [("v", "double"), ("s", "string")]
    whole = st.decode_tiles(encode_tiles(rows), kinds)
    cut = st.decode_tiles(encode_tiles(rows, piece_rows=100), kinds)
    assert whole.count() == 9000 and st.tileset_diff(whole, cut).count() == 0
    assert encode_tiles(rows, piece_rows=100).groupBy("zoom", "tile_x", "tile_y").count().filter("count > 1").count() == 0


def test_inverse_projection_returns_the_grid_point(spark):
    df = spark.createDataFrame([(1, 5.5, 6.25)], "fid long, lon double, lat double")
    q = tiling.quantize_points(tiling.assign_tiles(project_world(df).withColumn("zoom", F.lit(14))))
    r = to_lonlat(q.drop("lon", "lat")).first()
    assert abs(r.lon - 5.5) < 6e-6 and abs(r.lat - 6.25) < 6e-6


def test_guess_maxzoom(spark):
    grid = spark.range(10000).select(
        F.col("id").alias("fid"), ((F.col("id") % 100) * 0.01).alias("lon"), (F.floor(F.col("id") / 100) * 0.01).alias("lat")
    )
    plain = tiling.guess_maxzoom(project_world(grid)).first().maxzoom
    assert plain == tiling.guess_maxzoom(project_world(grid), hot_rows=500).first().maxzoom
    # 0.01 degrees are 119305 units of 2^-32 of the world; 2^(20-z) is below that from z 4 on
    assert plain == 4
    assert st.build(grid, maxzoom="g").maxzoom == 4


def test_extend_zooms(spark):
    grid = spark.range(400).select(
        F.col("id").alias("fid"), ((F.col("id") % 20) * 0.5).alias("lon"), (F.floor(F.col("id") / 20) * 0.5).alias("lat")
    )
    made = st.build(grid, maxzoom=2, drop_densest_as_needed=True, extend_zooms_if_still_dropping=True, tile_feature_limit=50)
    assert made.maxzoom > 2
    top = st.decode_tiles(made.tiles.filter(F.col("zoom") == made.maxzoom), [("fid", "double")])
    assert top.select("fid").distinct().count() == 400


def test_coalesced_build(spark):
    grid = spark.range(500).select(F.col("id").alias("n"), (F.col("id") * 0.1).alias("lon"), F.lit(1.0).alias("lat"))
    made = st.build(grid, maxzoom=1, buffer=0, coalesce_densest_as_needed=True, tile_feature_limit=20, accumulate={"n": "sum"})
    out = st.decode_tiles(made.tiles, [("point_count", "double"), ("n", "double")])
    for r in out.groupBy("zoom").agg(F.sum("point_count").alias("c"), F.sum("n").alias("n"), F.count("*").alias("f")).collect():
        assert r.c == 500 and r.n == sum(range(500)) and r.f <= 20
    assert "point_count" in made.metadata["vector_layers"][0]["fields"]


def test_clustered_shapes_and_points(spark, wkb):
    rows = [(i, wkb.point(10 + i * 1e-4, 10)) for i in range(5)] + [(9, wkb.line([(0, 0), (50, 50)]))]
    made = st.build(spark.createDataFrame(rows, "n int, geom binary"), maxzoom=1, cluster_distance=8, buffer=0)
    got = st.decode_tiles(made.tiles, [("point_count", "double")]).filter("zoom = 0").select("point_count").collect()
    assert sorted(r.point_count for r in got) == [1.0, 5.0]


def test_runs(spark):
    rows = [(10, b"a"), (11, b"a"), (12, b"b"), (14, b"b"), (15, b"b")]
    df = spark.createDataFrame([(i, bytearray(p)) for i, p in rows], "tile_id long, tile_data binary")
    made = runs.collapse_runs(df)
    got = sorted((r.tile_id, r.run_length, bytes(r.tile_data)) for r in made.collect())
    assert got == [(10, 2, b"a"), (12, 1, b"b"), (14, 2, b"b")]
    assert runs.expand_runs(made).exceptAll(df).count() == 0
    assert runs.collapse_runs(df, bits=1).agg(F.sum("run_length")).first()[0] == 5


def area(flat):
    x, y = np.array(flat[::2], float), np.array(flat[1::2], float)
    return float(np.dot(x, np.roll(y, -1)) - np.dot(np.roll(x, -1), y)) / 2


@pytest.mark.parametrize("split_zoom", [2, 20])
def test_clipped_area_adds_up(spark, wkb, split_zoom):
    star = [(20 + (8 if k % 2 else 3) * np.cos(k * np.pi / 5), 30 + (8 if k % 2 else 3) * np.sin(k * np.pi / 5)) for k in range(10)]
    df = spark.createDataFrame([(1, wkb.polygon(star + star[:1])), (2, wkb.polygon(wkb.square(178, 0, 6)))], "fid int, geom binary")
    cut = tile_shapes(df, 0, 7, buffer=0, simplification=0.0, split_zoom=split_zoom)
    totals = {}
    for r in cut.collect():
        totals.setdefault((r.fid, r.zoom), []).append(sum(area(p) for p in r.parts) * 4.0 ** (7 - r.zoom))
    for fid in (1, 2):
        fine = sum(totals[fid, 7])
        assert fine > 0
        for z in (3, 4, 5, 6):
            assert abs(sum(totals[fid, z]) / fine - 1) < 0.02
    sides = {r.tile_x for r in cut.filter("fid = 2 and zoom = 1").collect()}
    assert sides == {0, 1}  # wraps over the antimeridian


def test_clip_against_brute_force():
    """Random triangles against a box: the clipped area equals that of sampling the exact overlap."""
    rng = np.random.default_rng(3)
    for _ in range(50):
        tri = rng.uniform(-2, 3, (3, 2))
        s = sh.Shapes(tri, np.array([0, 3]), np.array([0]), np.array([3]), np.array([0]), np.array([False]))
        one = np.ones(1)
        out = sh.clip(s, 0 * one, 0 * one, one, one)
        got = abs(area(out.xy.reshape(-1))) if len(out) else 0.0
        g = (np.arange(200) + 0.5) / 200
        px, py = (a.reshape(-1) for a in np.meshgrid(g, g))
        sign = [
            (b[0] - a[0]) * (py - a[1]) - (b[1] - a[1]) * (px - a[0]) > 0 for a, b in zip(tri, np.roll(tri, -1, axis=0))
        ]
        inside = (sign[0] == sign[1]) & (sign[1] == sign[2])
        assert abs(got - inside.mean()) < 0.02


def test_line_is_cut_into_parts():
    xy = np.array([[-1, 0.5], [0.5, 0.5], [0.5, 2], [0.7, 2], [0.7, 0.2]])
    s = sh.Shapes(xy, np.array([0, 5]), np.array([0]), np.array([2]), np.array([0]), np.array([False]))
    one = np.ones(1)
    out = sh.clip(s, 0 * one, 0 * one, one, one)
    assert [p.tolist() for p in np.split(out.xy, out.off[1:-1])] == [[[0, 0.5], [0.5, 0.5], [0.5, 1]], [[0.7, 1], [0.7, 0.2]]]


def reference_simplify(xy, tol):
    if len(xy) < 3:
        return list(range(len(xy)))
    p, q = xy[0], xy[-1]
    d = q - p
    t = np.clip(((xy[1:-1] - p) @ d) / max(d @ d, 1e-300), 0, 1)[:, None]
    dist = np.linalg.norm(xy[1:-1] - p - t * d, axis=1)
    k = int(np.argmax(dist)) + 1
    if dist[k - 1] <= tol:
        return [0, len(xy) - 1]
    return reference_simplify(xy[: k + 1], tol)[:-1] + [i + k for i in reference_simplify(xy[k:], tol)]


def test_simplify_against_recursion():
    rng = np.random.default_rng(5)
    lines = [np.cumsum(rng.normal(size=(n, 2)), axis=0) for n in (2, 3, 10, 50, 200)]
    n = np.array([len(p) for p in lines])
    s = sh.Shapes(np.concatenate(lines), offsets_of(n), np.arange(5), np.full(5, 2), np.zeros(5, int), np.zeros(5, bool))
    out = sh.simplify(s, np.full(5, 1.5))
    for i, p in enumerate(lines):
        assert (out.xy[out.off[i] : out.off[i + 1]] == p[reference_simplify(p, 1.5)]).all()


def test_simplify_keeps_rings(spark, wkb):
    tiny = wkb.polygon(wkb.square(0.3, 0.3, 0.2))
    cut = tile_shapes(spark.createDataFrame([(1, tiny)], "fid int, geom binary"), 0, 6, simplification=50.0)
    assert all(len(p) >= 6 for r in cut.collect() for p in r.parts)


def test_analytics_keep_rows_without_key(spark):
    rows = [("a", 1, 0, 0, 7), ("a", 1, 1, 0, 7), ("a", 1, 1, 0, None), ("a", 1, 1, 0, None)]
    df = spark.createDataFrame(rows, "layer string, zoom int, tile_x int, tile_y int, feature_id long")
    out = st.dedupe_features(df).collect()
    assert sorted((r.feature_id or -1, r.tile_x) for r in out) == [(-1, 1), (-1, 1), (7, 0)]


def test_thinning_does_not_depend_on_the_layout(spark):
    points = spark.range(6000).selectExpr("id AS fid", "cast(id * 7919 % 3000 as double) / 100 AS lon", "cast(id * 104729 % 1700 as double) / 100 AS lat")
    twice = points.unionByName(points.filter("fid < 50"))

    def kept(df):
        made = st.build(df, id_column="fid", maxzoom=2, drop_densest_as_needed=True, tile_feature_limit=700)
        return sorted(tuple(r) for r in st.decode_tiles(made.tiles, []).select("zoom", "tile_x", "tile_y", "feature_id").collect())

    assert kept(twice.repartition(3)) == kept(twice.orderBy(F.desc("lat")).coalesce(1))


def test_cut_off_by_counting(spark):
    rows = spark.range(5000).selectExpr("1 AS zoom", "0 AS tile_x", "0 AS tile_y", "id AS fid", "CASE WHEN id % 100 <> 7 THEN id % 13 END AS gap")
    rows = rows.unionByName(spark.range(30).selectExpr("1 AS zoom", "1 AS tile_x", "0 AS tile_y", "id AS fid", "id AS gap"))
    for limit in (1, 60, 1000):
        plain = tiling._top_per_tile(rows, limit, 10_000, 5000).filter("kept").select("tile_x", "fid")
        counted = tiling._top_per_tile(rows, limit, 100, 5000).filter("kept").select("tile_x", "fid")
        assert sorted(plain.collect()) == sorted(counted.collect())


def test_groups_of_several_batches_keep_all_rows():
    import pyarrow as pa

    from sparktiles.operators.encode import whole_groups

    parts = [pa.record_batch({"zoom": [1] * n, "tile_x": [0] * n, "tile_y": [0] * n, "i": list(range(a, a + n))}) for a, n in ((0, 3), (3, 2), (5, 4))]
    assert [x for b in whole_groups(iter(parts), ["zoom", "tile_x", "tile_y"]) for x in b.column("i").to_pylist()] == list(range(9))


def test_positions_that_are_not_finite_are_left_out(spark, wkb):
    points = spark.createDataFrame([(1, float("nan"), 1.0), (2, 1.0, float("inf")), (3, 1.0, 2.0)], "fid int, lon double, lat double")
    assert [r.feature_id for r in st.decode_tiles(st.build(points, id_column="fid", maxzoom=0).tiles, []).collect()] == [3]
    nan = float("nan")
    shapes = spark.createDataFrame([(1, wkb.line([(nan, nan), (nan, nan)])), (2, wkb.point(nan, 3.0))], "fid int, geom binary")
    assert st.build(shapes, id_column="fid", maxzoom=0, allow_empty=True).tiles.count() == 0


def test_runs_go_on_over_block_edges(spark):
    rows = spark.range(20).selectExpr("id AS tile_id", "CASE WHEN id BETWEEN 3 AND 17 THEN 'a' ELSE cast(id as string) END AS tile_data")
    whole = {(r.tile_id, r.run_length) for r in runs.collapse_runs(rows, bits=2).collect()}
    assert whole == {(i, 1) for i in (0, 1, 2, 18, 19)} | {(3, 15)}


@pytest.mark.parametrize("bits", [1, 3])
def test_runs_are_joined_over_ranges_of_the_curve(spark, bits):
    """Edges dealt to several ranges, some of which one run covers whole; against one pass over sorted rows."""
    import random

    draw = random.Random(3)
    rows, at = [], 0
    for _ in range(120):
        at += draw.choice([0, 0, 1, 5])
        for _ in range(draw.choice([1, 2, 3, 40])):
            rows.append((at, draw.choice("ab")) if len(rows) % 7 == 0 else (at, rows[-1][1] if rows else "a"))
            at += 1
    want = []
    for i, p in sorted(rows):
        if want and want[-1][0] + want[-1][1] == i and want[-1][2] == p:
            want[-1] = (want[-1][0], want[-1][1] + 1, p)
        else:
            want.append((i, 1, p))
    df = spark.createDataFrame(rows, "tile_id long, tile_data string")
    made = runs.collapse_runs(df, bits=bits)
    assert sorted((r.tile_id, r.run_length, r.tile_data) for r in made.collect()) == want
    assert runs.expand_runs(made).exceptAll(df).count() == 0
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert not any("Window [" in line and "], [" not in line for line in plan.splitlines())  # every window has keys


def test_long_runs_are_expanded_in_stretches(spark):
    long = spark.createDataFrame([(5, 400_000_000), (1 << 40, 70_000), (3, 1), (4, 0)], "tile_id long, run_length long")
    got = runs.expand_runs(long)
    assert got.count() == 400_070_002
    small = runs.expand_runs(long.filter("run_length < 100000")).agg(F.min("tile_id"), F.max("tile_id"), F.count_distinct("tile_id")).first()
    assert tuple(small) == (3, (1 << 40) + 69_999, 70_002)


def test_budgets_of_bytes_by_adding_up(spark):
    """The cut-off found by sums of digits against running sums, with budgets of some tiles only."""
    rows = spark.range(4000).selectExpr(
        "1 AS zoom", "cast(id % 3 as int) AS tile_x", "0 AS tile_y", "id AS fid", "CASE WHEN id % 100 <> 7 THEN id % 13 END AS gap", "id % 17 + 1 AS _w"
    )
    budgets = spark.createDataFrame([(1, 0, 0, 3000), (1, 1, 0, 0)], "zoom int, tile_x int, tile_y int, budget long")
    plain = tiling.keep_within(rows, budgets, 10_000, 2000).filter("kept").select("tile_x", "fid", "_w")
    summed = tiling.keep_within(rows, budgets, 100, 2000).filter("kept").select("tile_x", "fid", "_w")
    assert sorted(plain.collect()) == sorted(summed.collect())
    sizes = {r.tile_x: (r.n, r.w) for r in plain.groupBy("tile_x").agg(F.count("*").alias("n"), F.sum("_w").alias("w")).collect()}
    assert 1 not in sizes and 2950 < sizes[0][1] <= 3000 and sizes[2][0] == 1333


@pytest.fixture()
def small_cap(monkeypatch):
    from sparktiles.plans import build

    monkeypatch.setattr(build, "MAX_TILE_BYTES", 20_000)


@pytest.mark.parametrize("how", ["drop_densest_as_needed", "coalesce_densest_as_needed"])
def test_tiles_are_thinned_until_they_fit(spark, small_cap, how):
    """Random texts do not pack, equal ones do: both kinds of tiles end up under the cap and not far below it."""
    i = F.col("id")
    points = spark.range(9000).select(
        i.alias("fid"),
        (((i * 7919) % 3600) / 10.0 - 180).alias("lon"),
        (((i * 104729) % 1700) / 10.0 - 85).alias("lat"),
        F.when(i * 7919 % 3600 < 1800, F.sha2(i.cast("string"), 256)).otherwise(F.lit("the same " * 20)).alias("note"),
    )
    options = {"id_column": "fid", "maxzoom": 2, "no_tile_size_limit": False, how: True}

    def built(df):
        tiles = st.build(df, **options).tiles
        return sorted((r.zoom, r.tile_x, r.tile_y, bytes(r.tile_data)) for r in tiles.collect())

    tiles = built(points.repartition(5))
    assert max(len(t[3]) for t in tiles) <= 20_000
    low = next(t for t in tiles if t[0] == 0)
    assert len(low[3]) > 12_000  # one more pass brings it near the cap
    assert tiles == built(points.orderBy(F.desc("lat")).coalesce(2))
    without = st.build(points, **(options | {"no_tile_size_limit": True})).tiles
    assert without.agg(F.max(F.octet_length("tile_data"))).first()[0] > 20_000


def test_a_feature_larger_than_the_cap_is_left_out_alone(spark, small_cap):
    rows = [(1, 10.0, 10.0, "x"), (2, 11.0, 11.0, "y")]
    df = spark.createDataFrame(rows, "fid long, lon double, lat double, note string").unionByName(
        spark.range(4000).selectExpr("id AS fid").withColumn("h", F.sha2(F.col("fid").cast("string"), 512)).agg(
            F.lit(3).cast("long").alias("fid"), F.lit(50.0).alias("lon"), F.lit(50.0).alias("lat"), F.concat_ws("", F.collect_list("h")).alias("note")
        )
    )
    made = st.build(df, id_column="fid", maxzoom=0, no_tile_size_limit=False, drop_densest_as_needed=True)
    assert sorted(r.feature_id for r in st.decode_tiles(made.tiles, []).collect()) == [1, 2]


def test_extension_of_shapes_against_one_cut_per_zoom(spark, wkb):
    """Small shapes, large ones and points, crowded at one place; some vanish at low zooms."""
    import random

    from sparktiles.operators.features import features
    from sparktiles.options import parse_options
    from sparktiles.plans.build import extended, tiled_shapes

    draw = random.Random(11)
    near = lambda: (draw.gauss(20, 0.3), draw.gauss(40, 0.3))
    rows = [(i, wkb.polygon(wkb.square(*near(), 0.4 if i < 8 else draw.choice([1e-5, 0.01])))) for i in range(120)]
    rows += [(200 + i, wkb.line([near(), near(), near()])) for i in range(20)]
    rows += [(300 + i, wkb.point(*near())) for i in range(120)]
    df = spark.createDataFrame(rows, "fid int, geom binary")
    opts = parse_options({"id_column": "fid", "maxzoom": 2, "tile_feature_limit": 60, "simplification": 0})
    feats, binding = features(df, opts, "x")
    feats = feats.withColumn("rid", F.col("fid"))
    for limit in (150, 40):
        opts.tile_feature_limit = limit
        want = 2
        while want < 12 and tiling.fullest(tiling.tile_counts(tiled_shapes(feats, replace(opts, minzoom=want), want)))[0] > limit:
            want += 1
        assert extended(feats, binding.kind, opts, 2) == want


def test_equal_rows_are_numbered_in_parts(spark):
    from sparktiles.operators.features import features
    from sparktiles.options import parse_options
    from sparktiles.plans.build import numbered_by_content

    rows = spark.range(600).selectExpr("CASE WHEN id % 4 = 0 THEN cast(id % 40 as int) END AS fid", "CASE WHEN id % 3 = 0 THEN 1.0D ELSE cast(id as double) / 10 END AS lon", "2.0D AS lat")
    opts = parse_options({"id_column": "fid"})

    def numbers(df):
        feats, _ = features(df, opts, "x")
        made = numbered_by_content(feats, True)
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert "row_number()" in plan and all("_p#" in line for line in plan.splitlines() if "row_number()" in line and "Window" in line)
        return sorted((r.rid, r.fid or -1, r.lon) for r in made.collect())

    one, other = numbers(rows.repartition(7)), numbers(rows.orderBy(F.desc("id")).coalesce(1))
    assert one == other and len({r[0] for r in one}) == 600


def test_ranges_of_the_curve_have_equal_rows(spark):
    """Most rows in one corner: bounds by counts, against the rows that each range gets."""
    from sparktiles.functions.projection import with_tile_id
    from sparktiles.operators.dealing import curve_bounds, range_of

    i = F.col("id")
    x = F.when(i % 10 < 8, i % 64).otherwise(i * 7919 % 4096).cast("int")
    y = F.when(i % 10 < 8, F.floor(i / 64) % 64).otherwise(i * 104729 % 4096).cast("int")
    tiles = spark.range(40_000).select(F.lit(12).alias("zoom"), x.alias("tile_x"), y.alias("tile_y"))
    counts = tiling.tile_counts(tiles)
    for parts in (2, 9, 40):
        bounds = curve_bounds(counts, parts, 12)
        assert bounds == sorted(set(bounds)) and len(bounds) <= parts - 1
        dealt = with_tile_id(tiles).select("tile_id", range_of("tile_id", bounds).alias("r"))
        sizes = dealt.groupBy("r").agg(F.count("*").alias("n"), F.min("tile_id").alias("a"), F.max("tile_id").alias("b")).orderBy("r").collect()
        assert all(p.b < q.a for p, q in zip(sizes, sizes[1:])) and {r.r for r in sizes} <= set(range(parts))
        assert max(r.n for r in sizes) < 1.6 * 40_000 / parts
    assert curve_bounds(counts.limit(0), 4, 12) == []


def test_files_of_a_tile_table_have_ranges_of_their_own(spark, tmp_path):
    from sparktiles.functions.projection import with_tile_id

    i = F.col("id")
    points = spark.range(5000).select(i.alias("fid"), (i * 7919 % 3600 / 10 - 180).alias("lon"), (i * 104729 % 1700 / 10 - 85).alias("lat"))
    st.write_tileset(points, f"{tmp_path}/tiles", id_column="fid", minzoom=5, maxzoom=5)
    tiles = with_tile_id(st.read_tiles(spark, f"{tmp_path}/tiles")).withColumn("file", F.input_file_name())
    files = tiles.groupBy("file").agg(F.min("tile_id").alias("a"), F.max("tile_id").alias("b")).orderBy("a").collect()
    assert len(files) == 8 and all(p.b < q.a for p, q in zip(files, files[1:]))
