"""Write, read back, compare across containers; the codec's corner cases."""

from __future__ import annotations

import gzip
import os
import sqlite3
import struct

import numpy as np
import pyarrow as pa
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

import sparktiles as st
from sparktiles.functions import mvt, tileread
from sparktiles.functions.projection import hilbert_ids, hilbert_tiles
from sparktiles.functions.ragged import Ragged, read_varints
from sparktiles.operators.decode import cast_value, decode_rows, output_schema
from sparktiles.plans.build import TileBuildError
from sparktiles.sources.common import parse_attributes
from sparktiles.sources.pmtiles import read_directory, write_directory

FIXED = ["geom", "layer", "zoom", "tile_x", "tile_y", "feature_id"]


@pytest.fixture(scope="module")
def places(spark, wkb):
    rows = [(wkb.point(-71.83, 44.324), "mill", 7), (wkb.point(-71.6, 44.4), "weir", 31)]
    return spark.createDataFrame(rows, "geom binary, label string, score int")


@pytest.fixture(scope="module")
def paths(spark, places, tmp_path_factory):
    root = tmp_path_factory.mktemp("sets")
    out = {}
    for fmt in ("mbtiles", "pmtiles"):
        for shards in (None, 1):
            path = out[fmt, shards] = f"{root}/rt{shards or ''}.{fmt}"
            extra = {} if shards is None else {"shards": 1}
            st.write_tileset(places, path, layer="places", minzoom=12, maxzoom=14, **extra)
    return out


@pytest.mark.parametrize("fmt", ["mbtiles", "pmtiles"])
@pytest.mark.parametrize("shards", [None, 1])
def test_round_trip(spark, paths, fmt, shards):
    df = st.read_tileset(spark, paths[fmt, shards])
    assert df.columns == [*FIXED, "label", "score"]
    rows = df.collect()
    assert sorted((r.label, r.score, r.tile_x, r.tile_y) for r in rows) == [
        ("mill", 7.0, 4922, 5936),
        ("mill", 7.0, 4922, 5937),
        ("weir", 31.0, 4933, 5932),
    ]
    where = {(r.label, *(round(v, 3) for v in struct.unpack("<dd", bytes(r.geom)[5:]))) for r in rows}
    assert where == {("mill", -71.83, 44.324), ("weir", -71.6, 44.4)}
    assert {r.zoom for r in rows} == {14} and {r.layer for r in rows} == {"places"}
    low = st.read_tileset(spark, paths[fmt, shards], zoom=12)
    assert low.select("label").distinct().count() == 2 and low.filter("zoom <> 12").count() == 0
    assert st.read_tileset(spark, paths[fmt, shards], layer="PLACES").count() == 3
    assert st.read_tileset(spark, paths[fmt, shards], layer="nope").count() == 0
    assert st.read_tileset(spark, paths[fmt, shards], zoom=32).count() == 0
    assert st.read_tileset(spark, paths[fmt, shards], columns="score").columns == [*FIXED, "score"]


@pytest.mark.parametrize("fmt", ["mbtiles", "pmtiles"])
def test_raw_tiles(spark, paths, fmt):
    read = st.read_mbtiles_tiles if fmt == "mbtiles" else st.read_pmtiles_tiles
    raw = read(spark, paths[fmt, None])
    assert raw.columns == ["zoom", "tile_x", "tile_y", "tile_data"]
    assert st.stray_addresses(st.read_tileset(spark, paths[fmt, None]), raw).count() == 0
    assert {r.zoom for r in raw.filter("zoom in (12, 14) and tile_y > 0").collect()} == {12, 14}
    decoded = st.decode_tiles(raw.filter("zoom = 14"), [("label", "string"), ("score", "double")])
    assert st.tileset_diff(decoded, st.read_tileset(spark, paths[fmt, 1])).count() == 0


def test_containers_agree(spark, paths):
    sets = [st.read_tileset(spark, p) for p in paths.values()]
    for other in sets[1:]:
        assert st.tileset_diff(sets[0], other).count() == 0


def test_shards_by_glob_without_manifest(spark, paths):
    whole = st.read_mbtiles(spark, paths["mbtiles", None])
    (folder,) = [f for f in os.listdir(paths["mbtiles", None]) if f.startswith("data-")]
    globbed = spark.read.format("mbtiles").load(f"{paths['mbtiles', None]}/{folder}/part-*.mbtiles")
    assert st.tileset_diff(whole, globbed).count() == 0


def test_keep_geojson_and_metadata(spark, places, tmp_path):
    kept = f"{tmp_path}/features.geojsonl"
    made = st.write_tileset(
        places, f"{tmp_path}/k.mbtiles", shards=1, maxzoom=1, keep_geojson=kept, name="n", description="d", attribution="a"
    )
    assert sorted(r.value.split('"label":')[1][:7] for r in spark.read.text(kept).collect()) == ['"mill",', '"weir",']
    assert made.metadata["vector_layers"][0]["fields"] == {"label": "String", "score": "Number"}
    with sqlite3.connect(f"{tmp_path}/k.mbtiles") as db:
        meta = dict(db.execute("SELECT name, value FROM metadata"))
    assert {k: meta[k] for k in ("name", "description", "attribution", "format", "maxzoom")} == {
        "name": "n",
        "description": "d",
        "attribution": "a",
        "format": "pbf",
        "maxzoom": "1",
    }
    assert '"id":"k"' in meta["json"]


def test_sql_view_and_magic(spark, paths):
    spark.sql(f"CREATE OR REPLACE TEMP VIEW rt USING mbtiles OPTIONS (path '{paths['mbtiles', None]}')")
    assert spark.sql("SELECT count(DISTINCT label) FROM rt").first()[0] == 2
    assert open(paths["mbtiles", 1], "rb").read(15) == b"SQLite format 3"
    assert open(paths["pmtiles", 1], "rb").read(7) == b"PMTiles"


def test_overwrite_and_layer_name(spark, wkb, tmp_path):
    path = f"{tmp_path}/layer.mbtiles"
    for v, x in (("first", 1), ("second", 9)):
        st.write_tileset(spark.createDataFrame([(wkb.point(x, x), v)], "geom binary, v string"), path, maxzoom=1)
    assert [(r.layer, r.v) for r in st.read_mbtiles(spark, path).collect()] == [("layer", "second")]
    again = spark.createDataFrame([(wkb.point(1, 1), "third")], "geom binary, v string")
    with pytest.raises(Exception, match="already exists"):
        st.write_tileset(again, path, maxzoom=1, force=False)
    assert st.read_mbtiles(spark, path).first().v == "second"


def test_failed_write_leaves_the_old_set(spark, wkb, tmp_path):
    path = f"{tmp_path}/kept.pmtiles"
    st.write_tileset(spark.createDataFrame([(wkb.point(1, 1), "old")], "geom binary, v string"), path, maxzoom=0)
    bad = spark.range(4).select(
        F.lit(0).alias("zoom"),
        F.lit(0).alias("tile_x"),
        F.lit(0).alias("tile_y"),
        F.when(F.col("id") == 3, F.raise_error("broken").cast("binary")).otherwise(F.lit(b"x")).alias("tile_data"),
    )
    with pytest.raises(Exception, match="broken"):
        st.write_container(bad, path)
    assert [r.v for r in st.read_pmtiles(spark, path).collect()] == ["old"]
    assert len([f for f in os.listdir(path) if f.startswith("data-")]) == 1


def test_read_errors(spark, paths, tmp_path):
    cases = [
        (lambda: st.read_mbtiles(spark, f"{tmp_path}/none.mbtiles"), "Failed to open"),
        (lambda: st.read_pmtiles(spark, paths["mbtiles", 1]), "does not start like"),
        (lambda: st.read_mbtiles(spark, paths["mbtiles", 1], nonsense=1), 'Invalid named parameter "nonsense" for function read_mbtiles'),
        (lambda: st.read_mbtiles(spark, paths["mbtiles", 1], zoom=99), "ZOOM must be between 0 and 32"),
    ]
    for run, message in cases:
        with pytest.raises(AnalysisException, match=message):
            run()
    old = bytearray(open(paths["pmtiles", 1], "rb").read())
    old[7] = 2
    (tmp_path / "old.pmtiles").write_bytes(old)
    with pytest.raises(AnalysisException, match="PMTiles version 2"):
        st.read_pmtiles(spark, f"{tmp_path}/old.pmtiles")
    old[7], old[98] = 3, 4
    (tmp_path / "zstd.pmtiles").write_bytes(old)
    with pytest.raises(Exception, match="zstd compression"):
        st.read_pmtiles(spark, f"{tmp_path}/zstd.pmtiles").count()


def test_empty_input(spark, wkb, tmp_path):
    none = spark.createDataFrame([(None, 1)], "geom binary, n int")
    with pytest.raises(TileBuildError, match="no features"):
        st.write_tileset(none, f"{tmp_path}/none.mbtiles")
    with pytest.raises(TileBuildError, match="no features"):
        st.write_tileset(spark.createDataFrame([], "lon double, lat double"), f"{tmp_path}/none.mbtiles")


def test_caps(spark, tmp_path):
    i = F.col("id")
    n = 42_000
    dense = spark.range(n).select((7 + (i % 200) * 0.0021).alias("lon"), (45 + (i % 211) * 0.0017).alias("lat"), F.md5(i.cast("string")).alias("code"))
    st.write_tileset(dense, f"{tmp_path}/dense.mbtiles", maxzoom=4)
    assert st.read_mbtiles(spark, f"{tmp_path}/dense.mbtiles").count() == n
    with pytest.raises(Exception, match="could not make tile"):
        st.write_tileset(dense, f"{tmp_path}/dense2.mbtiles", maxzoom=4, no_tile_size_limit=False, no_feature_limit=False)
    with pytest.raises(TileBuildError, match="could not make tile"):
        many = dense.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(5))))
        st.build(many, maxzoom=0, no_feature_limit=False)


def test_foreign_mbtiles(spark, tmp_path):
    """A plain file as others write it: no manifest, raw tiles, a view in place of a table, empty rows, holes in metadata."""
    path = f"{tmp_path}/foreign.mbtiles"
    db = sqlite3.connect(path)
    db.execute("CREATE TABLE metadata (name text, value text)")
    db.execute("CREATE TABLE blobs (z integer, x integer, y integer, d blob)")
    db.execute("CREATE VIEW tiles AS SELECT z AS zoom_level, x AS tile_column, y AS tile_row, d AS tile_data FROM blobs")
    layer = b"\x0a\x01a\x12\x0c\x12\x02\x00\x00\x18\x01\x22\x04\x09\x32\xb2\x01\x1a\x01k\x22\x02\x28\x07"
    tile = b"\x1a" + bytes([len(layer)]) + layer
    db.executemany(
        "INSERT INTO blobs VALUES (?, ?, ?, ?)",
        [(1, 0, 1, tile), (1, 1, 0, gzip.compress(tile)), (1, 1, 1, b""), (1, 0, 0, gzip.compress(b"")), (0, 0, 0, None)],
    )
    db.commit()
    db.close()
    assert st.read_mbtiles(spark, path).columns == FIXED
    rows = st.read_mbtiles(spark, path).collect()
    assert sorted((r.zoom, r.tile_x, r.tile_y, r.layer, r.feature_id) for r in rows) == [(1, 0, 0, "a", None), (1, 1, 1, "a", None)]
    assert st.read_mbtiles_tiles(spark, path).count() == 2
    (value,) = st.decode_tiles(st.read_mbtiles_tiles(spark, path), [("K", "double")]).select("K").distinct().collect()
    assert value.K == 7.0


def test_attribute_schema():
    text = (
        '{"vector_layers":[{"fields":{"A":"Number","b":"boolean","c":"String"}},{"fields":{"a":"String","B":"BOOLEAN","d":5}},'
        '{"id":"x"}]}'
    )
    assert parse_attributes([text]) == [("A", "string"), ("b", "boolean"), ("c", "string"), ("d", "string")]
    assert parse_attributes(["", "not json", '{"vector_layers": 3}', "[]"]) == []
    assert output_schema([("zoom", "double"), ("attr_zoom", "string")]).names[6:] == ["attr_zoom", "attr_attr_zoom"]


def test_value_casts():
    assert [cast_value(v, "string", True) for v in (1, 10.0, 1e16, True, "x")] == ["1", "10.0", "1e16", "true", "x"]
    assert [cast_value(v, "boolean", True) for v in ("TRUE", 0, 2.5)] == [True, False, True]
    assert cast_value("abc", "double", False) is None
    with pytest.raises(ValueError, match="Could not convert"):
        cast_value("abc", "double", True)


def test_varints():
    values = np.array([0, 1, 127, 128, 300, 2**32, 2**63, 2**64 - 1], np.uint64)
    got, ends = read_varints(Ragged.varints(values).data)
    assert (got == values).all() and ends[-1] == len(Ragged.varints(values).data)
    for bad in (b"\x80", b"\xff" * 11 + b"\x01"):
        with pytest.raises(ValueError, match="broken tile"):
            read_varints(np.frombuffer(bad, np.uint8))


def test_hilbert():
    zoom = np.array([0, 1, 1, 1, 1, 2, 20, 31])
    x = np.array([0, 0, 0, 1, 1, 3, 12345, 2**31 - 1])
    y = np.array([0, 0, 1, 1, 0, 0, 54321, 0])
    ids = hilbert_ids(zoom, x, y)
    assert ids[:6].tolist() == [0, 1, 2, 3, 4, 20]
    assert [c.tolist() for c in hilbert_tiles(ids)] == [zoom.tolist(), x.tolist(), y.tolist()]
    with pytest.raises(ValueError, match="out of range"):
        hilbert_ids(np.array([32]), np.array([0]), np.array([0]))


def test_directories():
    e = np.array([[5, 0, 10, 1], [6, 10, 4, 3], [20, 0, 10, 1], [21, 10, 4, 1]], np.int64)
    assert (read_directory(gzip.decompress(write_directory(e))) == e).all()
    with pytest.raises(ValueError, match="implausible"):
        read_directory(b"\x7f\x01")
    with pytest.raises(ValueError, match="no offset"):
        read_directory(bytes([1, 5, 1, 10, 0]))


def test_leaf_directories_and_runs(spark, tmp_path):
    """Enough scattered tiles for leaf directories, and runs of one payload."""
    z = 9
    tiles = spark.range(4**z).select(
        F.lit(z).alias("zoom"),
        (F.col("id") % 512).cast("int").alias("tile_x"),
        F.expr("cast(id div 512 as int)").alias("tile_y"),
        F.when(F.col("id") % 512 < 256, F.lit("left")).otherwise(F.col("id").cast("string")).cast("binary").alias("tile_data"),
    )
    path = f"{tmp_path}/big.pmtiles"
    st.write_container(tiles.filter("id % 7 <> 0" if "id" in tiles.columns else "tile_x % 7 <> 0"), path, single=True)
    back = st.read_pmtiles_tiles(spark, path)
    assert st.tileset_diff(back, tiles.filter("tile_x % 7 <> 0")).count() == 0
    assert back.filter("zoom = 9 and tile_x = 300 and tile_y between 3 and 9").count() == 7
    assert back.rdd.getNumPartitions() >= 1


def test_malformed_tiles():
    ok = b"\x1a\x02\x0a\x00"
    for bad, message in (
        (ok[:-1], "ends inside"),
        (b"\x1a\x03\x0a\x05\x00", "ends inside"),
        (b"\x1a\x04\x12\x02\x08\x80", "ends inside"),
        (b"\x1b\x00", "no field has wire type 3"),
        (b"\x1a\x08\x0a\x00\x12\x04\x12\x02\x00\x00", "behind the end of its layer"),
        (b"\x1a\x0a\x0a\x00\x12\x06\x18\x01\x22\x02\x0b\x00", "no geometry command"),
        (b"\x1a\x08\x12\x06\x18\x01\x22\x02\x11\x00", "inside a command"),
        (b"\x1a\x0d\x28" + b"\xff" * 11 + b"\x01", "more than ten bytes"),
    ):
        with pytest.raises(ValueError, match=message):
            list(decode_rows(iter([(0, 0, 0, bad)]), [], None))


def test_polygon_with_hole_is_one_polygon(spark, wkb):
    """Winding is judged on the tile grid, so a hole stays a hole and two exteriors stay two."""
    holed = wkb.polygon(wkb.square(10, 10, 4), wkb.square(10, 10, 2))
    pair = wkb.multi(6, wkb.polygon(wkb.square(-20, 0, 3)), wkb.polygon(wkb.square(-30, 0, 3), wkb.square(-30, 0, 1)))
    df = spark.createDataFrame([(1, holed), (2, pair)], "fid int, geom binary")
    from sparktiles.functions.wkb import from_wkb

    out = {r.feature_id: from_wkb(bytes(r.geom)) for r in st.decode_tiles(st.build_tiles(df, id_column="fid", maxzoom=0), []).collect()}
    assert out[1].code == 3 and [len(r) for r in out[1].coords] == [5, 5]
    assert out[2].code == 6 and sorted(len(p) for p in out[2].coords) == [1, 2]


def test_encode_decode_random_shapes():
    """Seeded random integer geometries survive encode and decode unchanged."""
    rng = np.random.default_rng(7)
    parts, gtype = [], []
    for _ in range(300):
        kind = int(rng.integers(1, 4))
        n = int(rng.integers(1, 4))
        size = 1 if kind == 1 else int(rng.integers(kind, 9))
        rings = []
        for _ in range(n):
            xy = rng.integers(-80, 4176, (size, 2))
            if kind == 3:
                xy = np.array([[0, 0], [9, 0], [9, 9]]) + rng.integers(0, 4000, 2)
            rings.append(xy)
        parts.append(rings)
        gtype.append(kind)
    nested = pa.array([[r.reshape(-1).tolist() for r in p] for p in parts], pa.list_(pa.list_(pa.int32())))
    ints, bounds = tileread.whole_varints(mvt.geometry_bytes(np.array(gtype), nested))
    got = tileread.read_parts(ints, bounds)
    flat = [(i, r) for i, rings in enumerate(parts) for r in rings]
    assert got.feature.tolist() == [i for i, _ in flat] and got.sizes.tolist() == [len(r) for _, r in flat]
    assert (got.xy == np.concatenate([r for _, r in flat])).all()


def test_large_ids_raise():
    fid = Ragged.varints(np.array([2**63], np.uint64)).data.tobytes()
    body = b"\x08" + fid + b"\x18\x01\x22\x03\x09\x00\x00"
    layer = b"\x0a\x01a\x12" + bytes([len(body)]) + body
    with pytest.raises(ValueError, match="does not fit"):
        list(decode_rows(iter([(0, 0, 0, b"\x1a" + bytes([len(layer)]) + layer)]), [], None))


def test_one_registration_is_enough_where_workers_lack_the_package(paths, tmp_path):
    """A session whose Python path does not name the repository: the formats must come with what was shipped."""
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(st.__file__)))
    script = tmp_path / "read.py"
    script.write_text(
        f"""
import sys
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
sys.path.insert(0, {root!r})
import sparktiles as st
st.register(spark)
print("rows", spark.read.format("mbtiles").load({paths["mbtiles", None]!r}).count())
"""
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "rows" in done.stdout, done.stderr[-2000:]


@pytest.fixture(scope="module")
def wide_sets(spark, tmp_path_factory):
    """Many tiles of several zooms in small shards and zones."""
    root = tmp_path_factory.mktemp("wide")
    i = F.col("id")
    tiles = spark.range(64 * 64).select(
        F.lit(6).alias("zoom"), (i % 64).cast("int").alias("tile_x"), F.floor(i / 64).cast("int").alias("tile_y"),
        F.concat(F.lit("tile "), F.floor(i / 3)).cast("binary").alias("tile_data"),
    )
    tiles = tiles.unionByName(tiles.filter("tile_x < 8 AND tile_y < 8").withColumn("zoom", F.lit(3)))
    out = {}
    for fmt in ("mbtiles", "pmtiles"):
        out[fmt] = f"{root}/wide.{fmt}"
        st.write_container(tiles, out[fmt])
    return tiles, out


@pytest.mark.parametrize("fmt", ["mbtiles", "pmtiles"])
def test_planning_reads_the_manifest_alone(spark, wide_sets, fmt, monkeypatch):
    from sparktiles.sources import common, mbtiles, pmtiles

    tiles, paths = wide_sets
    read = st.read_mbtiles_tiles if fmt == "mbtiles" else st.read_pmtiles_tiles
    assert read(spark, paths[fmt]).exceptAll(tiles).count() == 0 and read(spark, paths[fmt]).count() == tiles.count()
    chosen = "zoom = 6 AND tile_x BETWEEN 3 AND 5 AND tile_y >= 60"
    got, want = read(spark, paths[fmt]).filter(chosen), tiles.filter(chosen)
    assert want.exceptAll(got).count() == 0 and got.count() == want.count() == 12
    # What the driver does to plan, without opening a shard.
    for module, name in ((mbtiles, "connect"), (pmtiles, "Archive")):
        monkeypatch.setattr(module, name, lambda *a: pytest.fail("a shard was opened"))
    source = (mbtiles.MBTilesSource if fmt == "mbtiles" else pmtiles.PMTilesSource)({"path": paths[fmt], "rows": "tiles"})
    from pyspark.sql.datasource import EqualTo, GreaterThanOrEqual

    def partitions(*filters):
        reader = source.reader(source.schema())
        list(reader.pushFilters(list(filters)))
        return reader.partitions()

    every = partitions()
    assert len(partitions(EqualTo(("zoom",), 3))) < len(every)
    few = partitions(EqualTo(("zoom",), 6), EqualTo(("tile_x",), 4), GreaterThanOrEqual(("tile_y",), 60))
    assert 0 < len(few) < len(every) and partitions(EqualTo(("tile_x",), 64)) == []
    assert common.MANIFEST in os.listdir(paths[fmt])


def test_shards_have_zones_of_bounded_size(monkeypatch, tmp_path):
    """One task's shard cut into zones: they cover its tiles once, in curve order, each within one zoom."""
    from sparktiles.sources import common, mbtiles

    monkeypatch.setattr(common, "ZONE_TILES", 10)
    source = mbtiles.MBTilesSource({"path": f"{tmp_path}/a.mbtiles"})
    writer = source.writer(common.TILE_STRUCT, True)
    rows = [(z, x, y, b"t" * (x + 1)) for z in (2, 3) for x in range(4) for y in range(4)]
    zones = writer._close(rows[::-1], "part-0.mbtiles")
    assert [z["tiles"] for z in zones] == [10, 6, 10, 6] and [z["first"] for z in zones] == [0, 10, 16, 26]
    assert all(a["high"] < b["low"] for a, b in zip(zones, zones[1:])) and [z["zoom"] for z in zones] == [2, 2, 3, 3]
    assert sum(z["bytes"] for z in zones) == sum(len(r[3]) for r in rows)


def test_a_driver_lost_before_the_pointer_leaves_the_old_set(spark, wkb, tmp_path):
    """All shards written, the commit never run, as when the driver goes; then a whole write."""
    from pyspark.sql.datasource import WriterCommitMessage

    from sparktiles.sources import common, pmtiles

    path = f"{tmp_path}/lost.pmtiles"
    st.write_tileset(spark.createDataFrame([(wkb.point(1, 1), "old")], "geom binary, v string"), path, maxzoom=0)
    writer = pmtiles.PMTilesSource({"path": path}).writer(common.TILE_STRUCT, True)
    message = writer.write(iter([pa.record_batch([pa.array([0], pa.int32())] * 3 + [pa.array([b"x"])], ["zoom", "tile_x", "tile_y", "tile_data"])]))
    assert isinstance(message, WriterCommitMessage) and len([f for f in os.listdir(path) if f.startswith("data-")]) == 2
    assert [r.v for r in st.read_pmtiles(spark, path).collect()] == ["old"]
    st.write_tileset(spark.createDataFrame([(wkb.point(1, 1), "new")], "geom binary, v string"), path, maxzoom=0)
    assert [r.v for r in st.read_pmtiles(spark, path).collect()] == ["new"]
    assert len([f for f in os.listdir(path) if f.startswith("data-")]) == 1


def test_a_table_of_features_is_no_table_of_tiles(spark, places, tmp_path):
    with pytest.raises(Exception, match="write_tileset builds tiles"):
        places.write.format("mbtiles").mode("overwrite").save(f"{tmp_path}/x.mbtiles")
