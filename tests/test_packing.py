"""Crowded tiles: packed rows on their way to the encoders, tiles that go on in stretches."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import sparktiles as st
from sparktiles.functions import mvt, tileread
from sparktiles.operators import encode, packing
from sparktiles.operators.decode import decode_rows, decode_tiles, joined_stretches
from sparktiles.operators.encode import encode_tiles
from sparktiles.plans import build as st_build

TILE = ["zoom", "tile_x", "tile_y"]
KINDS = [("name", "string"), ("v", "double")]


def rows_of(spark, n: int = 3000):
    """One crowded tile with two layers, and small ones; ids and values repeat or are null."""
    rows = spark.range(n).selectExpr(
        "1 as zoom", "if(id % 10 < 8, 0, cast(id % 2 as int)) as tile_x", "if(id % 10 < 8, 0, 1) as tile_y",
        "if(id % 3 = 0, 'a', 'b') as layer", "if(id % 17 = 0, null, id div 2) as fid", "1 as gtype", "cast(id * 7 % 4096 as int) as px",
        "cast(id * 13 % 4096 as int) as py", "if(id % 5 = 0, null, concat('n', id % 700)) as name", "if(id % 7 = 0, null, cast(id as double)) as v",
    )
    return rows.withColumn("rid", F.monotonically_increasing_id()).withColumn("props", F.struct("name", "v")).drop("name", "v")


def key(r) -> tuple:
    return tuple(str(r[c]) for c in (*TILE, "layer", "feature_id", "geom", "name", "v"))


def test_rows_and_pieces_are_shuffled_packed(spark):
    """The shuffles before and after the encoding of crowded tiles hold packed values, not rows with their properties."""
    tiles = encode_tiles(rows_of(spark), piece_rows=100, key="rid")
    plan = tiles._jdf.queryExecution().optimizedPlan()
    moved, left = [], [plan]
    while left:
        node = left.pop()
        if node.nodeName().startswith("Repartition"):
            moved.append(node.schema().simpleString())
        left += [node.children().apply(i) for i in range(node.children().size())]
    assert len(moved) == 2 and not any("props" in m for m in moved)
    whole = encode_tiles(rows_of(spark), key="rid")
    got, plain = (sorted(map(key, decode_tiles(t, KINDS).collect())) for t in (tiles, whole))
    assert got == plain and len(got) == 3000


def test_packed_rows_come_back(spark):
    wide = rows_of(spark).selectExpr(
        "*", "array(array(px, py), array(py)) as parts", "map(layer, fid) as m", "timestamp'2020-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, px) as t",
        "cast(py as decimal(20, 2)) as d", "px % 2 = 0 as flag", "cast(if(px % 3 = 0, null, layer) as binary) as raw",
    )
    order = [*TILE, "layer", "fid", "rid"]
    packed, schema = packing.by_bucket(wide, TILE, order, 3000, 3)
    out = packed.mapInArrow(lambda b: packing.unpacked_rows(b, schema, TILE, order), wide.schema)
    assert sorted(map(str, out.collect())) == sorted(map(str, wide.collect()))
    # A bucket is whole and in order, and rows of one key are together.
    buckets = out.withColumn("p", F.spark_partition_id()).groupBy(*TILE).agg(F.count_distinct("p").alias("n")).collect()
    assert all(r.n == 1 for r in buckets)
    assert packed.agg(F.sum(F.octet_length("rows"))).first()[0] < packed.agg(F.sum("size")).first()[0] / 2


def test_wide_buckets_are_taken_apart_by_key(monkeypatch):
    draw = random.Random(5)
    schema = pa.schema([*((k, pa.int32()) for k in TILE), ("fid", pa.int64()), ("text", pa.string())])
    rows = [(1, draw.randrange(2), draw.randrange(2), draw.choice([None, *range(9)]), f"t{i}") for i in range(300)]
    parts = [pa.record_batch(list(map(list, zip(*rows[a : a + 70], strict=True))), schema=schema) for a in range(0, 300, 70)]
    raw = [p.serialize() for p in parts]
    columns = [pa.array([0] * len(raw), pa.int32())] * 2 + [pa.array([r.size for r in raw]), pa.array([False] * len(raw))]
    packed = pa.record_batch([*columns, pa.array([r.to_pybytes() for r in raw], pa.binary())], names=packing.PACKED_ARROW.names)
    order = [*TILE, "fid"]
    made = lambda: [b.to_pylist() for b in packing.unpacked_rows(iter([packed]), schema, TILE, order)]
    (plain,) = made()
    monkeypatch.setattr(packing, "WIDE_BYTES", 0)
    apart = made()
    assert len(apart) == 4 and sum(apart, []) == plain
    place = lambda r: (r["tile_x"], r["tile_y"], -1 if r["fid"] is None else r["fid"])
    assert [place(r) for r in plain] == sorted(map(place, plain)) and {r["text"] for r in plain} == {r[4] for r in rows}


def parts_of(draw: random.Random, n: int = 4000, pieces: int = 7) -> list[pa.RecordBatch]:
    """What the joining task gets of one tile."""
    piece = sorted(draw.choice([0, 1, 1, 2, 2, 2, 5]) for _ in range(n))  # pieces of many sizes, some empty
    same = lambda v, t: pa.array([v] * n, t)
    props = pa.StructArray.from_arrays([pa.array([f"n{draw.randrange(900)}" for _ in range(n)]), pa.array([draw.random() for _ in range(n)])], ["name", "v"])
    place = [pa.array([draw.randrange(4096) for _ in range(n)], pa.int32()) for _ in range(2)]
    columns = [same(2, pa.int32()), same(1, pa.int32()), same(3, pa.int32()), same("a", pa.string()), pa.array(range(n)), same(1, pa.int32()), props, *place]
    batch = pa.record_batch([*columns, pa.array(piece), same(pieces, pa.int64())], names=[*TILE, "layer", "fid", "gtype", "props", "px", "py", "piece", "pieces"])
    table = pa.Table.from_batches(list(encode._encode_pieces(["name", "v"], 6)(iter([batch]))))
    return table.sort_by([(k, "ascending") for k in (*TILE, "layer", "section", "block", "piece")]).combine_chunks().to_batches(max_chunksize=3)


@pytest.mark.parametrize("values", [1, 500, 2_000_000])
def test_tiles_go_on_in_stretches(monkeypatch, values):
    """No row of a crowded tile is longer than a stretch, and no more values are held than a block has; decoded are all features."""
    monkeypatch.setattr(encode, "JOINED_VALUES", values)
    monkeypatch.setattr(encode, "STRETCH_BYTES", 1000)
    parts = parts_of(random.Random(3))
    # A finished tile before and one behind, in batches that the crowded one shares.
    other = lambda x: encode._filled({"zoom": pa.array([2]), "tile_x": pa.array([x]), "tile_y": pa.array([0]), "tile_data": pa.array([b"x"])})
    parts = pa.Table.from_batches([other(0), *parts, other(2)]).combine_chunks().to_batches(max_chunksize=4)
    before, tile, behind = encode._join_pieces(["name", "v"], 6, False)(iter(parts))
    made = list(encode._join_pieces(["name", "v"], 6, True)(iter(parts)))
    rows = [(r["zoom"], r["tile_x"], r["tile_y"], r["_stretch"], r["tile_data"]) for b in made for r in b.to_pylist()]
    assert rows[0] == (2, 0, 0, 0, b"x") and rows[-1] == (2, 2, 0, 0, b"x")
    assert before.to_pylist()[0]["tile_x"] == 0 and behind.to_pylist()[0]["tile_x"] == 2
    rows = rows[1:-1]
    assert [r[:4] for r in rows] == [(2, 1, 3, i) for i in range(len(rows))] and len(rows) > 20
    assert max(len(r[4]) for r in rows) <= 1000
    whole = tile.column("tile_data")[0].as_py()
    assert b"".join(r[4] for r in rows) == whole
    stretches = lambda: joined_stretches((r[:3], r[3], pa.py_buffer(r[4])) for r in rows)
    assert [type(t[3]) for t in stretches()] == [tileread.Spool]
    got, plain = ([r for b in decode_rows(t, KINDS, "a") for r in b.to_pylist()] for t in (stretches(), iter([(2, 1, 3, mvt.gunzip_tile(whole))])))
    assert got == plain and sorted(r["feature_id"] for r in got) == list(range(4000))
    with pytest.raises(ValueError, match="does not stand behind"):
        list(joined_stretches((r[:3], r[3], pa.py_buffer(r[4])) for r in (rows[0], rows[2])))


def test_stretches_and_whole_tiles_hold_the_same(spark):
    rows = rows_of(spark)
    for piece_rows in (100, 100_000):
        cut = encode_tiles(rows, piece_rows=piece_rows, key="rid", stretches=True)
        assert cut.columns == [*TILE, "_stretch", "tile_data"]
        assert sorted(map(key, decode_tiles(cut, KINDS).collect())) == sorted(map(key, decode_tiles(encode_tiles(rows, key="rid"), KINDS).collect()))


def test_values_of_large_layers_lie_in_files():
    files, draw = tileread.ValueFiles(), random.Random(2)
    every = []
    for n in (3, 0, 50):
        kind = np.array([draw.choice([tileread.STRING, tileread.DOUBLE]) for _ in range(n)], np.int8)
        text = [f"t{draw.randrange(99)}" if k == tileread.STRING else "" for k in kind]
        number = np.where(kind == tileread.STRING, 0, np.arange(n)).astype(np.uint64)
        files.add(tileread.Values(kind, number, pa.array(text, pa.string())))
        every += list(zip(kind.tolist(), number.tolist(), text, strict=True))
    got = files.values()
    assert isinstance(got.kind, np.memmap) and isinstance(got.number, np.memmap)
    assert list(zip(got.kind.tolist(), got.number.tolist(), got.raw.to_pylist(), strict=True)) == every
    assert len(tileread.ValueFiles().values().kind) == 0


@pytest.mark.parametrize("fmt", ["mbtiles", "pmtiles"])
def test_containers_take_large_tiles_in_stretches(spark, tmp_path, monkeypatch, fmt):
    """A crowded tile of over a stretch reaches the container as rows of 1 MB and is stored whole; the table of the build has it as one value."""
    n = 130_000
    # Positions and values that do not pack, so that the tile of zoom 0 is of several stretches.
    points = spark.range(n).selectExpr("id", "pmod(hash(id), 3600000) / 10000 - 180 as lon", "pmod(hash(id, 1), 1600000) / 10000 - 80 as lat", "cast(hash(id, 2) as double) as v")
    seen = []
    written = st_build.write_container
    monkeypatch.setattr(st_build, "write_container", lambda tiles, *a, **k: (seen.append(tiles), written(tiles, *a, **k)))
    path = f"{tmp_path}/many.{fmt}"
    made = st.write_tileset(points, path, layer="p", id_column="id", minzoom=0, maxzoom=1, buffer=0)
    rows = seen[0].select(*TILE, "_stretch", F.octet_length("tile_data").alias("n")).collect()
    assert max(r.n for r in rows) <= 1 << 20 and max(r["_stretch"] for r in rows) > 0
    sizes = {(*r[:3], hashlib.sha256(mvt.gunzip_tile(bytes(r.tile_data))).hexdigest()) for r in made.tiles.collect()}
    assert len(sizes) == 5 and made.tiles.columns == [*TILE, "tile_data"]
    read = st.read_mbtiles_tiles if fmt == "mbtiles" else st.read_pmtiles_tiles
    assert {tuple(r) for r in read(spark, path).select(*TILE, F.sha2("tile_data", 256)).collect()} == sizes
    low = st.read_tileset(spark, path, zoom=0)
    assert low.agg(F.count("*"), F.count_distinct("feature_id"), F.sum("v")).first() == points.agg(F.count("*"), F.count_distinct("id"), F.sum("v")).first()
