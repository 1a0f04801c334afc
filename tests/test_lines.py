from __future__ import annotations

import numpy as np
import pytest

from sparktiles.functions import lines as ln
from sparktiles.functions import shapes as sh
from sparktiles.functions.ragged import offsets_of
from sparktiles.operators.shapes import tile_shapes


def drawn(rng, n):
    """Lines anywhere and on tile edges, several to a piece, in world units."""
    sizes = rng.integers(2, 12, n)
    xy = rng.uniform(0, 2**32, (sizes.sum(), 2)).round()
    edges = rng.random(xy.shape) < 0.3
    xy[edges] = rng.integers(0, 17, edges.sum()) * 2.0**28
    return sh.Shapes(xy, offsets_of(sizes), np.sort(rng.permutation(np.r_[np.arange(n // 2), rng.integers(0, n // 2, n - n // 2)])), np.full(n, 2), np.zeros(n, int), np.zeros(n, bool))


@pytest.mark.parametrize("buffer", [0, 5, 100])
def test_segments_against_rings(buffer):
    rng = np.random.default_rng(13)
    rings = drawn(rng, 80)
    segments = ln.segments_of(rings)
    tx = ty = np.zeros(40, int)
    for zoom in range(1, 7):
        rings, a, tx2, ty2 = sh.split(rings, zoom, tx, ty, buffer)
        segments, b, *tiles = ln.split(segments, zoom, tx, ty, buffer)
        tx, ty = tx2, ty2
        assert (a == b).all() and (tx == tiles[0]).all() and (ty == tiles[1]).all()
        back = segments.shapes()
        for field in ("xy", "off", "piece", "kind", "poly", "hole"):
            assert np.array_equal(getattr(back, field), getattr(rings, field)), (zoom, field)
        want = sh.quantise(rings, zoom, tx, ty)
        xy, off, piece = ln.quantise(segments, zoom, tx, ty)
        assert np.array_equal(xy, want.xy) and np.array_equal(off, want.off) and np.array_equal(piece, want.piece)


def test_passes_hold_whole_pieces():
    segments = ln.segments_of(drawn(np.random.default_rng(3), 60))
    number = np.arange(30)
    parts = list(ln.regroup(segments, [number], 40))
    assert len(parts) > 3 and np.array_equal(np.concatenate([c[0] for _, c in parts]), number)
    assert np.array_equal(np.concatenate([c[0][g.piece] for g, c in parts]), segments.piece)


def moved(df):
    """Rows that the plan of a collected table wrote to its shuffles."""

    def walk(node):
        if node.nodeName() == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if "QueryStage" in node.nodeName():
            return walk(node.plan())
        metric = node.metrics().get("shuffleRecordsWritten")
        below = node.children()
        return (metric.get().value() if metric.isDefined() else 0) + sum(walk(below.apply(i)) for i in range(below.size()))

    return walk(df._jdf.queryExecution().executedPlan())


def test_pieces_of_light_shapes_are_not_moved(spark, wkb):
    rng = np.random.default_rng(5)
    rows = [(i, wkb.line(np.stack([rng.uniform(-180, 180, 9), rng.uniform(-85, 85, 9)], axis=1))) for i in range(50)]
    rows += [(50, wkb.polygon(wkb.square(10, 10, 30)))]
    cut = tile_shapes(spark.createDataFrame(rows, "fid int, geom binary"), 0, 6, buffer=0, simplification=0.0)
    assert len(cut.collect()) > 10_000
    assert moved(cut) == len(rows)


@pytest.mark.parametrize("minzoom", [0, 4])
def test_heavy_shapes_give_the_same_tiles(spark, wkb, minzoom):
    rng = np.random.default_rng(6)
    zigzag = np.stack([rng.uniform(-200, 200, 20), rng.uniform(-88, 88, 20)], axis=1)
    rows = [
        (1, wkb.line(zigzag)),
        (2, wkb.polygon(wkb.square(0, 0, 60), wkb.square(0, 0, 20))),
        (3, wkb.point(3, 4)),
        (4, wkb.multi(7, wkb.line(zigzag[:5]), wkb.point(5, 6), wkb.polygon(wkb.square(178, 0, 6)))),
        (5, wkb.multi(5, wkb.line(zigzag[3:9]), wkb.line(zigzag[9:15]))),
        (6, None),
        (1, wkb.line(zigzag)),
    ]
    df = spark.createDataFrame(rows, "fid int, geom binary")

    def tiles(heavy, encoded):
        cut = tile_shapes(df, minzoom, 5, buffer=5, simplification=1.0, split_zoom=2, encoded=encoded, heavy=heavy)
        out = sorted(map(repr, cut.collect()))
        return out, moved(cut)

    for encoded in (False, True):
        (light, few), (dealt, more) = tiles(10**9, encoded), tiles(0, encoded)
        assert light == dealt and few == 6 and more > 20
