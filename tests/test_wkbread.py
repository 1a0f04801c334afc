"""Columns of WKB against the tree reader, row by row."""

from __future__ import annotations

import random
import struct

import numpy as np
import pyarrow as pa
import pytest

from sparktiles.functions import wkb, wkbread


def random_blob(draw: random.Random, code: int | None = None, depth: int = 0) -> bytes:
    """Either byte order, ISO or extended codes, with and without Z, M and SRID."""
    code = code or draw.randrange(1, 8 if depth < 2 else 7)
    mark = draw.choice("<>")
    z, m, srid, iso = draw.random() < 0.3, draw.random() < 0.2, draw.random() < 0.2, draw.random() < 0.5
    raw = code + (1000 * (z + 2 * m) if iso else (wkb.HAS_Z if z else 0) | (wkb.HAS_M if m else 0)) | (wkb.HAS_SRID if srid else 0)
    head = struct.pack(mark + "BI", mark == "<", raw) + (struct.pack(mark + "I", 4326) if srid else b"")
    width = 2 + z + m
    vertex = lambda: struct.pack(f"{mark}{width}d", *(draw.choice([draw.uniform(-180, 180), 0.0]) for _ in range(width)))
    path = lambda n: struct.pack(mark + "I", n) + b"".join(vertex() for _ in range(n))
    n = draw.choice([0, 1, 2, 2, 3, 7])
    if code == 1:
        return head + (vertex() if draw.random() < 0.8 else struct.pack(f"{mark}{width}d", *[float("nan")] * width))
    if code == 2:
        return head + path(n)
    if code == 3:
        return head + struct.pack(mark + "I", n) + b"".join(path(draw.randrange(0, 6)) for _ in range(n))
    inner = [random_blob(draw, code - 3 if code < 7 else None, depth + 1) for _ in range(n)]
    return head + struct.pack(mark + "I", n) + b"".join(inner)


def broken(draw: random.Random, blob: bytes) -> bytes:
    how = draw.randrange(4)
    if how == 0:
        return blob[: draw.randrange(len(blob))]
    cut = bytearray(blob)
    if how == 1:
        cut[draw.randrange(min(9, len(cut)))] = draw.randrange(256)
    elif how == 2:
        cut[draw.randrange(len(cut))] ^= 0xFF
    return bytes(cut) if how < 3 else blob + b"rest"


def tree(blob: bytes | None):
    try:
        return None if blob is None else wkb.from_wkb(blob)
    except wkb.GeometryError as e:
        return str(e)


@pytest.mark.parametrize("seed", range(8))
def test_rings_and_headers_equal_the_trees(seed):
    draw = random.Random(seed)
    blobs: list[bytes | None] = [random_blob(draw) for _ in range(300)]
    if seed % 2:
        blobs = [broken(draw, b) if draw.random() < 0.5 else b for b in blobs]
    blobs = [None if draw.random() < 0.05 else b for b in blobs] + [b""]
    trees = [tree(b) for b in blobs]
    column = pa.array([b"before", *blobs], pa.binary()).slice(1)
    headers, rings = wkbread.read_wkb(column)
    for i, t in enumerate(trees):
        if t is None:
            assert headers.code[i] == 0 and not headers.odd[i]
        elif isinstance(t, str) or t.code == 7:
            assert headers.odd[i] and headers.code[i] == 0
        else:
            assert not headers.odd[i]
            assert (headers.code[i], headers.has_z[i], headers.empty[i]) == (t.code, t.has_z, t.empty), i
    good = [i for i, t in enumerate(trees) if t is not None and not isinstance(t, str)]
    kept = pa.record_batch([pa.array([b if i in set(good) else None for i, b in enumerate(blobs)], pa.binary())], ["geom"])
    got, want = wkbread.read_geometries(kept), wkbread.rings_of_trees(good, [trees[i] for i in good])
    for name in ("row", "member", "gtype", "poly", "hole", "size"):
        assert getattr(got, name).tolist() == getattr(want, name).tolist(), name
    assert np.array_equal(got.xy, want.xy, equal_nan=True)
    bad = next((t for t in trees if isinstance(t, str)), None)
    if bad:
        with pytest.raises(wkb.GeometryError) as seen:
            wkbread.read_geometries(pa.record_batch([pa.array(blobs, pa.binary())], ["geom"]))
        assert str(seen.value) == bad


def test_no_rows_and_skipped_rows():
    assert len(wkbread.read_geometries(pa.record_batch([pa.array([], pa.binary())], ["geom"]))) == 0
    draw = random.Random(4)
    blobs = [random_blob(draw, 2) for _ in range(9)]
    b = pa.record_batch([pa.array(blobs, pa.binary())], ["geom"])
    every, some = wkbread.read_geometries(b), wkbread.read_geometries(b, np.array([0, 4]))
    assert set(some.row.tolist()) == set(every.row.tolist()) - {0, 4}
