"""Web-mercator arithmetic as Catalyst columns.

World coordinates are integers on the 2^32 grid. Every function here is built-in expressions only, so a projection stays
inside whole-stage codegen; the one exception is the Hilbert curve, a vectorised pandas UDF.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WORLD_BITS = 32
WORLD = 1 << WORLD_BITS
EXTENT = 4096
EXTENT_BITS = 12
MAX_ZOOM = 24

# The clamps of the forward projection.
LAT_LIMIT = 89.9
LON_LIMIT = 360.0
BAD_LAT = 89.9
BAD_LON = 720.0


def _finite(c: Column) -> Column:
    return ~(F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))


def _round_half_away(c: Column) -> Column:
    # floor-based: Spark's round() on a double goes through BigDecimal.
    return F.when(c >= 0, F.floor(c + 0.5)).otherwise(-F.floor(F.lit(0.5) - c))


def world_x(lon: Column) -> Column:
    """Unwrapped world x. NULL stays NULL; a non-finite longitude maps to a fixed far value."""
    clamped = F.greatest(F.lit(-LON_LIMIT), F.least(F.lit(LON_LIMIT), lon))
    safe = F.when(_finite(lon), clamped).otherwise(F.when(lon.isNotNull(), F.lit(BAD_LON)))
    return _round_half_away(F.lit(float(WORLD)) * ((safe + 180) / 360))


def world_y(lat: Column) -> Column:
    clamped = F.greatest(F.lit(-LAT_LIMIT), F.least(F.lit(LAT_LIMIT), lat))
    safe = F.when(_finite(lat), clamped).otherwise(F.when(lat.isNotNull(), F.lit(BAD_LAT)))
    phi = safe * math.pi / 180
    return _round_half_away(F.lit(float(WORLD)) * (1 - F.log(F.tan(phi) + 1 / F.cos(phi)) / math.pi) / 2)


def wrap_x(wx: Column) -> Column:
    return wx.bitwiseAND(F.lit(WORLD - 1))


def clamp_y(wy: Column) -> Column:
    return F.greatest(F.lit(0).cast("long"), F.least(F.lit(WORLD - 1), wy))


def project_world(df: DataFrame, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """FEA-9: add `wx`, `wy` on the world grid, wrapped and clamped into it."""
    lon_c, lat_c = F.col(lon).cast("double"), F.col(lat).cast("double")
    return df.withColumns({"wx": wrap_x(world_x(lon_c)), "wy": clamp_y(world_y(lat_c))})


def shift_right(c: Column, n: Column | int) -> Column:
    if isinstance(n, int):
        return F.shiftright(c, n)
    return F.call_function("shiftright", c, n.cast("int"))


def shift_left(c: Column, n: Column | int) -> Column:
    if isinstance(n, int):
        return F.shiftleft(c, n)
    return F.call_function("shiftleft", c, n.cast("int"))


def tile_of(w: Column, zoom: Column) -> Column:
    """TIL-2: tile number of a world coordinate."""
    return shift_right(w, F.lit(WORLD_BITS) - zoom).cast("int")


def quantize(w: Column, tile: Column, zoom: Column) -> Column:
    """TIL-7: tile-local grid position; arithmetic shifts floor correctly left of the tile."""
    local = w - shift_left(tile.cast("long"), F.lit(WORLD_BITS) - zoom)
    bits = F.lit(WORLD_BITS - EXTENT_BITS) - zoom
    return F.when(bits >= 0, shift_right(local, bits)).otherwise(shift_left(local, -bits)).cast("int")


# Shift and mask of the five bit-interleave steps.
INTERLEAVE = (
    (16, 0x0000FFFF0000FFFF),
    (8, 0x00FF00FF00FF00FF),
    (4, 0x0F0F0F0F0F0F0F0F),
    (2, 0x3333333333333333),
    (1, 0x5555555555555555),
)


def with_morton(df: DataFrame, wx: str = "wx", wy: str = "wy", out: str = "morton") -> DataFrame:
    """60-bit curve key (x in the even bits); a tile of any zoom is one contiguous key range.

    One projection per step: a step uses its input twice, so a single expression would double with each of the five.
    """
    df = df.withColumns({"_ma": F.shiftright(wx, 2), "_mb": F.shiftright(wy, 2)})
    for shift, mask in INTERLEAVE:
        step = {c: F.shiftleft(c, shift).bitwiseOR(F.col(c)).bitwiseAND(F.lit(mask)) for c in ("_ma", "_mb")}
        df = df.withColumns(step)
    return df.withColumn(out, F.col("_ma").bitwiseOR(F.shiftleft("_mb", 1))).drop("_ma", "_mb")


def to_lonlat(
    df: DataFrame,
    px: str = "px",
    py: str = "py",
    zoom: str = "zoom",
    tile_x: str = "tile_x",
    tile_y: str = "tile_y",
    extent: int = EXTENT,
) -> DataFrame:
    """DEC-1: tile-local position back to degrees."""
    scale = F.pow(F.lit(2.0), F.col(zoom))
    lon = (F.col(tile_x) + F.col(px) / extent) / scale * 360 - 180
    n = F.lit(math.pi) * (1 - 2 * (F.col(tile_y) + F.col(py) / extent) / scale)
    return df.withColumns({"lon": lon, "lat": F.degrees(F.atan(F.sinh(n)))})


def flip_rows(df: DataFrame, zoom: str = "zoom", row: str = "tile_row", out: str = "tile_y") -> DataFrame:
    """DEC-9: bottom-up (TMS) row to top-down row, and back: the flip is its own inverse."""
    return df.withColumn(out, (shift_left(F.lit(1).cast("long"), F.col(zoom)) - 1 - F.col(row)).cast("int"))


# --- Hilbert tile ids (DEC-6) ------------------------------------------------------------------------------------------


def zoom_start(zoom: int) -> int:
    """First tile id of a zoom: all coarser zooms come before it."""
    return ((1 << (2 * zoom)) - 1) // 3


def hilbert_ids(zoom: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Tile ids of whole columns; the loop is over curve levels, never over rows."""
    zoom = np.asarray(zoom, dtype=np.int64)
    x, y = np.array(x, dtype=np.int64), np.array(y, dtype=np.int64)
    if len(zoom) and (zoom.min() < 0 or zoom.max() > 31):
        raise ValueError("tile id is out of range: zoom must be between 0 and 31")
    side = np.left_shift(np.int64(1), zoom)
    if ((x < 0) | (y < 0) | (x >= side) | (y >= side)).any():
        raise ValueError("tile id is out of range: tile outside its zoom")
    dist = np.zeros(len(zoom), dtype=np.int64)
    for level in range(int(zoom.max()) - 1 if len(zoom) else -1, -1, -1):
        live = level < zoom
        s = np.int64(1) << level
        rx, ry = (x >> level) & 1, (y >> level) & 1
        dist += np.where(live, s * s * ((3 * rx) ^ ry), 0)
        x, y = np.where(live, x & (s - 1), x), np.where(live, y & (s - 1), y)
        flip = live & (ry == 0) & (rx == 1)
        x, y = np.where(flip, s - 1 - x, x), np.where(flip, s - 1 - y, y)
        swap = live & (ry == 0)
        x, y = np.where(swap, y, x), np.where(swap, x, y)
    return (np.left_shift(np.int64(1), 2 * zoom) - 1) // 3 + dist


ZOOM_STARTS = np.array([zoom_start(z) for z in range(32)], dtype=np.int64)


def hilbert_tiles(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Inverse of `hilbert_ids`."""
    ids = np.asarray(ids, dtype=np.int64)
    if len(ids) and ids.min() < 0:
        raise ValueError("tile id is out of range")
    zoom = np.searchsorted(ZOOM_STARTS, ids, side="right").astype(np.int64) - 1
    pos = ids - ZOOM_STARTS[zoom]
    x, y = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
    for level in range(int(zoom.max()) if len(ids) else 0):
        live = level < zoom
        s = np.int64(1) << level
        rx = (pos >> 1) & 1
        ry = (pos ^ rx) & 1
        flip = live & (ry == 0) & (rx == 1)
        x, y = np.where(flip, s - 1 - x, x), np.where(flip, s - 1 - y, y)
        swap = live & (ry == 0)
        x, y = np.where(swap, y, x), np.where(swap, x, y)
        x, y = np.where(live, x + s * rx, x), np.where(live, y + s * ry, y)
        pos = pos >> 2
    return zoom, x, y


@F.pandas_udf(T.LongType())
def _hilbert_udf(zoom: pd.Series, x: pd.Series, y: pd.Series) -> pd.Series:
    return pd.Series(hilbert_ids(zoom.to_numpy(), x.to_numpy(), y.to_numpy()))


def with_tile_id(df: DataFrame, zoom: str = "zoom", x: str = "tile_x", y: str = "tile_y") -> DataFrame:
    """DEC-6: add `tile_id`, the position along the Hilbert curve, zoom after zoom."""
    return df.withColumn("tile_id", _hilbert_udf(zoom, x, y))


@F.pandas_udf(T.StructType([T.StructField(n, T.IntegerType()) for n in ("zoom", "tile_x", "tile_y")]))
def _tiles_udf(ids: pd.Series) -> pd.DataFrame:
    zoom, x, y = hilbert_tiles(ids.to_numpy())
    return pd.DataFrame({"zoom": zoom.astype("int32"), "tile_x": x.astype("int32"), "tile_y": y.astype("int32")})


def from_tile_id(df: DataFrame, tile_id: str = "tile_id") -> DataFrame:
    """DEC-6 inverse: add `zoom`, `tile_x`, `tile_y`."""
    t = df.withColumn("_t", _tiles_udf(tile_id))
    return t.withColumns({c: F.col(f"_t.{c}") for c in ("zoom", "tile_x", "tile_y")}).drop("_t")
