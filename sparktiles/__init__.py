"""Vector tilesets on Spark: build them from DataFrames, read them back as DataFrames, ask questions of them."""

from .operators.analytics import (
    closed_rings,
    dedupe_features,
    feature_counts,
    feature_survival,
    has_duplicates,
    layer_profile,
    stray_addresses,
    tile_size_report,
    tileset_diff,
)
from .operators.decode import decode_tiles
from .operators.geojson import geojson_lines, write_geojsonl
from .options import OptionError
from .plans.build import TileBuildError, build, build_tiles, write_tileset
from .sources.tilesets import (
    read_mbtiles,
    read_mbtiles_tiles,
    read_pmtiles,
    read_pmtiles_tiles,
    read_tiles,
    read_tileset,
    register,
    write_container,
    write_tiles,
)

__all__ = [
    "OptionError",
    "TileBuildError",
    "build",
    "build_tiles",
    "closed_rings",
    "decode_tiles",
    "dedupe_features",
    "feature_counts",
    "feature_survival",
    "geojson_lines",
    "has_duplicates",
    "layer_profile",
    "read_mbtiles",
    "read_mbtiles_tiles",
    "read_pmtiles",
    "read_pmtiles_tiles",
    "read_tiles",
    "read_tileset",
    "register",
    "stray_addresses",
    "tile_size_report",
    "tileset_diff",
    "write_container",
    "write_geojsonl",
    "write_tiles",
    "write_tileset",
]
