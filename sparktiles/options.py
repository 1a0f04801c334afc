"""Write and read options: names, arity, types and defaults (TIL-18, FEA-8). All checks run before any job."""

from __future__ import annotations

import math
import os
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

# Spellings that steer an external process in other tilers; accepted and without effect here.
IGNORED_OPTIONS = ("read_parallel", "verbose", "binary")
READ_OPTIONS = ("zoom", "layer", "columns", "mode", "rows", "path")

# The per-tile caps and zoom bounds.
MAX_TILE_BYTES = 500_000
MAX_TILE_FEATURES = 200_000
MAX_READ_ZOOM = 32
MAX_PRECISION = 17


class OptionError(ValueError):
    """A bad option or a geometry that cannot be resolved; raised on the driver before any job."""


@dataclass
class Options:
    geometry_column: str | None = None
    lon: str | None = None
    lat: str | None = None
    id_column: str | None = None
    layer: str | None = None
    layer_column: str | None = None
    name: str | None = None
    description: str | None = None
    attribution: str | None = None
    minzoom: int = 0
    maxzoom: int | None = 14  # None: guess from the data
    buffer: int = 5
    simplification: float = 1.0
    base_zoom: int | None = None
    drop_rate: float | None = None
    force: bool = True
    keep_geojson: str | None = None
    coordinate_precision: int = 7
    drop_densest_as_needed: bool = False
    coalesce_densest_as_needed: bool = False
    extend_zooms_if_still_dropping: bool = False
    no_tile_size_limit: bool = True
    no_feature_limit: bool = True
    cluster_distance: int | None = None
    accumulate: dict[str, str] = field(default_factory=dict)
    tile_feature_limit: int = MAX_TILE_FEATURES
    allow_empty: bool = False
    shards: int | None = None

    @property
    def thinning(self) -> bool:
        return self.drop_rate is not None or self.base_zoom is not None


_TRUE, _FALSE = {"true", "t", "1", "yes", "y"}, {"false", "f", "0", "no", "n"}


def _truth(text: str) -> bool:
    if text.lower() not in _TRUE | _FALSE:
        raise ValueError(text)
    return text.lower() in _TRUE


def _whole(text: str) -> int:
    number = float(text)
    return int(text) if text.lstrip("+-").isdigit() else round(number)


@dataclass(frozen=True)
class Kind:
    """How an option's one value is read, and the bounds it has."""

    read: Callable[[str], Any] = str
    what: str = "text"
    low: float = -math.inf
    high: float = math.inf

    def value(self, name: str, given: Any) -> Any:
        if self.read is _truth and (given == "" or isinstance(given, (list, tuple)) and not given):
            return True  # the option alone switches it on
        values = list(given) if isinstance(given, (list, tuple)) else [given]
        if len(values) != 1 or values[0] is None:
            raise OptionError(f"{name.upper()} takes one value that is not NULL, not {given!r}")
        try:
            value = self.read(str(values[0]))
        except ValueError:
            raise OptionError(f"{name.upper()} takes {self.what}, not {values[0]!r}") from None
        if self.read in (_whole, float) and not self.low <= value <= self.high:
            bounds = f"at least {self.low}" if self.high == math.inf else f"at most {self.high}" if self.low == -math.inf else f"between {self.low} and {self.high}"
            raise OptionError(f"{name.upper()} must be {bounds}, not {value}")
        return value


def _number(low: float = -math.inf, high: float = math.inf) -> Kind:
    return Kind(_whole, "an integer", low, high)


def _args(value: Any, out: Options) -> None:
    """Of the free-form flags only clustering and accumulation mean something without the external process."""
    for arg in [value] if isinstance(value, str) else list(value):
        if arg is None:
            raise OptionError("ARGS must not contain NULL")
        flag, _, text = str(arg).partition("=")
        if flag == "--cluster-distance":
            out.cluster_distance = KINDS["cluster_distance"].value("cluster_distance", text)
        elif flag == "--accumulate-attribute":
            attribute, _, how = text.rpartition(":")
            out.accumulate[attribute] = how
        else:
            raise OptionError(f"ARGS: unsupported flag {arg!r}")


MAX_BUILD_ZOOM = 24
ACCUMULATORS = ("sum", "min", "max", "mean", "count", "concat")
_FLAG, _TEXT, _ZOOM = Kind(_truth, "true or false"), Kind(), _number(0, MAX_BUILD_ZOOM)
# Every option of a tileset write. Tile-local coordinates of a buffer of up to 127/256 of a tile fit the clipping's integers.
KINDS: dict[str, Kind] = {
    **dict.fromkeys(("geometry_column", "lon", "lat", "id_column", "layer", "layer_column", "name", "description", "attribution", "keep_geojson"), _TEXT),
    **dict.fromkeys(("minzoom", "maxzoom"), _ZOOM),
    "base_zoom": _number(),
    "buffer": _number(0, 127),
    "simplification": Kind(float, "a number"),
    "drop_rate": Kind(float, "a number", 1),
    "coordinate_precision": _number(high=MAX_PRECISION),
    "cluster_distance": _number(1, 256),
    "tile_feature_limit": _number(1),
    "shards": _number(1, 1),
    **dict.fromkeys(("force", "drop_densest_as_needed", "coalesce_densest_as_needed", "extend_zooms_if_still_dropping"), _FLAG),
    **dict.fromkeys(("no_tile_size_limit", "no_feature_limit", "allow_empty"), _FLAG),
}
ALIASES = {"geometry": "geometry_column", "longitude": "lon", "latitude": "lat"}


def parse_options(options: dict[str, Any], fmt: str = "mbtiles") -> Options:
    out = Options()
    given = {k.lower(): v for k, v in options.items()}
    for key, value in given.items():
        name = ALIASES.get(key, key)
        if key in IGNORED_OPTIONS or (name != key and name in given):
            continue  # a main spelling wins over its alias
        if key == "args":
            _args(value, out)
        elif key == "accumulate":
            out.accumulate.update(value)
        elif key == "maxzoom" and str(value).lower() in ("g", "auto"):
            out.maxzoom = None
        elif name in KINDS:
            setattr(out, name, KINDS[name].value(key, value))
        else:
            raise OptionError(f'Unrecognized option "{key.upper()}" for {fmt}')
    if (out.lon is None) != (out.lat is None):
        raise OptionError("LON and LAT are given together or not at all")
    if out.maxzoom is not None and out.minzoom > out.maxzoom:
        raise OptionError("MINZOOM must not be above MAXZOOM")
    for attribute, how in out.accumulate.items():
        if how not in ACCUMULATORS:
            raise OptionError(f"accumulation of {attribute!r} must be one of {', '.join(ACCUMULATORS)}, not {how!r}")
    return out


def parse_read_zoom(value: Any) -> int | None:
    """SRC-8: a reader's zoom, or None for the tileset's own maximum."""
    if value is None or value == "":
        return None
    return _number(0, MAX_READ_ZOOM).value("zoom", value)


def derive_layer_name(path: str) -> str:
    """FEA-8: the file stem of the path the user wrote; a leading dot is part of the name."""
    return os.path.splitext(os.path.basename(path))[0] or "features"
