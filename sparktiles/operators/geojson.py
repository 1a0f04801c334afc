"""SNK-1: rows as newline-delimited GeoJSON features."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import wkb
from ..functions.jsontext import coordinate, encode_basestring, jsonable, render
from ..options import Options, parse_options
from .features import GEOJSON, LONLAT, _q, _require, normalise, property_names, resolve_geometry

# Column metadata key that marks a string column as JSON already.
JSON_MARK = "json"


def _geometries(b: pa.RecordBatch, kind: str, precision: int) -> list[str]:
    if kind == LONLAT:
        pairs = zip(b.column("_lon").to_pylist(), b.column("_lat").to_pylist())
        return [
            "null"
            if x is None or y is None
            else f'{{"type":"Point","coordinates":[{coordinate(x, precision)},{coordinate(y, precision)}]}}'
            for x, y in pairs
        ]
    values = b.column("_geom").to_pylist()
    if kind == GEOJSON:
        return [v or "null" for v in values]
    return ["null" if v is None else wkb.geojson(wkb.from_wkb(v), precision) for v in values]


def _lines(kind: str, precision: int, names: list[str], verbatim: list[bool], has_id: bool) -> Callable:
    keys = [encode_basestring(n) + ":" for n in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows == 0:
                continue
            geometries = _geometries(b, kind, precision)
            cols = [render(b.column(f"_p{i}"), v) for i, v in enumerate(verbatim)]
            rows = list(zip(*cols)) if cols else [()] * b.num_rows
            ids = render(b.column("_id")) if has_id else [None] * b.num_rows
            out = []
            for fid, geometry, row in zip(ids, geometries, rows):
                head = "" if fid is None else f'"id":{fid},'
                body = ",".join(k + v for k, v in zip(keys, row) if v is not None)
                out.append(f'{{"type":"Feature",{head}"geometry":{geometry},"properties":{{{body}}}}}')
            yield pa.record_batch([pa.array(out, pa.string())], names=["line"])

    return run


def geojson_lines(df: DataFrame, opts: Options | None = None, **options) -> DataFrame:
    """One `line` per row. Keys in the order type, id, geometry, properties; NULL properties are left out."""
    opts = opts or parse_options(options)
    binding = resolve_geometry(df.schema, opts)
    names = property_names(df.schema, binding, opts)
    geometry = {"lon": "_lon", "lat": "_lat"} if binding.kind == LONLAT else {"geom": "_geom", "geojson": "_geom"}
    cols = [c.alias(geometry[n]) for n, c in normalise(df, binding).items()]
    verbatim = []
    for i, n in enumerate(names):
        f = _require(df.schema, n, "property")
        if isinstance(f.dataType, T.VariantType):
            cols.append(F.to_json(_q(n)).alias(f"_p{i}"))
        else:
            cols.append(jsonable(_q(n), f.dataType).alias(f"_p{i}"))
        verbatim.append(isinstance(f.dataType, T.VariantType) or bool(f.metadata.get(JSON_MARK)))
    if opts.id_column is not None:
        f = _require(df.schema, opts.id_column, "ID_COLUMN")
        cols.append(jsonable(_q(f.name), f.dataType).alias("_id"))
    run = _lines(binding.kind, opts.coordinate_precision, names, verbatim, opts.id_column is not None)
    return df.select(*cols).mapInArrow(run, "line string")


def write_geojsonl(df: DataFrame, path: str, opts: Options | None = None, order_by: str | None = None, **options) -> None:
    """SNK-1 and SNK-10: a directory of text parts; `order_by` sorts the rows first, which is otherwise not done."""
    df = df.orderBy(order_by) if order_by else df
    geojson_lines(df, opts, **options).write.mode("overwrite").text(path)
