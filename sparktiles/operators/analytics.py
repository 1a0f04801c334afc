"""Questions asked of a decoded tileset (ANA-1 to ANA-9). Aggregations that combine before their shuffle throughout."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.wkbread import read_wkb

ADDRESS = ["zoom", "tile_x", "tile_y"]


def dedupe_features(features: DataFrame, key: str = "feature_id") -> DataFrame:
    """ANA-1: of the copies that buffers make, the one in the first tile; rows without a key all stay.

    An aggregation, not a window: the copies of one feature may be most of the table, and are reduced before they move.
    """
    rest = [c for c in features.columns if c not in ("layer", key)]
    keyed = features.filter(F.col(key).isNotNull())
    first = F.min_by(F.struct(*rest), F.struct(*ADDRESS)).alias("_row")
    one = keyed.groupBy("layer", key).agg(first).select("layer", key, "_row.*").select(*features.columns)
    return one.unionByName(features.filter(F.col(key).isNull()))


def feature_counts(features: DataFrame, key: str = "feature_id") -> DataFrame:
    """ANA-2: distinct features by layer and zoom."""
    return features.groupBy("layer", "zoom").agg(F.count_distinct(key).alias("features"))


def has_duplicates(features: DataFrame, key: str = "feature_id") -> DataFrame:
    """ANA-3: by layer and zoom, whether any feature is stored more than once."""
    per_key = features.groupBy("layer", "zoom", key).agg(F.count("*").alias("n"))
    return per_key.groupBy("layer", "zoom").agg((F.sum("n") > F.count(key)).alias("duplicated"))


def tile_size_report(tiles: DataFrame) -> DataFrame:
    """ANA-4. Sizes are counted first, so the exact median orders distinct sizes and not tiles."""
    sizes = tiles.groupBy("zoom", F.octet_length("tile_data").alias("size")).agg(F.count("*").alias("n"))
    return sizes.groupBy("zoom").agg(
        F.sum("n").alias("tiles"),
        F.sum(F.col("size") * F.col("n")).alias("bytes"),
        F.max("size").alias("largest"),
        F.percentile("size", 0.5, F.col("n")).alias("median"),
    )


def tileset_diff(a: DataFrame, b: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """ANA-5: rows of either side the other lacks, repeats counted, with `side`.

    One full comparison by grouping: each distinct row is counted per side before the shuffle.
    """
    columns = columns or a.columns
    both = a.select(*columns, F.lit(1).alias("_n")).unionByName(b.select(*columns, F.lit(-1).alias("_n")))
    net = both.groupBy(*columns).agg(F.sum("_n").alias("_n")).filter("_n <> 0")
    side = F.when(F.col("_n") > 0, "left").otherwise("right").alias("side")
    return net.select(*columns, side, F.abs("_n").alias("n"))


def stray_addresses(features: DataFrame, tiles: DataFrame) -> DataFrame:
    """ANA-6: feature addresses with no stored tile; empty when the two agree."""
    return features.select(*ADDRESS).distinct().join(tiles.select(*ADDRESS).distinct(), ADDRESS, "left_anti")


@F.pandas_udf(T.BooleanType())
def rings_closed(geom):
    """Whether every ring of a WKB polygon has four vertices or more and ends where it starts; NULL for other types."""
    headers, r = read_wkb(pa.Array.from_pandas(geom, type=pa.binary()))
    ends = np.cumsum(r.size)
    sound = (r.size > 3) & (r.xy[ends - r.size] == r.xy[ends - 1]).all(axis=1) if len(r) else np.zeros(0, bool)
    broken = np.bincount(r.row[~sound], minlength=len(geom)) > 0
    polygon = np.isin(headers.code, (3, 6))
    return pd.Series(np.where(polygon, ~broken, None), dtype=object)


def closed_rings(features: DataFrame) -> DataFrame:
    """ANA-7: by layer, whether all polygon rings are closed."""
    return features.groupBy("layer").agg(F.bool_and(rings_closed("geom")).alias("closed"))


def feature_survival(features: DataFrame, key: str = "feature_id") -> DataFrame:
    """ANA-8: how many features first appear at each zoom."""
    first = features.filter(F.col(key).isNotNull()).groupBy("layer", key).agg(F.min("zoom").alias("first_zoom"))
    return first.groupBy("layer", "first_zoom").agg(F.count("*").alias("features"))


def layer_profile(features: DataFrame, attributes: list[str] | None = None, approximate: bool = True) -> DataFrame:
    """ANA-9: one row per layer and attribute. All attributes in one pass, then turned into rows."""
    fixed = {"geom", "layer", "zoom", "tile_x", "tile_y", "feature_id"}
    names = attributes or [c for c in features.columns if c not in fixed]
    distinct = F.approx_count_distinct if approximate else F.count_distinct

    def stats(n: str) -> list[Column]:
        c = F.col(f"`{n}`")
        return [
            F.count(c).alias(f"{n}.count"),
            F.min(c).cast("string").alias(f"{n}.min"),
            F.max(c).cast("string").alias(f"{n}.max"),
            distinct(c).alias(f"{n}.distinct"),
        ]

    wide = features.groupBy("layer").agg(*(s for n in names for s in stats(n)))
    parts = ("count", "min", "max", "distinct")
    rows = F.array(*(F.struct(F.lit(n).alias("attribute"), *(F.col(f"`{n}.{p}`").alias(p) for p in parts)) for n in names))
    return wide.select("layer", F.explode(rows).alias("_r")).select(
        "layer",
        "_r.attribute",
        F.col("_r.count").alias("n"),
        F.col("_r.min").alias("min"),
        F.col("_r.max").alias("max"),
        F.col("_r.distinct").alias("distinct"),
    )
