"""Reading and writing tilesets by path (SRC-1 to SRC-5, SNK-3 to SNK-9)."""

from __future__ import annotations

import json
import os
import tempfile
import uuid
import zipfile
from typing import Any

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.projection import with_tile_id
from ..operators.decode import STRETCH
from ..options import OptionError
from .common import MANIFEST, filesystem
from .mbtiles import MBTilesSource
from .pmtiles import PMTilesSource

# Side of the square tile blocks a container export is dealt out by: 2^5 x 2^5 tiles.
BLOCK_BITS = 5
# Largest tileset, in stored tile bytes, that may be written as one file by one task.
SINGLE_FILE_BYTES = 2 << 30


def register(spark: SparkSession) -> SparkSession:
    """Ship this package to a session's workers, make the formats known and let filters reach the readers.

    In that order: a data source keeps the files that were shipped when it was registered."""
    context = spark.sparkContext
    if not getattr(context, "_sparktiles_shipped", False):
        context.addPyFile(_package_zip())
        context._sparktiles_shipped = True
    for source in (MBTilesSource, PMTilesSource):
        spark.dataSource.register(source)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark


def _package_zip() -> str:
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = os.path.join(tempfile.mkdtemp(prefix="sparktiles-"), "sparktiles.zip")
    with zipfile.ZipFile(out, "w") as z:
        for folder, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    return out


def _read(spark: SparkSession, fmt: str, path: str, options: dict[str, Any]) -> DataFrame:
    given = {k: v for k, v in options.items() if v is not None}
    return register(spark).read.format(fmt).options(**given).load(path)


def read_mbtiles(spark: SparkSession, path: str, zoom: int | None = None, layer: str | None = None, **options) -> DataFrame:
    """SRC-1: one row per feature at one zoom, the tileset's highest by default."""
    return _read(spark, "mbtiles", path, {"zoom": zoom, "layer": layer, **options})


def read_pmtiles(spark: SparkSession, path: str, zoom: int | None = None, layer: str | None = None, **options) -> DataFrame:
    """SRC-2."""
    return _read(spark, "pmtiles", path, {"zoom": zoom, "layer": layer, **options})


def read_mbtiles_tiles(spark: SparkSession, path: str) -> DataFrame:
    """SRC-3: the stored tiles of all zooms, decompressed but still encoded."""
    return _read(spark, "mbtiles", path, {"rows": "tiles"})


def read_pmtiles_tiles(spark: SparkSession, path: str) -> DataFrame:
    """SRC-4."""
    return _read(spark, "pmtiles", path, {"rows": "tiles"})


def container_format(path: str) -> str:
    for fmt in ("mbtiles", "pmtiles"):
        if path.rstrip("/").lower().endswith("." + fmt):
            return fmt
    raise OptionError(f'"{path}" ends in neither .mbtiles nor .pmtiles')


def read_tileset(spark: SparkSession, path: str, zoom: int | None = None, layer: str | None = None, **options) -> DataFrame:
    """SRC-5: the format follows from the suffix."""
    return _read(spark, container_format(path), path, {"zoom": zoom, "layer": layer, **options})


# --- Sinks -------------------------------------------------------------------------------------------------------------


def by_block(tiles: DataFrame) -> DataFrame:
    """Tiles dealt out by square blocks, in curve order inside each task.

    A block is a bounded number of tiles, so no task is handed a crowd, and unlike a range partitioning this needs no sampling
    pass, which would encode every tile twice.
    """
    blocks = [F.shiftright(c, BLOCK_BITS) for c in ("tile_x", "tile_y")]
    tasks = int(tiles.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return with_tile_id(tiles.repartition(tasks, "zoom", *blocks)).sortWithinPartitions("tile_id").drop("tile_id")


def write_container(
    tiles: DataFrame,
    path: str,
    metadata: dict | None = None,
    force: bool = True,
    single: bool = False,
    fmt: str | None = None,
    dealt: bool = False,
) -> None:
    """SNK-4, SNK-5, SNK-6: tile table to a directory of shards, or with `single` to one file.

    One file is written by one task, so it is refused above a fixed size. `dealt` tiles are in ranges of the curve already, as a build
    gives them, and are written as they come; they may be in stretches.
    """
    register(tiles.sparkSession)
    fmt = fmt or container_format(path)
    options = {"metadata": json.dumps(metadata or {}), "single": str(single).lower()}
    stretches = [c for c in tiles.columns if c == STRETCH and dealt and not single]
    tiles = tiles.select("zoom", "tile_x", "tile_y", "tile_data", *stretches)
    if single:
        size = tiles.agg(F.sum(F.octet_length("tile_data"))).first()[0] or 0
        if size > SINGLE_FILE_BYTES:
            raise OptionError(f"{size} tile bytes are too many for one file; write shards instead")
        ready = tiles.repartition(1)  # the tiles are made by all tasks; only finished ones meet
    else:
        ready = tiles if dealt else by_block(tiles)
    ready.write.format(fmt).mode("overwrite" if force else "append").options(**options).save(path)


def write_tiles(tiles: DataFrame, path: str, metadata: dict | None = None, force: bool = True, dealt: bool = False) -> None:
    """SNK-3: the tile table as Parquet, one folder per zoom, with the metadata beside it.

    Every write has a folder of its own, which the manifest names; the manifest is switched when the data is complete, so a failed
    overwrite leaves the old table as it was.
    """
    fs, root = filesystem(path)
    if not force and fs.get_file_info(root).type != pafs.FileType.NotFound:
        raise FileExistsError(f'"{path}" already exists')
    folder = f"data-{uuid.uuid4().hex}"
    tiles = tiles.select("zoom", "tile_x", "tile_y", "tile_data")
    ready = tiles if dealt else by_block(tiles)
    ready.write.partitionBy("zoom").parquet(f"{path.rstrip('/')}/{folder}")
    old = [i for i in fs.get_file_info(pafs.FileSelector(root)) if i.base_name not in (folder, MANIFEST)]
    with fs.open_output_stream(f"{root}/.{folder}") as f:
        f.write(json.dumps({"format": "parquet", "metadata": metadata or {}, "folder": folder}).encode())
    fs.move(f"{root}/.{folder}", f"{root}/{MANIFEST}")
    for info in old:
        (fs.delete_file if info.is_file else fs.delete_dir)(info.path)


def _manifest(path: str) -> dict:
    fs, root = filesystem(path)
    with fs.open_input_stream(f"{root}/{MANIFEST}") as f:
        return json.loads(f.read())


def read_tiles(spark: SparkSession, path: str) -> DataFrame:
    """The tile table back; a filter on `zoom` reads only that zoom's folder."""
    schema = T.StructType(
        [
            T.StructField("tile_x", T.IntegerType()),
            T.StructField("tile_y", T.IntegerType()),
            T.StructField("tile_data", T.BinaryType()),
            T.StructField("zoom", T.IntegerType()),
        ]
    )
    data = f"{path.rstrip('/')}/{_manifest(path)['folder']}"
    return spark.read.schema(schema).parquet(data).select("zoom", "tile_x", "tile_y", "tile_data")


def tiles_metadata(path: str) -> dict:
    return _manifest(path)["metadata"]
