"""What both container formats share: files and manifests, metadata to schema, filters to pruning, shard commits."""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    LessThan,
    LessThanOrEqual,
    WriterCommitMessage,
)
from pyspark.sql.types import BinaryType, IntegerType, StructField, StructType

from ..functions.mvt import gunzip_tile
from ..functions.projection import hilbert_ids
from ..functions.tileread import Spool
from ..operators.decode import STRETCH, decode_rows, output_schema
from ..options import READ_OPTIONS, OptionError, parse_read_zoom

MANIFEST = "_tileset.json"
TILE_STRUCT = StructType(
    [
        StructField("zoom", IntegerType()),
        StructField("tile_x", IntegerType()),
        StructField("tile_y", IntegerType()),
        StructField("tile_data", BinaryType()),
    ]
)
TILE_ARROW = pa.schema(
    [("zoom", pa.int32()), ("tile_x", pa.int32()), ("tile_y", pa.int32()), ("tile_data", pa.binary())]
)
# Tile bytes a writer gathers before it closes a shard: bounds a task's memory.
SHARD_BYTES = 128 << 20
# Rows and bytes per raw-tile batch.
BATCH_TILES, BATCH_BYTES = 5_000, 32 << 20


# --- Files -------------------------------------------------------------------------------------------------------------


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        if path.startswith("file:") and not path.startswith("file://"):
            path = "file://" + path[5:]
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), os.path.abspath(path)


def list_shards(path: str, suffix: str) -> tuple[list[str], dict | None]:
    """Container files behind a path, which is a file, a directory of shards, or a glob; or the manifest if there is one."""
    fs, root = filesystem(path)
    if any(c in os.path.basename(root) for c in "*?["):
        import fnmatch

        parent, pattern = os.path.split(root)
        infos = fs.get_file_info(pafs.FileSelector(parent, allow_not_found=True))
        return sorted(i.path for i in infos if i.is_file and fnmatch.fnmatch(i.base_name, pattern)), None
    info = fs.get_file_info(root)
    if info.type != pafs.FileType.Directory:
        return [root], None
    if fs.get_file_info(f"{root}/{MANIFEST}").is_file:
        with fs.open_input_stream(f"{root}/{MANIFEST}") as f:
            return [], json.loads(f.read())
    infos = fs.get_file_info(pafs.FileSelector(root))
    return sorted(i.path for i in infos if i.is_file and i.base_name.lower().endswith(suffix)), None


# --- Schema (SRC-6) ----------------------------------------------------------------------------------------------------


def parse_attributes(metadata: Iterable[str]) -> list[tuple[str, str]]:
    """Attribute columns of one or many metadata texts: first-seen order, names joined without regard to case, string
    where layers disagree. Text that is not JSON gives none."""
    found: dict[str, list[str]] = {}
    for text in metadata:
        try:
            layers = json.loads(text)["vector_layers"]
        except (ValueError, KeyError, TypeError):
            continue
        for layer in layers if isinstance(layers, list) else []:
            fields = layer.get("fields") if isinstance(layer, dict) else None
            for name, kind in fields.items() if isinstance(fields, dict) else ():
                kind = str(kind).lower() if isinstance(kind, str) else ""
                column = {"number": "double", "boolean": "boolean"}.get(kind, "string")
                known = found.setdefault(name.lower(), [name, column])
                if known[1] != column:
                    known[1] = "string"
    return [(n, k) for n, k in found.values()]


# --- Pruning (SRC-8) ---------------------------------------------------------------------------------------------------


@dataclass
class Bounds:
    """Closed ranges on the address columns that a filter allows."""

    low: dict[str, int] = field(default_factory=dict)
    high: dict[str, int] = field(default_factory=dict)

    def narrow(self, f: Filter) -> None:
        name = ".".join(getattr(f, "attribute", ())).lower()
        if name not in ("zoom", "tile_x", "tile_y"):
            return
        values = f.value if isinstance(f, In) else (getattr(f, "value", None),)
        if not values or not all(isinstance(v, int) for v in values):
            return
        low, high = None, None
        if isinstance(f, (EqualTo, In)):
            low, high = min(values), max(values)
        elif isinstance(f, (GreaterThan, GreaterThanOrEqual)):
            low = values[0] + isinstance(f, GreaterThan)
        elif isinstance(f, (LessThan, LessThanOrEqual)):
            high = values[0] - isinstance(f, LessThan)
        if low is not None:
            self.low[name] = max(low, self.low.get(name, low))
        if high is not None:
            self.high[name] = min(high, self.high.get(name, high))

    def allows(self, name: str, low: int, high: int) -> bool:
        return high >= self.low.get(name, low) and low <= self.high.get(name, high)

    def of(self, name: str, low: int, high: int) -> tuple[int, int]:
        return max(low, self.low.get(name, low)), min(high, self.high.get(name, high))


# --- Reading -----------------------------------------------------------------------------------------------------------


@dataclass
class Zones(InputPartition):
    """Tiles `first` up to `upto` of a shard, which are those with ids from `low` up to `high`."""

    file: str
    first: int
    upto: int
    low: int
    high: int
    bytes: int


class TilesetReader(DataSourceReader):
    """Feature rows or raw tiles of a set of container files; subclasses list partitions and yield stored tiles."""

    def __init__(self, source: TilesetSource):
        self.features = source.rows == "features"
        self.attributes = source.attributes() if self.features else []
        self.layer = source.options.get("layer") or None
        self.strict = (source.options.get("mode") or "FAILFAST").upper() == "FAILFAST"
        self.files, self.manifest, self.base = source.files, source.manifest, source.path
        self.bounds = Bounds()
        if self.features:
            zoom = source.zoom()
            self.bounds.low["zoom"] = self.bounds.high["zoom"] = zoom

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            self.bounds.narrow(f)
            yield f  # used to skip partitions and rows only; Spark still applies it

    def live_zones(self, split_bytes: int) -> list[Zones]:
        """By the manifest alone: stretches of tiles that may be wanted, neighbours of one file together up to `split_bytes`."""
        folder = f"{filesystem(self.base)[1]}/{self.manifest['folder']}"
        parts = [p["part"] for p in self.manifest["parts"] if self.bounds.allows("zoom", p["minzoom"], p["maxzoom"])]
        fs, _ = filesystem(self.base)

        def read(part: str) -> pa.Table:
            with fs.open_input_file(f"{folder}/{part}") as f:
                return pa.ipc.open_file(f).read_all()

        with ThreadPoolExecutor(8) as pool:
            tables = list(pool.map(read, parts))
        if not tables:
            return []
        zones = pa.concat_tables(tables).to_pydict()
        z = {k: np.array(v, np.int64) for k, v in zones.items() if k != "file"}
        live = np.ones(len(zones["file"]), bool)
        for name, low, high in (("zoom", "zoom", "zoom"), ("tile_x", "x0", "x1"), ("tile_y", "y0", "y1")):
            least, most = self.bounds.of(name, 0, 1 << 40)
            live &= (z[high] >= least) & (z[low] <= most)
        out: list[Zones] = []
        for i in np.flatnonzero(live).tolist():
            file, last = f"{folder}/{zones['file'][i]}", out[-1] if out else None
            first, upto = int(z["first"][i]), int(z["first"][i] + z["tiles"][i])
            if last and last.file == file and last.upto == first and last.bytes < split_bytes:
                last.upto, last.high, last.bytes = upto, int(z["high"][i]) + 1, last.bytes + int(z["bytes"][i])
            else:
                out.append(Zones(file, first, upto, int(z["low"][i]), int(z["high"][i]) + 1, int(z["bytes"][i])))
        return out

    def stored(self, partition) -> Iterator[tuple[int, int, int, bytes]]:
        raise NotImplementedError

    def read(self, partition) -> Iterator[pa.RecordBatch]:
        if partition is None:
            return  # Spark reads once even where pruning left no partition
        if self.features:
            yield from decode_rows(self.stored(partition), self.attributes, self.layer, self.strict)
            return
        rows, size = [], 0
        for zoom, x, y, data in self.stored(partition):
            data = gunzip_tile(data)
            if not data:
                continue  # DEC-10
            if rows and size + len(data) > BATCH_BYTES:  # a large tile is a batch of its own
                yield _tile_batch(rows)
                rows, size = [], 0
            rows.append((zoom, x, y, data))
            size += len(data)
            if len(rows) >= BATCH_TILES or size >= BATCH_BYTES:
                yield _tile_batch(rows)
                rows, size = [], 0
        if rows:
            yield _tile_batch(rows)


def _tile_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), TILE_ARROW)], schema=TILE_ARROW)


class TilesetSource(DataSource):
    suffix = ""

    def __init__(self, options):
        super().__init__(options)
        self._found = None

    @property
    def path(self) -> str:
        path = self.options.get("path")
        if not path:
            raise OptionError(f"{self.name()}: a path is required")
        return path

    @property
    def rows(self) -> str:
        rows = (self.options.get("rows") or "features").lower()
        if rows not in ("features", "tiles"):
            raise OptionError("ROWS must be 'features' or 'tiles'")
        return rows

    def _check(self) -> None:
        for key in self.options:
            if key.lower() not in READ_OPTIONS:
                raise OptionError(f'Invalid named parameter "{key}" for function read_{self.name()}')

    def _list(self) -> tuple[list[str], dict | None]:
        if self._found is None:
            self._found = list_shards(self.path, self.suffix)
            if not self._found[0] and self._found[1] is None:
                raise OSError(f'Failed to open "{self.path}": no {self.suffix} file found')
        return self._found

    @property
    def files(self) -> list[str]:
        return self._list()[0]

    @property
    def manifest(self) -> dict | None:
        return self._list()[1]

    def attributes(self) -> list[tuple[str, str]]:
        texts = [json.dumps(self.manifest["metadata"])] if self.manifest else map(self.metadata_of, self.files)
        found = parse_attributes(texts)
        columns = self.options.get("columns")
        if columns:
            wanted = {c.strip().lower() for c in columns.split(",")}
            found = [(n, k) for n, k in found if n.lower() in wanted]
        return found

    def zoom(self) -> int:
        """SRC-7: the asked zoom, else the highest of the set."""
        asked = parse_read_zoom(self.options.get("zoom"))
        if asked is not None:
            return asked
        if self.manifest:
            return self.manifest["maxzoom"]
        known = [z for z in map(self.maxzoom_of, self.files) if z is not None]
        if not known:
            raise OSError(f'no file of "{self.path}" says which zooms it has: give the zoom option')
        return max(known)

    def metadata_of(self, file: str) -> str:
        raise NotImplementedError

    def maxzoom_of(self, file: str) -> int | None:
        raise NotImplementedError

    def probe(self, file: str) -> None:
        """Fail early on a file that is no container."""

    def schema(self) -> StructType:
        self._check()
        parse_read_zoom(self.options.get("zoom"))
        if self.manifest is None:
            self.probe(self.files[0])
        return TILE_STRUCT if self.rows == "tiles" else output_schema(self.attributes())


# --- Writing (SNK-4, SNK-5, SNK-6, SNK-8) ------------------------------------------------------------------------------


# Tiles that one entry of a shard's zone map stands for.
ZONE_TILES = 4096
ZONE_ARROW = pa.schema([("file", pa.string()), *((n, pa.int64()) for n in ("first", "tiles", "bytes", "low", "high", "zoom", "x0", "x1", "y0", "y1"))])


@dataclass
class ShardMessage(WriterCommitMessage):
    """What a task hands to the driver: its one row of the manifest, or a finished single file."""

    part: dict | None = None
    file: str | None = None


class TilesetWriter(DataSourceArrowWriter):
    """Each write has a folder of its own. Tasks write shards there under their final names, and beside them the zone map of their
    shards; the driver's commit switches one pointer to the new folder, so a reader sees the old set or the new one, and only then
    does the old folder go. `single=true` makes the path itself the one container file.

    A lost or repeated attempt leaves files that no part of the manifest names.
    """

    def __init__(self, options, suffix: str, overwrite: bool, schema: StructType):
        missing = [n for n in TILE_STRUCT.names if n not in schema.names]
        if missing:
            raise OptionError(
                f"a {suffix.lstrip('.')} sink takes finished tiles (zoom, tile_x, tile_y, tile_data), and {', '.join(missing)} "
                "is missing; write_tileset builds tiles from a table of features"
            )
        self.suffix = suffix
        self.single = str(options.get("single", "false")).lower() == "true"
        self.path = options["path"]
        self.metadata = json.loads(options.get("metadata") or "{}")
        self.shard_bytes = int(options.get("shard_bytes") or SHARD_BYTES)
        self.token = uuid.uuid4().hex[:12]
        fs, root = filesystem(self.path)
        info = fs.get_file_info(root)
        if not overwrite and info.type != pafs.FileType.NotFound:
            raise FileExistsError(f'"{self.path}" already exists')
        if self.single and info.type == pafs.FileType.Directory:
            raise FileExistsError(f'"{self.path}" is a directory of shards')
        # Where the old tileset is one file, the new directory is made ready beside it.
        self.beside = not self.single and info.is_file
        self.folder = f"data-{self.token}"

    def _root(self, root: str) -> str:
        parent, name = os.path.split(root)
        return f"{parent}/.{name}.{self.token}" if self.beside else root

    def encode_shard(self, rows: list[tuple[int, int, int, bytes | Spool]]) -> Iterable[bytes]:
        """The container file of some tiles, a piece at a time: no second copy of the tiles is held."""
        raise NotImplementedError

    def write(self, iterator: Iterator[pa.RecordBatch]) -> ShardMessage:
        from pyspark import TaskContext

        context = TaskContext.get()
        task = f"{context.partitionId() if context else 0:05d}-{uuid.uuid4().hex[:8]}"
        zones, rows, size, shards = [], [], 0, 0
        for b in iterator:
            *address, data = (b.column(b.schema.names.index(n)) for n in TILE_STRUCT.names)
            stretch = b.column(b.schema.names.index(STRETCH)).to_pylist() if STRETCH in b.schema.names else [0] * b.num_rows
            for i, at in enumerate(zip(*(c.to_pylist() for c in address))):
                row = (*at, data[i].as_py())
                if not row[3]:
                    continue
                if stretch[i]:  # goes on with the tile before, which lies in a file then
                    if not rows or rows[-1][:3] != at:
                        raise ValueError(f"tile {'/'.join(map(str, at))}: its stretch {stretch[i]} does not stand behind the one before")
                    if stretch[i] == 1:
                        rows[-1] = (*at, Spool(rows[-1][3]))
                    rows[-1][3].add(row[3])
                    size += len(row[3])
                    continue
                if size >= self.shard_bytes and not self.single:
                    zones += self._close(rows, f"part-{task}-{shards:03d}{self.suffix}")
                    rows, size, shards = [], 0, shards + 1
                rows.append(row)
                size += len(row[3])
        if self.single:
            return ShardMessage(file=self._single(rows)) if rows else ShardMessage()
        if rows:
            zones += self._close(rows, f"part-{task}-{shards:03d}{self.suffix}")
        if not zones:
            return ShardMessage()
        table = pa.Table.from_pylist(zones, ZONE_ARROW)
        fs, root = filesystem(self.path)
        name = f"zones-{task}.arrow"
        with fs.open_output_stream(f"{self._root(root)}/{self.folder}/{name}") as f, pa.ipc.new_file(f, ZONE_ARROW) as out:
            out.write_table(table)
        zoom = [z["zoom"] for z in zones]
        return ShardMessage({"part": name, "tiles": sum(z["tiles"] for z in zones), "minzoom": min(zoom), "maxzoom": max(zoom)})

    def _single(self, rows: list[tuple]) -> str:
        fs, root = filesystem(self.path)
        parent, name = os.path.split(root)
        fs.create_dir(parent, recursive=True)
        hidden = f"{parent}/.{name}.{self.token}.{uuid.uuid4().hex[:8]}"
        with fs.open_output_stream(hidden) as f:
            for piece in self.encode_shard(rows):
                f.write(piece)
        return hidden

    def _close(self, rows: list[tuple], name: str) -> list[dict]:
        """One shard, its tiles in curve order, and its zone map: an entry per stretch of tiles of one zoom."""
        address = np.array([r[:3] for r in rows], np.int64).reshape(-1, 3)
        ids = hilbert_ids(*address.T)
        order = np.argsort(ids, kind="stable")
        rows, address, ids = [rows[i] for i in order.tolist()], address[order], ids[order]
        fs, root = filesystem(self.path)
        folder = f"{self._root(root)}/{self.folder}"
        fs.create_dir(folder, recursive=True)
        with fs.open_output_stream(f"{folder}/{name}") as f:
            for piece in self.encode_shard(rows):
                f.write(piece)
        size = np.array([len(r[3]) for r in rows], np.int64)
        out = []
        heads = np.flatnonzero(np.diff(address[:, 0], prepend=-1))
        for a, b in zip(heads, np.append(heads[1:], len(rows)), strict=True):
            for low in range(int(a), int(b), ZONE_TILES):
                high = min(low + ZONE_TILES, int(b))
                x, y = address[low:high, 1], address[low:high, 2]
                place = {"file": name, "first": low, "tiles": high - low, "bytes": int(size[low:high].sum()), "low": int(ids[low]), "high": int(ids[high - 1])}
                out.append(place | {"zoom": int(address[low, 0]), "x0": int(x.min()), "x1": int(x.max()), "y0": int(y.min()), "y1": int(y.max())})
        return out

    def commit(self, messages: list[ShardMessage | None]) -> None:
        fs, root = filesystem(self.path)
        if self.single:
            files = [m.file for m in messages if m is not None and m.file]
            if len(files) != 1:
                self.abort(messages)
                raise ValueError(f"a single-file tileset needs exactly one writing task with tiles, got {len(files)}")
            fs.move(files[0], root)
            return
        parts = sorted((m.part for m in messages if m is not None and m.part), key=lambda p: p["part"])
        place = self._root(root)
        fs.create_dir(f"{place}/{self.folder}", recursive=True)
        old = [] if self.beside else [i for i in fs.get_file_info(pafs.FileSelector(root)) if i.base_name not in (self.folder, MANIFEST)]
        manifest = {
            "format": self.suffix.lstrip("."),
            "metadata": self.metadata,
            "minzoom": min((p["minzoom"] for p in parts), default=0),
            "maxzoom": max((p["maxzoom"] for p in parts), default=0),
            "folder": self.folder,
            "parts": parts,
        }
        hidden = f"{place}/.{MANIFEST}.{self.token}"
        with fs.open_output_stream(hidden) as f:
            f.write(json.dumps(manifest).encode())
        fs.move(hidden, f"{place}/{MANIFEST}")
        if self.beside:  # a file gives way to a directory: the old one steps aside first and goes last
            aside = f"{place}.old"
            fs.move(root, aside)
            fs.move(place, root)
            fs.delete_file(aside)
        for info in old:
            (fs.delete_file if info.is_file else fs.delete_dir)(info.path)

    def abort(self, messages: list[ShardMessage | None]) -> None:
        fs, root = filesystem(self.path)
        if self.single:
            for m in messages:
                if m is not None and m.file and fs.get_file_info(m.file).is_file:
                    fs.delete_file(m.file)
            return
        folder = self._root(root) if self.beside else f"{root}/{self.folder}"
        if fs.get_file_info(folder).type == pafs.FileType.Directory:
            fs.delete_dir(folder)
