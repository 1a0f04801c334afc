"""Token ids in binary files: fixed-size blocks of ids, turned into bit or byte planes, each plane compressed by zstandard.

A file is the blocks one after the other and a footer:

    magic "PLN1" | planes of block 0 | planes of block 1 | ... | Arrow stream of documents | Arrow stream of blocks
    | length of each stream (2 x u64) | plane kind (u8: 1 bit, 8 byte) | magic "PLN1"

The stream of blocks is the chunk index: place in the file, number of ids, and compressed size of each plane, highest first.
Planes above a block's largest id are left out. The stream of documents has each document's id and number of tokens.

Documents are range-partitioned and sorted by doc_id; a task writes its files under names of its own and returns one manifest
row per file. The manifest is a Spark table, so the files of lost or repeated tasks are never listed and never read.
"""

from __future__ import annotations

import functools
import io
import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.common import filesystem
from .common import Words, arrow_map, distinct_spans, ranges, shared_folder, slices, stored, table, text_bytes

MAGIC = b"PLN1"
BLOCK_IDS = 1 << 16
FILE_IDS = 1 << 25
CACHED_WORDS = 1_000_000
# Bytes of texts that are looked up together: the more, the fewer of their words are looked up twice.
ENCODED_BYTES = 4 << 20
MANIFEST = "part int, seq int, path string, n_docs long, n_ids long"
_TAIL = b".,;:!?|*#$%&"
_PLAIN = frozenset(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")
_OTHER, _LETTER, _DIGIT, _GAP = range(4)
_KIND = np.full(256, _OTHER, np.uint8)
_KIND[list(b" \t\n\v\f\r")] = _GAP
_KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = _LETTER
_KIND[list(b"0123456789")] = _DIGIT
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
#: Where this stands in a text, ASCII letters are not lowered beforehand: marks that may join them, and special tokens.
_MARK = re.compile(rb"[\xcc\xcd]|<\|")


# --- Planes ------------------------------------------------------------------------------------------------------------


def to_planes(ids: np.ndarray, bits: int) -> list[bytes]:
    """Planes of a block, highest first: every id's most significant bit (or byte), then the next, down to the lowest."""
    if bits == 8:
        planes = ids.astype(">u4").view(np.uint8).reshape(-1, 4).T
    else:
        planes = np.packbits(np.unpackbits(ids.astype(">u4").view(np.uint8).reshape(-1, 4), axis=1).T, axis=1)
    used = planes.any(axis=1)
    first = int(used.argmax()) if used.any() else len(used) - 1
    return [np.ascontiguousarray(p).tobytes() for p in planes[first:]]


def from_planes(planes: list[bytes], n: int, bits: int) -> np.ndarray:
    width = 32 // bits
    rows = np.zeros((width, n if bits == 8 else (n + 7) // 8), np.uint8)
    for row, plane in zip(rows[width - len(planes) :], planes, strict=True):
        row[:] = np.frombuffer(plane, np.uint8)
    if bits == 8:
        return np.ascontiguousarray(rows.T).view(">u4")[:, 0].astype(np.uint32)
    each = np.unpackbits(rows, axis=1, count=n)
    return np.packbits(np.ascontiguousarray(each.T), axis=1).view(">u4")[:, 0].astype(np.uint32)


def _stream(data: pa.Table) -> bytes:
    out = io.BytesIO()
    with pa.ipc.new_stream(out, data.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(data)
    return out.getvalue()


class TokenFile:
    """Writer of one file. Ids wait in memory for at most one block."""

    def __init__(self, path: str, bits: int, doc_type: pa.DataType) -> None:
        fs, self.path = filesystem(path)
        fs.create_dir(os.path.dirname(self.path), recursive=True)
        self.out, self.bits, self.doc_type = fs.open_output_stream(self.path), bits, doc_type
        self.out.write(MAGIC)
        self.at, self.waiting, self.n_waiting = len(MAGIC), [], 0
        self.blocks: list[tuple[int, int, list[int]]] = []
        self.docs: list[pa.Array] = []
        self.counts: list[np.ndarray] = []
        self.n_ids = self.n_docs = 0
        self.packer = zstandard.ZstdCompressor(level=3)

    def add(self, doc_ids: pa.Array, counts: np.ndarray, ids: np.ndarray) -> None:
        self.docs.append(doc_ids)
        self.counts.append(counts)
        self.n_docs, self.n_ids = self.n_docs + len(doc_ids), self.n_ids + len(ids)
        self.waiting.append(ids)
        self.n_waiting += len(ids)
        if self.n_waiting >= BLOCK_IDS:
            ids = np.concatenate(self.waiting)
            whole = len(ids) // BLOCK_IDS * BLOCK_IDS
            for low in range(0, whole, BLOCK_IDS):
                self._block(ids[low : low + BLOCK_IDS])
            self.waiting, self.n_waiting = [ids[whole:]], len(ids) - whole

    def _block(self, ids: np.ndarray) -> None:
        packed = [self.packer.compress(p) for p in to_planes(ids, self.bits)]
        self.blocks.append((self.at, len(ids), [len(p) for p in packed]))
        for p in packed:
            self.out.write(p)
            self.at += len(p)

    def close(self) -> None:
        if self.n_waiting:
            self._block(np.concatenate(self.waiting))
        docs = _stream(pa.table({"doc_id": pa.chunked_array(self.docs, self.doc_type), "n_tokens": np.concatenate(self.counts)}))
        at, n, sizes = zip(*self.blocks, strict=True) if self.blocks else ((), (), ())
        blocks = _stream(pa.table({"at": pa.array(at, pa.int64()), "n_ids": pa.array(n, pa.int64()), "sizes": pa.array(sizes, pa.list_(pa.int64()))}))
        self.out.write(docs + blocks + struct.pack("<QQB", len(docs), len(blocks), self.bits) + MAGIC)
        self.out.close()


def read_token_file(path: str) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """(doc ids, token counts, ids of them all) in file order, about a block at a time; documents are never split."""
    fs, path = filesystem(path)
    with fs.open_input_file(path) as f:
        tail = f.read_at(17 + len(MAGIC), f.size() - 17 - len(MAGIC))
        if tail[-4:] != MAGIC or f.read_at(4, 0) != MAGIC:
            raise ValueError(f"{path} is no token file")
        n_docs, n_blocks, bits = struct.unpack("<QQB", tail[:-4])
        end = f.size() - len(tail)
        docs = pa.ipc.open_stream(f.read_at(n_docs, end - n_blocks - n_docs)).read_all().combine_chunks()
        blocks = pa.ipc.open_stream(f.read_at(n_blocks, end - n_blocks)).read_all()
        names, counts = docs.column("doc_id"), docs.column("n_tokens").to_numpy()
        ends = np.cumsum(counts)
        unpack, done, held, base = zstandard.ZstdDecompressor(), 0, np.zeros(0, np.uint32), 0
        for at, n, sizes in zip(*(blocks.column(c).to_pylist() for c in ("at", "n_ids", "sizes")), strict=True):
            raw = f.read_at(sum(sizes), at)
            cuts = np.concatenate([[0], np.cumsum(sizes)])
            planes = [unpack.decompress(raw[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            held = np.concatenate([held, from_planes(planes, n, bits)])
            upto = int(np.searchsorted(ends, base + len(held), "right"))
            if upto > done:
                used = int(ends[upto - 1]) - base
                yield names.slice(done, upto - done).combine_chunks(), counts[done:upto], held[:used]
                held, base, done = held[used:], base + used, upto
        if done < len(counts):  # documents without any token at the end of the file
            yield names.slice(done).combine_chunks(), counts[done:], held


# --- Encoding ----------------------------------------------------------------------------------------------------------


def word_parts(words: Words, whole_rows: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the parts that the tokenizer's pattern cuts words into: runs of letters, single digits, runs of other signs,
    and contractions. Words with other signs than ASCII and the letters of Latin-1, and those of `whole_rows`, are left whole. There
    are far fewer parts than words."""
    data, n = words.data, len(words.data)
    kind = _KIND[data]
    whole = np.zeros(len(words.starts) + 1, bool)
    lead = np.flatnonzero(data[:-1] == 0xC3)
    lead = lead[(data[lead + 1] != 0x97) & (data[lead + 1] != 0xB7)]  # all but the signs for times and divided by
    kind[lead] = kind[lead + 1] = _LETTER
    foreign = data >= 0x80
    foreign[lead] = foreign[lead + 1] = False
    whole[np.searchsorted(words.starts, np.flatnonzero(foreign), "right") - 1] = True
    for row in whole_rows:
        whole[words.offsets[row] : words.offsets[row + 1]] = True
    begins = np.zeros(n + 3, bool)
    begins[words.starts] = True
    start = begins.copy()
    cut = np.flatnonzero(((kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)) & (kind[1:] != _GAP) & (kind[:-1] != _GAP)) + 1
    start[cut[~whole[np.searchsorted(words.starts, cut, "right") - 1]]] = True
    quotes = np.flatnonzero((data == 0x27) & start[:n])
    quotes = quotes[~whole[np.searchsorted(words.starts, quotes, "right") - 1]]
    far = np.concatenate([data, np.zeros(3, np.uint8)])
    one, two = far[quotes + 1], far[quotes + 2]
    short = ~begins[quotes + 1] & np.isin(one, np.frombuffer(b"stmd", np.uint8))
    long = ~begins[quotes + 1] & ~begins[quotes + 2] & np.isin(one.astype(int) << 8 | two, [c[0] << 8 | c[1] for c in (b"re", b"ve", b"ll")])
    start[quotes[short | long] + 1] = False
    behind = np.concatenate([quotes[short] + 2, quotes[long] + 3])
    behind = behind[behind < n]
    start[behind[kind[behind] != _GAP]] = True
    starts = np.flatnonzero(start[:n])
    own = np.searchsorted(words.starts, starts, "right") - 1
    return starts, np.minimum(np.append(starts[1:], n), words.ends[own])


class WordEncoder:
    """Whole texts through a tokenizers file, each word encoded once while it is remembered.

    Where the tokenizer drops white space and never looks across it, a text's ids are those of its words, one after the
    other; so are those of a word and the ASCII punctuation behind it, and the case of ASCII letters does not matter where they
    will be lowered anyhow. `by_word=False` encodes the texts as they are, for tokenizers that are not like that.
    """

    def __init__(self, path: str, by_word: bool = True) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.by_word = Tokenizer.from_file(path), by_word
        self.words: dict[bytes, bytes] = {}

    def encode(self, data: np.ndarray, offsets: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(counts, ids) with the end id behind each text. Words are looked up once for all the places at which they stand."""
        if not self.by_word:
            raw = data.tobytes()
            texts = [raw[a:b].decode() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
            counts = np.array([len(x.ids) for x in found], np.int64)
            ids = np.array([t for x in found for t in x.ids], "<u4")
        else:
            low, marked = self._lowered(data, offsets)
            starts, ends = word_parts(Words(low, offsets), marked)
            first, group = distinct_spans(low, starts, ends - starts)
            raw = low.tobytes()
            texts = [raw[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)]
            self._learn(texts)
            found = [self.words[w] for w in texts]
            size = np.array([len(x) // 4 for x in found], np.int64)
            each = size[group]
            ids = np.frombuffer(b"".join(found), "<u4")[ranges((np.cumsum(size) - size)[group], each)]
            upto = np.concatenate([[0], np.cumsum(each)])
            counts = np.diff(upto[np.searchsorted(starts, offsets)])
        out = np.full(len(ids) + len(counts), end_id, "<u4")
        out[np.arange(len(ids)) + np.repeat(np.arange(len(counts)), counts)] = ids
        return counts + 1, out

    @staticmethod
    def _lowered(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, list[int]]:
        """ASCII letters in lower case, but for texts with a mark, and those texts."""
        low = _LOWER[data]
        marked = {int(np.searchsorted(offsets, m.start(), "right")) - 1 for m in _MARK.finditer(data.tobytes())}
        for row in marked:
            low[offsets[row] : offsets[row + 1]] = data[offsets[row] : offsets[row + 1]]
        return low, sorted(marked)

    def _learn(self, texts: list[bytes]) -> None:
        if len(self.words) > CACHED_WORDS:
            self.words.clear()
        words = self.words
        missing, cut = set(), []
        for w in set(texts).difference(words):
            if w[-1] in _PLAIN:
                missing.add(w)
                continue
            stem = w.rstrip(_TAIL)
            # Other signs before the punctuation belong to the same token as it.
            if stem != w and stem and (stem[-1] in _PLAIN or stem.decode()[-1].isalpha()):
                tail = w[len(stem) :]
                cut.append((w, stem, tail))
                missing.add(stem)
                missing.add(tail)
            else:
                missing.add(w)
        new = list(missing.difference(words))
        for low in range(0, len(new), 20_000):
            self._encode_parts(new[low : low + 20_000])
        for w, stem, tail in cut:
            words[w] = words[stem] + words[tail]

    def _encode_parts(self, parts: list[bytes], each: int = 200) -> None:
        """Many parts a call, apart by spaces; a token's first character tells its part."""
        for low in range(0, len(parts), each):
            group = parts[low : low + each]
            texts = [p.decode() for p in group]
            code = self.tokenizer.encode(" ".join(texts), add_special_tokens=False)
            starts = np.cumsum([0] + [len(t) + 1 for t in texts])
            first = np.array(code.offsets, np.int64).reshape(-1, 2)[:, 0]
            cuts = (4 * np.searchsorted(first, starts)).tolist()
            raw = np.array(code.ids, "<u4").tobytes()
            self.words.update(zip(group, [raw[a:b] for a, b in zip(cuts[:-1], cuts[1:])], strict=True))


@functools.cache
def encoder_of(path: str, by_word: bool) -> WordEncoder:
    """One encoder for all tasks of a worker process, which share the words they have met."""
    return WordEncoder(path, by_word)


def drops_white_space(path: str) -> bool:
    """Whether a tokenizers file is of the kind WordEncoder may take word by word: lower case, words split by a pattern that
    leaves white space out, byte-level pairs with word ends."""
    import json

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    normal = [n["type"] for n in (spec.get("normalizer") or {}).get("normalizers", [])]
    pre = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
    added = any(t["lstrip"] or t["rstrip"] or t["single_word"] or any(c.isspace() for c in t["content"]) for t in spec["added_tokens"])
    return (
        normal == ["NFC", "Replace", "Lowercase"]
        and pre[0].get("type") == "Split"
        and pre[0].get("behavior") == "Removed"
        and pre[0].get("invert") is True
        and pre[0].get("pattern", {}).get("Regex") == r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
        and not added
        and not spec.get("post_processor")
    )


# --- Spark -------------------------------------------------------------------------------------------------------------


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 2, bits: int = 8) -> DataFrame:
    """Encode `text` of every row and write token files below `folder`; returns their manifest, which is written too.

    `docs`: doc_id and text, other columns are ignored. Files follow ascending doc_id (nulls first, equal ids by text). A null
    or empty text gives the end id alone; no rows give an empty manifest. `tokenizer` is a path that every executor has.
    """
    by_word = drops_white_space(tokenizer)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, out, part = encoder_of(tokenizer, by_word), None, TaskContext.get().partitionId()
        made: list[tuple] = []

        def close() -> None:
            out.close()
            made.append((part, len(made), out.path if "://" not in folder else f"{folder}/{os.path.basename(out.path)}", out.n_docs, out.n_ids))

        for batch in batches:
            data, at = text_bytes(batch.column("text"))
            for low, high in slices(at, ENCODED_BYTES):
                counts, ids = encoder.encode(data[at[low] : at[high]], at[low : high + 1] - at[low], end_id)
                out = out or TokenFile(f"{folder}/{uuid.uuid4().hex}.tok", bits, batch.column("doc_id").type)
                out.add(batch.column("doc_id").slice(low, high - low), counts, ids)
                if out.n_ids >= FILE_IDS:
                    close()
                    out = None
        if out:
            close()
        if made:
            columns = [pa.array(c, t) for c, t in zip(zip(*made, strict=True), (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()), strict=True)]
            yield pa.RecordBatch.from_arrays(columns, ["part", "seq", "path", "n_docs", "n_ids"])

    return stored(ordered.mapInArrow(run, MANIFEST))


def token_starts(manifest: DataFrame) -> DataFrame:
    """Manifest rows with the number of ids in all files before each. One row per file: a small table."""
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("first_id", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read_token_files(manifest: DataFrame, doc_type: str = "long") -> DataFrame:
    """One row per document from the files: doc_id, start, n_tokens, ids_crc32 (of the ids as little-endian u32)."""
    files = token_starts(manifest).select("path", "first_id")
    spread = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def make():
        def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for path, first in zip(batch.column("path").to_pylist(), batch.column("first_id").to_pylist(), strict=True):
                for names, counts, ids in read_token_file(path):
                    ends = np.cumsum(counts)
                    raw = memoryview(ids.astype("<u4", copy=False)).cast("B")
                    sums = [zlib.crc32(raw[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), counts.tolist(), strict=True)]
                    columns = [names, pa.array(first + ends - counts), pa.array(counts), pa.array(sums, pa.int64())]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32"])
                    first += int(ends[-1])

        return step

    schema = f"doc_id {doc_type}, start long, n_tokens long, ids_crc32 long"
    return arrow_map(files.repartition(spread, "path"), make, schema)


def op10_token_files(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("word_bpe_49k.json")
    docs = table(spark, sf_dir, "documents")
    manifest = write_token_files(docs, f"{shared_folder(spark)}/tokens", tokenizer)
    return read_token_files(manifest, docs.schema["doc_id"].dataType.simpleString())
