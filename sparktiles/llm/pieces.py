"""Sampled segmentations over a fixed piece vocabulary, and lossless decoding.

A text, with a space in front, is cut before every space; no piece crosses such a cut, and there are no other cuts, however long a
chunk is. The probability of a segmentation is the product of its pieces' weights. Forward filtering sums, for each byte of a chunk, the weights of all segmentations up to it;
backward sampling then draws pieces from the end, each with its exact share of what remains. The numbers drawn are hashed
from a seed, the row's key, the chunk's place in the text and the step, so a row is segmented the same way in every run, layout
and task, while the same word may be cut differently in different places. Pieces are byte strings and every byte has a piece,
so decoding gives back exactly the text.

Vocabularies give no probabilities for sampling; a piece's weight is 1 / (rank + ZIPF) ^ sharpness, byte pieces for bytes that
are no piece have BYTE_WEIGHT. Null and empty texts are one space: the pieces of it, and decode to the empty text.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import U64, arrow_map, mix, per_row, ranges, slices, span_hashes, table, text_bytes
from .lattice import PART_BYTES, PIECE_BYTES, PieceTable, by_length, default_model

ZIPF, BYTE_WEIGHT = 10.0, 1e-4
#: Growth per byte that keeps sums over long parts within a double's range.
_LIFT = 16.0
#: Stretches of long chunks whose lattices are worked on at once; chunks that are left when the others are done are walked one by one.
_STRETCHES, _FEW, _DRAWS = 128, 8, 4096


class PieceSampler:
    def __init__(self, model: str, sharpness: float = 1.0, seed: int = 5) -> None:
        self.pieces, self.seed = PieceTable(model), seed
        self.weights = (self.pieces.ranks + ZIPF) ** -float(sharpness)
        self.weights[self.pieces.byte_ids] = BYTE_WEIGHT

    def lattice(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, ...]:
        """States are (part, byte): `base[part] + byte`. For every state the ways to leave it backwards, with running shares.

        Returns base, shares (state + share of this way and those before it, ascending), and each way's length and piece.
        """
        base = np.concatenate([[0], np.cumsum(lengths + 1)])
        state, share, size, piece = [], [], [], []
        short, long = np.flatnonzero(lengths <= PART_BYTES), np.flatnonzero(lengths > PART_BYTES)
        for which, chars in by_length(starts[short], lengths[short], data):
            which = short[which]
            n, width = chars.shape
            ways = [(s, r, a, p, self.weights[p] * _LIFT**s) for s, r, a, p in self.pieces.spans(chars, lengths[which])]
            weight = np.zeros((min(PIECE_BYTES, width) + 1, n, width))
            for s, r, a, _, w in ways:
                weight[s][r, a] = w
            forward = np.zeros((n, width + 1))
            forward[:, 0] = 1
            for j in range(1, width + 1):
                for s in range(1, min(PIECE_BYTES, j) + 1):
                    forward[:, j] += forward[:, j - s] * weight[s][:, j - s]
            for s, r, a, p, w in ways:
                state.append(base[which[r]] + a + s)
                share.append(forward[r, a] * w / forward[r, a + s])
                size.append(np.full(len(r), s, np.int8))
                piece.append(p.astype(np.int32))
        if len(long):
            for out, more in zip((state, share, size, piece), self.long_ways(data, starts[long], lengths[long], base[long]), strict=True):
                out += more
        state, share, size, piece = map(np.concatenate, (state, share, size, piece))
        order = np.argsort(state, kind="stable")
        state, share, size, piece = state[order], share[order], size[order], piece[order]
        running = np.cumsum(share)
        first = np.flatnonzero(np.concatenate([[True], state[1:] != state[:-1]]))
        begun = np.concatenate([[0.0], running])[first]
        running -= np.repeat(begun, np.diff(np.append(first, len(state))))
        last = np.append(first[1:], len(state)) - 1
        running[last] = 1.0
        return base, state + np.minimum(running, 1.0), size, piece

    def long_ways(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, base: np.ndarray) -> tuple[list[np.ndarray], ...]:
        """State, share, length and piece of the ways of chunks of over PART_BYTES.

        What a stretch of PART_BYTES hands to the next are the sums that have reached its first PIECE_BYTES bytes, and the stretch is a
        linear map of what it is handed. The maps of many stretches are made at once; only handing on goes one by one. Each stretch is
        handed sums that add up to 1, so that no length leaves a double's range; a share across stretches has the factor back.
        """
        stretches = -(-lengths // PART_BYTES)
        of, nth = np.repeat(np.arange(len(lengths)), stretches), ranges(np.zeros(len(lengths), np.int64), stretches)
        begin, rest = starts[of] + nth * PART_BYTES, lengths[of] - nth * PART_BYTES
        last, first = rest <= PART_BYTES, np.cumsum(lengths + 1) - lengths - 1
        padded = np.concatenate([data, np.zeros(PART_BYTES + PIECE_BYTES, np.uint8)])
        forward, unit = np.empty(int((lengths + 1).sum())), np.eye(PIECE_BYTES)
        at, state, weight, factor, size, piece = [], [], [], [], [], []
        handed, local = unit[0], np.arange(PART_BYTES + 1)
        for low in range(0, len(of), _STRETCHES):
            part = slice(low, low + _STRETCHES)
            chars = padded[begin[part][:, None] + np.arange(PART_BYTES + PIECE_BYTES - 1)]
            m = len(chars)
            ways = []
            for s, r, a, p in self.pieces.spans(chars, rest[part]):
                own = a < PART_BYTES  # the others start in the next stretch
                ways.append((s, r[own], a[own], p[own], self.weights[p[own]] * _LIFT**s))
            step = np.zeros((m, PART_BYTES, PIECE_BYTES))
            for s, r, a, _, w in ways:
                step[r, a, s - 1] = w
            reach = np.zeros((m, PART_BYTES + PIECE_BYTES, PIECE_BYTES))
            reach[:, :PIECE_BYTES] = unit
            for i in range(PART_BYTES):
                reach[:, i + 1 : i + 1 + PIECE_BYTES] += step[:, i, :, None] * reach[:, i, None, :]
            given, scale = np.empty((m, PIECE_BYTES)), np.ones(m)
            for i in range(m):
                given[i] = handed = handed if nth[low + i] else unit[0]
                if not last[low + i]:
                    handed = (reach[i, PART_BYTES:] * handed).sum(1)
                    scale[i] = handed.sum()
                    handed = handed / scale[i]
            sums = (reach * given[:, None, :]).sum(2)
            place = first[of[part]] + nth[part] * PART_BYTES
            row, j = np.nonzero(local <= np.where(last[part], rest[part], PART_BYTES - 1)[:, None])
            forward[place[row] + j] = sums[row, j]
            for s, r, a, p, w in ways:
                at.append(place[r] + a + s)
                state.append(base[of[low + r]] + nth[low + r] * PART_BYTES + a + s)
                weight.append(sums[r, a] * w)
                factor.append(np.where((a + s >= PART_BYTES) & ~last[low + r], scale[r], 1.0))
                size.append(np.full(len(r), s, np.int8))
                piece.append(p.astype(np.int32))
        share = [w / (forward[i] * f) for w, i, f in zip(weight, at, factor, strict=True)]
        # By length, as in `lattice`: the ways of a state stand in the same order whichever stretches were worked on together.
        order = np.argsort(np.concatenate(size), kind="stable")
        return tuple([np.concatenate(x)[order]] for x in (state, share, size, piece))

    def encode(self, data: np.ndarray, at: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(pieces per row, pieces) of texts with a space in front, given as bytes and row offsets."""
        starts = np.flatnonzero(data == 0x20)
        lengths = np.diff(np.append(starts, len(data)))
        rows = np.searchsorted(at, starts, "right") - 1
        # A chunk's place in the text: a long one takes up as many numbers as it has stretches.
        room = -(-lengths // PART_BYTES)
        ahead = np.cumsum(room) - room
        nth = ahead - ahead[np.searchsorted(starts, at)[rows]]
        short, long = np.flatnonzero(lengths <= PART_BYTES), np.flatnonzero(lengths > PART_BYTES)
        _, one, like = np.unique(span_hashes(data, starts[short], lengths[short]), return_index=True, return_inverse=True)
        of = np.empty(len(starts), np.int64)
        of[short], of[long] = like, len(one) + np.arange(len(long))
        one = np.concatenate([short[one], long])
        base, shares, size, piece = self.lattice(data, starts[one], lengths[one])
        # Equal parts next to each other: the search below then walks the table in order.
        active = np.argsort(of, kind="stable")
        draw = mix(keys[rows] ^ mix(nth.astype(U64) + U64(self.seed << 40)))
        left, counts, taken = lengths.copy(), np.zeros(len(starts), np.int64), []
        step = 0
        while len(active) > _FEW or (len(active) and step < PART_BYTES):
            way = np.searchsorted(shares, base[of[active]] + left[active] + numbers(draw[active] + U64(step)), "right")
            taken.append((active, piece[way]))
            counts[active] += 1
            left[active] -= size[way]
            active = active[left[active] > 0]
            step += 1
        walked = [(i, self.walk(shares, size, piece, int(base[of[i]]), int(left[i]), draw[i], step)) for i in active.tolist()]
        for i, ids in walked:
            counts[i] += len(ids)
        ends = np.cumsum(counts)
        out = np.empty(int(ends[-1]) if len(ends) else 0, np.int32)
        for n, (which, ids) in enumerate(taken):
            out[ends[which] - 1 - n] = ids
        for i, ids in walked:
            out[ends[i] - step - len(ids) : ends[i] - step] = ids[::-1]
        return np.bincount(rows, counts, minlength=len(at) - 1).astype(np.int64), out

    @staticmethod
    def walk(shares: np.ndarray, size: np.ndarray, piece: np.ndarray, base: int, left: int, draw: np.uint64, step: int) -> np.ndarray:
        """The rest of one chunk backwards, from step `step` on: what `encode` does for many chunks at once."""
        ways = np.searchsorted(shares, base + np.arange(left + 2), "right")
        out: list[int] = []
        while left:
            for u in numbers(draw + np.arange(step + len(out), step + len(out) + _DRAWS).astype(U64)).tolist():
                way = bisect_right(shares, base + left + u, ways[left], ways[left + 1])
                out.append(way)
                left -= int(size[way])
                if not left:
                    break
        return piece[np.array(out, np.int64)]


def numbers(hashed: np.ndarray) -> np.ndarray:
    """Numbers from 0 to below 1, drawn by hash."""
    return (mix(hashed) >> U64(12)).astype(np.float64) * (1.0 - 2.0**-24) / 2.0**52


def spaced(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same texts with a space in front of each."""
    ahead = at + np.arange(len(at))
    out = np.empty(int(ahead[-1]), np.uint8)
    out[ahead[:-1]] = 0x20
    out[ranges(ahead[:-1] + 1, np.diff(at))] = data
    return out, ahead


def equal_rows(a: np.ndarray, a_at: np.ndarray, b: np.ndarray, b_at: np.ndarray) -> np.ndarray:
    """Whether each row, given as bytes and row offsets, is the same in both."""
    same = np.diff(a_at) == np.diff(b_at)
    if same.all():
        return per_row(a != b, b_at) == 0
    for i in np.flatnonzero(same):
        same[i] = np.array_equal(a[a_at[i] : a_at[i + 1]], b[b_at[i] : b_at[i + 1]])
    return same


def encode(
    docs: DataFrame, key: str = "doc_id", model: str | None = None, sharpness: float = 1.0, seed: int = 5, carried: tuple[str, ...] = ()
) -> DataFrame:
    """`key`, `carried` columns, `pieces` (array of ids), `n_pieces`, and `lossless`: whether the pieces decode to the text. Every
    row, in any order.

    Rows with the same key and text get the same pieces. A null key is a key like any other.
    """
    model = model or default_model()
    kept = [key, *carried]

    def make():
        sampler = PieceSampler(model, sharpness, seed)

        def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            data, at = text_bytes(batch.column("text"))
            keys = batch.column("__key").to_numpy().astype(np.int64).view(U64)
            for low, high in slices(at, 4 << 20):
                text, ahead = spaced(data[at[low] : at[high]], at[low : high + 1] - at[low])
                counts, ids = sampler.encode(text, ahead, keys[low:high])
                ends = np.concatenate([[0], np.cumsum(counts)])
                lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids))
                back = sampler.pieces.decode(ids)
                sizes = np.concatenate([[0], np.cumsum(sampler.pieces.sizes[ids])])[ends]
                same = equal_rows(back, sizes, text, ahead)
                columns = [*(batch.column(c).slice(low, high - low) for c in kept), lists, pa.array(counts), pa.array(same)]
                yield pa.RecordBatch.from_arrays(columns, [*kept, "pieces", "n_pieces", "lossless"])

        return step

    rows = docs.select(*kept, "text", F.xxhash64(F.col(key).cast("string")).alias("__key"))
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept)
    return arrow_map(rows, make, f"{kinds}, pieces array<int>, n_pieces long, lossless boolean")


def decode(encoded: DataFrame, key: str = "doc_id", model: str | None = None) -> DataFrame:
    """`key` and `text` from `pieces`."""
    model = model or default_model()

    def make():
        pieces = PieceTable(model)

        def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            texts = [pieces.decode(np.array(p, np.int64)).tobytes()[1:].decode() for p in batch.column("pieces").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(texts, pa.string())], ["key", "text"])

        return step

    kind = encoded.schema[key].dataType.simpleString()
    return arrow_map(encoded.select(F.col(key).alias("key"), "pieces"), make, f"key {kind}, text string").withColumnRenamed("key", key)


def op4_sampled_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"))
