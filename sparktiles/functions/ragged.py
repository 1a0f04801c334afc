"""Columns of byte strings in numpy: one flat buffer plus row offsets.

The tile codec works on whole Arrow batches with these; nothing here loops over rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenation of `arange(s, s + n)` for each pair."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    heads = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) + np.repeat(starts - heads, lengths)


def offsets_of(lengths: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])


# Bytes that are moved at a time: their places take sixteen times as much.
STEP_BYTES = 1 << 20


def _row_steps(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about STEP_BYTES each, one row at least."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + STEP_BYTES, "right")) - 1)
        yield a, b
        a = b


class Ragged:
    __slots__ = ("data", "offsets")

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets

    @property
    def lengths(self) -> np.ndarray:
        return np.diff(self.offsets)

    def __len__(self) -> int:
        return len(self.offsets) - 1

    @staticmethod
    def constant(value: bytes, n: int) -> Ragged:
        return Ragged(np.tile(np.frombuffer(value, np.uint8), n), np.arange(n + 1, dtype=np.int64) * len(value))

    @staticmethod
    def of(values: list[bytes]) -> Ragged:
        lengths = np.fromiter((len(v) for v in values), np.int64, len(values))
        return Ragged(np.frombuffer(b"".join(values), np.uint8), offsets_of(lengths))

    @staticmethod
    def from_arrow(arr: pa.Array) -> Ragged:
        """Strings or binaries; nulls become empty rows."""
        arr = arr.cast(pa.large_binary()).fill_null(b"")
        n = len(arr)
        if n == 0:
            return Ragged(np.zeros(0, np.uint8), np.zeros(1, np.int64))
        _, offs, data = arr.buffers()
        offsets = np.frombuffer(offs, np.int64, n + 1, arr.offset * 8)
        raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        return Ragged(raw[offsets[0] : offsets[-1]], offsets - offsets[0])

    @staticmethod
    def fixed(rows: np.ndarray) -> Ragged:
        """A two-dimensional byte array, one row each."""
        n, width = rows.shape
        return Ragged(rows.reshape(-1), np.arange(n + 1, dtype=np.int64) * width)

    @staticmethod
    def varints(values: np.ndarray) -> Ragged:
        """Each value as a base-128 varint."""
        v = values.astype(np.uint64)
        lengths = np.ones(len(v), np.int64)
        rest = v >> np.uint64(7)
        while rest.any():
            lengths += rest > 0
            rest = rest >> np.uint64(7)
        offsets = offsets_of(lengths)
        out = np.empty(offsets[-1], np.uint8)
        for k in range(int(lengths.max()) if len(v) else 0):
            live = lengths > k
            byte = (v[live] >> np.uint64(7 * k)).astype(np.uint8) & np.uint8(0x7F)
            more = (lengths[live] > k + 1).astype(np.uint8) << np.uint8(7)
            out[offsets[:-1][live] + k] = byte | more
        return Ragged(out, offsets)

    def take(self, rows: np.ndarray) -> Ragged:
        lengths, first = self.lengths[rows], self.offsets[:-1][rows]
        offsets = offsets_of(lengths)
        out = np.empty(offsets[-1], np.uint8)
        for a, b in _row_steps(offsets):
            out[offsets[a] : offsets[b]] = self.data[spans(first[a:b], lengths[a:b])]
        return Ragged(out, offsets)

    def where(self, keep: np.ndarray) -> Ragged:
        """Rows outside `keep` become empty."""
        if keep.all():
            return self
        lengths = np.where(keep, self.lengths, 0)
        return Ragged(self.data[np.repeat(keep, self.lengths)], offsets_of(lengths))

    def merge(self, bounds: np.ndarray) -> Ragged:
        """Join adjacent rows; `bounds` are row numbers, one more than there are groups."""
        return Ragged(self.data, self.offsets[bounds])

    def field(self, tag: int) -> Ragged:
        """Length-delimited protobuf field, per row."""
        return hstack(Ragged.constant(bytes([tag]), len(self)), Ragged.varints(self.lengths), self)

    def tolist(self) -> list[bytes]:
        raw, o = self.data.tobytes(), self.offsets.tolist()
        return [raw[a:b] for a, b in zip(o, o[1:])]

    def to_arrow(self) -> pa.Array:
        return pa.LargeBinaryArray.from_buffers(
            pa.large_binary(),
            len(self),
            [None, pa.py_buffer(np.ascontiguousarray(self.offsets, np.int64)), pa.py_buffer(np.ascontiguousarray(self.data))],
        ).cast(pa.binary())


def hstack(*columns: Ragged) -> Ragged:
    """Row-wise concatenation."""
    lengths = np.stack([c.lengths for c in columns])
    offsets = offsets_of(lengths.sum(axis=0))
    out = np.empty(offsets[-1], np.uint8)
    start = offsets[:-1].copy()
    steps = list(_row_steps(offsets))
    for c, n in zip(columns, lengths):
        for a, b in steps:
            out[spans(start[a:b], n[a:b])] = c.data[c.offsets[a] - c.offsets[0] : c.offsets[b] - c.offsets[0]]
        start += n
    return Ragged(out, offsets)


def vconcat(columns: list[Ragged]) -> Ragged:
    return Ragged(np.concatenate([c.data for c in columns]), offsets_of(np.concatenate([c.lengths for c in columns])))


def read_varints(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All varints of a buffer, and the byte position just past each."""
    if len(data) == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    ends = np.flatnonzero(data < 0x80) + 1
    if len(ends) == 0 or ends[-1] != len(data):
        raise ValueError("broken tile: a number goes on past the end of its bytes")
    starts = np.concatenate([[0], ends[:-1]])
    lengths = ends - starts
    if lengths.max() > 10:
        raise ValueError("broken tile: a number of more than ten bytes")
    out = np.zeros(len(ends), np.uint64)
    for k in range(int(lengths.max())):
        live = lengths > k
        out[live] |= (data[starts[live] + k] & np.uint8(0x7F)).astype(np.uint64) << np.uint64(7 * k)
    return out, ends
