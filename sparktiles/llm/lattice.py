"""Piece lattices of many words at once: which pieces of a fixed vocabulary span which bytes.

Words are rows of a byte matrix; step `l` looks up all spans of l bytes with a rolling hash in a sorted table. A span is
compared by its 64-bit hash; the vocabulary's own hashes are checked to be distinct when the table is built. Bytes that are no
piece by themselves are spanned by byte pieces, so every word has a segmentation.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from .common import U64, mix, ranges

#: Longest piece that is used, and the width of a lattice; a longer word takes several, which `pieces` joins and `langid` scores as parts.
PIECE_BYTES, PART_BYTES = 16, 64
_SEED, _STEP = U64(0xCBF29CE484222325), U64(0x100000001B3)


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class PieceTable:
    """Pieces of a sentencepiece model as byte strings, with the space in place of the word mark."""

    def __init__(self, model: str) -> None:
        import sentencepiece

        reader = sentencepiece.SentencePieceProcessor(model_file=model)
        self.size = reader.get_piece_size()
        self.bytes: list[bytes] = [b""] * self.size
        self.byte_ids = np.full(256, -1, np.int64)
        usable = []
        for i in range(self.size):
            piece = reader.id_to_piece(i)
            if reader.is_byte(i):
                value = int(piece[3:5], 16)
                self.bytes[i], self.byte_ids[value] = bytes([value]), i
            elif not (reader.is_control(i) or reader.is_unknown(i) or reader.is_unused(i)):
                self.bytes[i] = piece.replace("▁", " ").encode()
                if 0 < len(self.bytes[i]) <= PIECE_BYTES and b" " not in self.bytes[i][1:]:
                    usable.append(i)
        if (self.byte_ids < 0).any():
            raise ValueError(f"{model} has no piece for every byte")
        self.sizes = np.array([len(b) for b in self.bytes], np.int64)
        self.blob = np.frombuffer(b"".join(self.bytes), np.uint8)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)[:-1]])
        ids = np.array(usable)
        hashes = np.array([self._hash(self.bytes[i]) for i in usable], U64)
        order = np.argsort(hashes)
        self.hashes, self.ids = hashes[order], ids[order]
        if len(np.unique(hashes)) != len(hashes):
            raise ValueError("two pieces share a hash")
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(hashes >> U64(44)).astype(np.int64)] = True
        #: Place among equally weighted pieces: a vocabulary's order is the order in which its pieces were found useful.
        self.ranks = np.arange(self.size)

    @staticmethod
    def _hash(piece: bytes) -> int:
        h = np.array([_SEED])
        for b in piece:
            h = (h ^ U64(b)) * _STEP
        return int(mix(h)[0])

    def spans(self, chars: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(bytes, word, start, piece) of all pieces by length; byte pieces where a byte is no piece itself."""
        n, width = chars.shape
        h = np.full((n, width), _SEED)
        for size in range(1, min(PIECE_BYTES, width) + 1):
            last = width - size + 1
            h = (h[:, :last] ^ chars[:, size - 1 :].astype(U64)) * _STEP
            keys = mix(h)
            row, start = np.nonzero(self.maybe[(keys >> U64(44)).astype(np.int64)] & (np.arange(last) + size <= lengths[:, None]))
            keys = keys[row, start]
            place = np.minimum(np.searchsorted(self.hashes, keys), len(self.hashes) - 1)
            hit = self.hashes[place] == keys
            row, start, piece = row[hit], start[hit], self.ids[place[hit]]
            if size == 1:
                single = np.full((n, width), -1, np.int64)
                single[row, start] = piece
                row, start = np.nonzero(np.arange(width) < lengths[:, None])
                piece = single[row, start]
                piece = np.where(piece < 0, self.byte_ids[chars[row, start]], piece)
            yield size, row, start, piece

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """Bytes of the pieces, one after the other."""
        return self.blob[ranges(self.starts[ids], self.sizes[ids])]


def parts_of(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of words cut to PART_BYTES."""
    counts = -(-(ends - starts) // PART_BYTES)
    first = np.repeat(starts, counts) + ranges(np.zeros(len(starts), np.int64), counts) * PART_BYTES
    return first, np.minimum(np.repeat(ends, counts) - first, PART_BYTES)


def by_length(starts: np.ndarray, lengths: np.ndarray, data: np.ndarray, most: int = 20_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(which, byte matrix) of parts in groups of similar length, padded with zeros."""
    order = np.argsort(lengths, kind="stable")
    padded = np.concatenate([data, np.zeros(PART_BYTES, np.uint8)])
    low = 0
    while low < len(order):
        width = int(lengths[order[low]])
        width = next(w for w in (6, 8, 10, 12, 16, 24, 40, PART_BYTES) if w >= width)
        high = min(low + most, int(np.searchsorted(lengths[order], width, "right")))
        which = order[low:high]
        yield which, padded[starts[which][:, None] + np.arange(width)]
        low = high
