"""Lines cut segment by segment: what `shapes` does to rings, in flat columns, without moving vertices once per box side."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np

from .ragged import offsets_of
from .shapes import EXTENT, LINE, Shapes


@dataclass
class Segments:
    """Segments of the lines of many pieces, by piece and along each line."""

    ends: tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]  # x and y of the first vertex, x and y of the second, world units
    head: np.ndarray  # begins a line; others go on where the segment before ends
    piece: np.ndarray

    def __len__(self) -> int:
        return len(self.piece)

    def take(self, rows: np.ndarray | slice) -> Segments:
        return Segments(tuple(c[rows] for c in self.ends), self.head[rows], self.piece[rows])

    def shapes(self) -> Shapes:
        at, first = self._places()
        xy = np.empty((len(self) + len(first), 2))
        for axis in (0, 1):
            xy[at, axis] = self.ends[axis + 2]
            xy[at[first] - 1, axis] = self.ends[axis][first]
        n = len(first)
        off = np.append(at[first] - 1, len(xy))
        return Shapes(xy, off, self.piece[first], np.full(n, LINE), np.zeros(n, np.int64), np.zeros(n, bool))

    def _places(self) -> tuple[np.ndarray, np.ndarray]:
        """Where second vertices are among all vertices, and the segments that begin a line."""
        return np.arange(len(self)) + np.cumsum(self.head), np.flatnonzero(self.head)


def segments_of(s: Shapes) -> Segments:
    """Of lines with two vertices at least, in piece order."""
    begin, last = np.zeros(len(s.xy), bool), np.zeros(len(s.xy), bool)
    begin[s.off[:-1]], last[s.off[1:] - 1] = True, True
    at = np.flatnonzero(~last)
    ends = tuple(np.ascontiguousarray(s.xy[at + k, axis]) for k in (0, 1) for axis in (0, 1))
    return Segments(ends, begin[at], np.repeat(s.piece, s.sizes - 1))


def regroup(g: Segments, cols: list[np.ndarray], limit: int) -> Iterator[tuple[Segments, list[np.ndarray]]]:
    """Runs of pieces with about `limit` segments each."""
    first = np.flatnonzero(_begins(g.piece))
    block = np.append(first, len(g))[1:] // limit
    heads = np.flatnonzero(_begins(block))
    for a, z in zip(heads, np.append(heads[1:], len(first))):
        part = g.take(slice(first[a], first[z] if z < len(first) else len(g)))
        part.piece = part.piece - a
        yield part, [c[a:z] for c in cols]


def _begins(keys: np.ndarray) -> np.ndarray:
    out = np.ones(len(keys), bool)
    np.not_equal(keys[1:], keys[:-1], out=out[1:])
    return out


@dataclass
class _Cut:
    """Segments on their way into one box: `row` is the segment they come from, `moved` says that an end was cut off."""

    ends: list[np.ndarray]
    head: np.ndarray
    row: np.ndarray
    moved: np.ndarray

    def side(self, axis: int, bounds: np.ndarray, sign: int) -> _Cut:
        """Keep where sign * (v - bound) >= 0; `bounds` is per segment they come from. As `shapes._cut` does it, to the last bit."""
        bound = bounds[self.row]
        da, dc = self.ends[axis] - bound, self.ends[axis + 2] - bound
        return self._without(axis, bound, da, dc, *((da < 0, dc < 0) if sign > 0 else (da > 0, dc > 0)))

    def halves(self, axis: int, bounds: np.ndarray) -> tuple[_Cut, _Cut]:
        """Both sides of a bound; what lies on it is on both."""
        bound = bounds[self.row]
        da, dc = self.ends[axis] - bound, self.ends[axis + 2] - bound
        return self._without(axis, bound, da, dc, da > 0, dc > 0), self._without(axis, bound, da, dc, da < 0, dc < 0)

    def _without(self, axis: int, bound: np.ndarray, da: np.ndarray, dc: np.ndarray, far_a: np.ndarray, far_c: np.ndarray) -> _Cut:
        """Without the `far` ends, which lie beyond the bound; `da` and `dc` are the distances of all ends to it."""
        if not far_a.any() and not far_c.any():
            return self
        rows = np.flatnonzero(~(far_a & far_c))
        out = _Cut([e[rows] for e in self.ends], self.head[rows], self.row[rows], self.moved[rows])
        for far, end in ((far_a, 0), (far_c, 2)):
            at = np.flatnonzero(far[rows])
            if len(at):
                old = rows[at]
                d = da[old]
                p, q = self.ends[1 - axis][old], self.ends[3 - axis][old]
                out.ends[end + 1 - axis][at] = p + (q - p) * (d / (d - dc[old]))
                out.ends[end + axis][at] = bound[old]
                out.moved[at] = True
                if end == 0:
                    out.head[at] = True
        return out


def _boxes(g: Segments, whole: _Cut, side: float, tx: np.ndarray, ty: np.ndarray, grow: float) -> Iterator[tuple[int, int, _Cut]]:
    """What each of the four children holds. Without a buffer the middle is the only bound that cuts: a tile's edge is a multiple of
    its side, and a point between two ends that are not beyond it is rounded to one that is not either."""
    if not grow:
        mid = [((2 * t + 1) * side)[g.piece] for t in (tx, ty)]
        for i, column in enumerate(whole.halves(0, mid[0])):
            for j, cut in enumerate(column.halves(1, mid[1])):
                yield i, j, cut
        return
    low, high = ([[((2 * t + i + k) * side + (2 * k - 1) * grow)[g.piece] for i in (0, 1)] for t in (tx, ty)] for k in (0, 1))
    for i in (0, 1):
        column = whole.side(0, low[0][i], 1).side(0, high[0][i], -1)
        for j in (0, 1):
            yield i, j, column.side(1, low[1][j], 1).side(1, high[1][j], -1)


def split(g: Segments, zoom: int, tx: np.ndarray, ty: np.ndarray, buffer: int) -> tuple[Segments, np.ndarray, np.ndarray, np.ndarray]:
    """The pieces of the four child tiles at `zoom`, as `shapes.split` gives them: segments, source piece, tile x, tile y."""
    side = float(1 << (32 - zoom))
    grow = buffer * side / 256
    line = np.cumsum(g.head) - 1
    sizes = np.bincount(line)
    n = len(g)
    whole = _Cut(list(g.ends), g.head, np.arange(n), np.zeros(n, bool))
    made, source, cx, cy = [], [], [], []
    base = 0
    for i, j, cut in _boxes(g, whole, side, tx, ty, grow):
        if not len(cut.row):
            continue
        piece, own = g.piece[cut.row], line[cut.row]
        # Of a piece, lines that the child holds whole come before those it holds parts of.
        parted = np.bincount(own, minlength=len(sizes)) != sizes
        parted[own[cut.moved]] = True
        late = parted[own]
        ends, head = cut.ends, cut.head
        if (late[:-1] & ~late[1:] & (piece[1:] == piece[:-1])).any():
            order = np.argsort(piece * 2 + late, kind="stable")
            ends, head, piece = [e[order] for e in ends], head[order], piece[order]
        begins = _begins(piece)
        used = piece[begins]
        made.append(Segments(tuple(ends), head, np.cumsum(begins) + (base - 1)))
        source.append(used)
        cx.append(2 * tx[used] + i)
        cy.append(2 * ty[used] + j)
        base += len(used)
    if not made:
        none = np.zeros(0, np.int64)
        return g.take(none), none, none, none
    joined = Segments(
        tuple(np.concatenate([m.ends[k] for m in made]) for k in range(4)),
        np.concatenate([m.head for m in made]),
        np.concatenate([m.piece for m in made]),
    )
    return joined, np.concatenate(source), np.concatenate(cx), np.concatenate(cy)


def quantise(g: Segments, zoom: int, tx: np.ndarray, ty: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lines on the tile grid as `shapes.quantise` gives them: vertices, line -> vertex offsets, line -> piece."""
    side = float(1 << (32 - zoom))
    at, first = g._places()
    start = at[first] - 1
    place = np.empty(len(g) + len(first), np.int64)  # both numbers of a vertex as one
    origins = [(t * side)[g.piece] for t in (tx, ty)]
    place[at] = _on_grid(g.ends[2:], origins, side)
    place[start] = _on_grid([e[first] for e in g.ends[:2]], [o[first] for o in origins], side)
    keep = _begins(place)
    keep[start] = True
    sizes = np.add.reduceat(keep, start, dtype=np.int64)
    lines = g.piece[first]
    ok = sizes >= 2
    if not ok.all():
        keep &= np.repeat(ok, np.diff(np.append(start, len(place))))
        sizes, lines = sizes[ok], lines[ok]
    return place[keep].view(np.int32).reshape(-1, 2), offsets_of(sizes), lines


def _on_grid(xy: Sequence[np.ndarray], origins: list[np.ndarray], side: float) -> np.ndarray:
    out = np.empty((len(xy[0]), 2), np.int32)
    for axis in (0, 1):
        v = xy[axis] - origins[axis]
        v *= EXTENT / side
        out[:, axis] = np.floor(v, out=v)
    return out.view(np.int64)[:, 0]
