"""Mined negatives against all pairs."""

from __future__ import annotations

import math

import numpy as np
import pytest

from sparktiles.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int, aid string, block string, cluster string, rank string"


def vectors(n: int = 260, width: int = 6) -> list[tuple]:
    draw = np.random.default_rng(3)
    centres = draw.normal(size=(7, width))
    rows = []
    for i in range(n):
        x = (centres[i % 7] + draw.normal(size=width) * 0.6) * draw.choice([0.2, 1.0, 2.0])
        rows.append((i, [float(np.float32(v)) for v in x], int(i % 7)))
    rows += [(1000 + i, [0.5] * width, 3) for i in range(40)]  # ties: one vector many times, anchors among them
    rows += [(2000, None, 1), (2050, [0.1] * width, None), (None, [0.1] * width, 1), (2100, [math.nan] * width, 1)]
    rows += [(2150, [math.inf] + [0.0] * (width - 1), 2), (2200, [None] + [1.0] * (width - 1), 2), (2250, [0.0] * width, 4), (2300, [], 5), (2350, [1.0, -1.0], 6)]
    return rows


def brute(rows: list[tuple]) -> list[tuple]:
    valid = []
    for v, x, label in rows:
        if v is None or label is None or x is None or any(c is None or not math.isfinite(c) for c in x):
            continue
        valid.append((v, (label + 1) % 10 if v % 7 == 0 else label, [math.floor(256 * c) for c in x]))
    score = lambda a, b: sum(p * q for p, q in zip(a, b))
    out = []
    for a, label, q in valid:
        if a % 50:
            continue
        same = sorted((-score(q, r), v) for v, k, r in valid if k == label and v != a)[:5]
        others = sorted((-score(q, r), v) for v, k, r in valid if k != label)
        for minus, p in same:
            fit = [(v, -s) for s, v in others if 50 * -minus <= 100 * -s <= 95 * -minus][:3]
            out += [(a, p, i + 1, v, -minus, s) for i, (v, s) in enumerate(fit)]
    return sorted(out)


def collected(df) -> list[tuple]:
    return sorted((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in df.collect())


@pytest.mark.parametrize(("group_rows", "block_rows"), [(1 << 14, 1 << 16), (2, 40)])
def test_all_pairs_agree(spark, group_rows, block_rows):
    rows = vectors()
    df = spark.createDataFrame([(*r, "x", None, "y", "z") for r in rows], SCHEMA)
    want = brute(rows)
    assert len(want) > 40
    assert collected(hn.mine(df, group_rows=group_rows, block_rows=block_rows)) == want


def test_short_stretches_stop_early_and_lose_nothing(monkeypatch):
    monkeypatch.setattr(hn, "STRETCH", 8)
    draw = np.random.default_rng(5)
    candidates = np.floor(256 * draw.normal(size=(900, 4)) * draw.choice([0.1, 1, 3], size=(900, 1)))
    members = candidates[:40]
    ids, norms = np.arange(900), np.linalg.norm(candidates, axis=1)
    centres = hn.fit_centres(members, 4)
    own = (hn._unit(members) @ centres.T).argmax(axis=1)
    seen = []
    monkeypatch.setattr(hn, "inner", lambda a, b, f=hn.inner: seen.append(a.shape[0] * b.shape[0]) or f(a, b))
    for c in np.unique(own):
        rows = np.flatnonzero(own == c)
        lists = hn.Lists(ids, candidates, hn.cosine_limit(centres[c], members[rows], candidates, norms))
        best = hn.walk_positives(rows, members[rows], lists)
        for k, r in enumerate(rows):
            order = sorted((-int(candidates[r] @ candidates[v]), v) for v in ids if v != r)[:5]
            assert list(zip((-best.score[k]).tolist(), best.id[k].tolist(), strict=True)) == order
    assert sum(seen) < 0.7 * 40 * 900  # members did stop before the end of their lists


def test_empty_and_too_large(spark):
    assert hn.mine(spark.createDataFrame([], SCHEMA)).count() == 0
    alone = spark.createDataFrame([(50, [1.0], 1, None, None, None, None)], SCHEMA)
    assert hn.mine(alone).count() == 0
    huge = spark.createDataFrame([(i, [1e12, 1.0], 1, None, None, None, None) for i in (50, 51)], SCHEMA)
    with pytest.raises(Exception, match="too large"):
        hn.mine(huge).collect()


def test_a_repeated_anchor_is_one_and_repeated_candidates_are_rows(spark):
    rows = [(50, [1.0, 0.0], 1), (50, [1.0, 0.0], 1), (51, [1.0, 0.0], 1), (52, [0.8, 0.0], 2), (52, [0.8, 0.0], 2)]
    got = collected(hn.mine(spark.createDataFrame([(*r, None, None, None, None) for r in rows], SCHEMA)))
    assert [g[:4] for g in got] == [(50, 51, 1, 52), (50, 51, 2, 52)]
