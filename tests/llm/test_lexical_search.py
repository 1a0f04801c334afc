"""Ranked search against scoring every document for every item."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from sparktiles.llm import lexical_search as ls

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, n string, terms string, score string, item string, `rank` string"


def split(text: str | None) -> list[str]:
    return [re.sub("[A-Z]", lambda c: c.group().lower(), t) for t in TERM.findall(text or "")]


def brute(docs: list[tuple], items: list[tuple], top: int) -> list[tuple]:
    counted = [(d, Counter(split(t))) for d, t in docs]
    n_docs, all_terms = sum(bool(c) for _, c in counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    wanted: dict[int, set[str]] = {}
    for i, text in items:
        if i is not None:
            wanted.setdefault(i, set()).update(split(text))
    out = []
    for i, terms in wanted.items():
        found = []
        for d, c in counted:
            n = sum(c.values())
            score = 0
            for t in terms & set(c):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * (10**9 * c[t] // (1000 * c[t] + 20 * (50 + 50 * n * n_docs // all_terms)))
            if score > 0:
                found.append((-score, d is None, d or 0, d))
        out += [(i, k + 1, d, -s) for k, (s, _, _, d) in enumerate(sorted(found)[:top])]
    return out


def corpus() -> tuple[list[tuple], list[tuple]]:
    draw = random.Random(8)
    words = [f"w{i}" for i in range(60)] + ["Été", "été", "naïve", "ÀB", "中文", "x" * 300, "a1", "A1"]
    prose = lambda n: "".join(draw.choice(words[: draw.choice([5, 20, 68])]) + draw.choice([" ", "-", "\n", "_", "'"]) for _ in range(n))
    docs: list[tuple] = [(i, prose(draw.randrange(0, 80))) for i in range(150)]
    docs += [(500 + i, docs[3][1]) for i in range(70)]  # ties
    docs += [docs[5], docs[5], (900, None), (901, ""), (902, "!!! ..."), (None, docs[3][1]), (None, "w1 w2"), (903, "w3 " * 30_000)]
    items: list[tuple] = [(i, prose(draw.randrange(1, 40))) for i in range(25)]
    items += [(30, items[0][1]), (31, None), (32, ""), (33, "unknown words only"), (None, "w1"), (34, "w1 w1 w2"), (34, "w7"), (35, "w1")]
    return docs, items


def collected(df) -> list[tuple]:
    return sorted((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect())


@pytest.mark.parametrize(("batch_terms", "cells"), [(200_000, 1 << 22), (60, 4000)])
def test_all_scores_agree(spark, batch_terms, cells, monkeypatch):
    monkeypatch.setattr(ls, "BLOCK_CELLS", cells)
    docs, items = corpus()
    left = spark.createDataFrame([(*d, None, "x", "y", None, "z") for d in docs], DOCS)
    right = spark.createDataFrame([(*i, "x") for i in items], "item_id int, text string, term string")
    got = ls.search(left, right, top=50, batch_terms=batch_terms)
    assert [f.dataType.simpleString() for f in got.schema] == ["int", "int", "bigint", "bigint"]
    assert collected(got) == sorted(brute(docs, items, 50))


def test_empty_tables(spark):
    docs, items = corpus()
    none, some = spark.createDataFrame([], DOCS), spark.createDataFrame(items, "item_id int, text string")
    assert ls.search(none, some).count() == 0
    assert ls.search(spark.createDataFrame([(1, "w1", None, None, None, None, None)], DOCS), some.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_nodes_hold_what_items_hold(seed):
    draw = np.random.default_rng(seed)
    held = draw.random((40, 30)) < draw.random(30)
    held[5] = held[6]
    item, term = np.nonzero(held)
    parts, left, node = ls.share(item, term, 30)
    sets = [frozenset([t]) for t in range(30)]
    for a, b in parts.tolist():
        assert not sets[a] & sets[b]
        sets.append(sets[a] | sets[b])
    for i in range(40):
        mine = [sets[n] for n in node[left == i].tolist()]
        assert sum(map(len, mine)) == held[i].sum() and frozenset().union(*mine) == set(np.flatnonzero(held[i]).tolist())
    assert len(parts) + len(node) < len(item)  # fewer sums than without sharing
    shared = [sum(n <= frozenset(np.flatnonzero(row).tolist()) for row in held) for n in sets[30:]]
    assert parts.size and min(shared) > 1


def test_terms_of_one_hash_are_told_apart(monkeypatch):
    vocabulary = ls.Vocabulary(["ab", "cde"])
    monkeypatch.setattr(ls, "span_hashes", lambda data, starts, lengths: np.full(len(starts), vocabulary.hashes[0]))
    data = np.frombuffer(b"ab ax cde", np.uint8)
    found = vocabulary.find(data, np.array([0, 3, 6]), np.array([2, 2, 3]))
    assert (found >= 0).sum() == 1
