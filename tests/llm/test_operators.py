"""The training-data operators against brute force, on a small corpus that has every awkward kind of row."""

from __future__ import annotations

import hashlib
import math
import random
import struct
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparktiles.llm import fingerprints, graph_dedup, langid, mixing, neardup, pieces, quality, suffix_dedup, token_files, toxicity
from sparktiles.llm.common import Words, fold, gram_places, grams, span_hashes, text_bytes
from sparktiles.llm.lattice import PieceTable, default_model

SPACE = " \t\n\x0b\x0c\r"

#: Columns with names that operators use for themselves.
SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        *(T.StructField(c, T.StringType()) for c in ("id", "key", "band", "rate", "size", "score", "tag", "start", "n", "place", "pivot", "edge", "part")),
    ]
)
LABELS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("quality", T.IntegerType()), T.StructField("toxic", T.IntegerType())])

WORDS = {"xx": "alpha beta gamma delta omega sigma kappa lambda".split(), "yy": "uno dos tres quatro cinco seis siete ocho".split()}


def split(text: str | None) -> list[str]:
    for c in SPACE:
        text = (text or "").replace(c, " ")
    return [w for w in text.split(" ") if w]


def corpus() -> list[tuple]:
    draw = random.Random(4)
    prose = lambda lang, n: " ".join(draw.choice(WORDS[lang]) + draw.choice(["", "", str(draw.randrange(99)), ","]) for _ in range(n))
    texts: list[tuple[int | None, str | None, str | None, str | None]] = []
    for i in range(60):
        lang = "xx" if i % 3 else "yy"
        texts.append((i * 3, prose(lang, draw.randrange(3, 180)), lang, f"s{i % 4}" if i % 7 else None))
    shared = prose("xx", 60)
    for i in range(12):
        texts.append((500 + i, prose("xx", draw.randrange(0, 30)) + " " + shared + "\n" + prose("yy", 12), "xx", "s1"))
    base = prose("xx", 150).split()
    for i in range(25):  # edited copies
        copy = list(base)
        for _ in range(i % 4):
            copy[draw.randrange(len(copy))] = f"edit{draw.randrange(1000)}"
        texts.append((600 + i, " ".join(copy), "xx", "s2"))
    texts += [(700, texts[0][1], "yy", "s0"), (2, texts[0][1], "yy", "s0"), (701, texts[5][1], "xx", "s3")]  # copies
    texts += [texts[10], texts[10]]  # repeated rows
    texts += [(800, None, None, None), (801, "", "xx", "s1"), (802, " \n\t ", "yy", None), (803, "x", "xx", "s1"), (804, "  two  spaces ", "xx", "s1")]
    texts += [(None, "no id " + shared, "xx", "s1"), (None, None, None, "s1"), (None, None, None, "s1")]
    texts += [(810, "ab" * 3000, "xx", "s1"), (811, "a" * 500, "xx", "s1"), (812, "á▁\U0001f600世́ " * 90, "yy", "s2"), (813, "7 8 9 10!", "yy", "s2")]
    texts += [(820, prose("yy", 9000), "yy", "s3"), (821, ("one line of five words\n" * 30), "xx", "s3"), (822, "a b " * 40, "xx", "s3")]
    draw.shuffle(texts)
    return [(d, t, lang, s, len(t or ""), *["clash"] * 13) for d, t, lang, s in texts]


ROWS = corpus()
ORDERED = sorted(((d if d is not None else 1 << 62, t or "") for d, t, *_ in ROWS), key=lambda x: x[0])


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(5).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(d, 0 if "a b a b" in (t or "") else 1, 1 if "edit" in (t or "") else 0) for d, t, *_ in ROWS]
    return spark.createDataFrame([*rows, (None, 1, 1), (0, None, None), (9999, 1, 1)], LABELS)


def rows_of(df) -> Counter:
    return Counter(tuple(bytes(v) if isinstance(v, bytearray) else v for v in r) for r in df.collect())


# --- Helpers -----------------------------------------------------------------------------------------------------------


def test_words_and_hashes_of_batches():
    texts = ["", "a", " a  bc\n", None, "d", "éa\x0b\x1cz " * 3]
    data, at = text_bytes(pa.array(texts).slice(0))
    words = Words(data, at)
    found = [bytes(data[a:b]).decode() for a, b in zip(words.starts, words.ends)]
    assert found == [w for t in texts for w in split(t)]
    assert words.counts.tolist() == [len(split(t)) for t in texts]
    hashes = words.hashes()
    assert hashes[0] == hashes[1] != hashes[2]
    assert len(gram_places(words.offsets, 2)) == sum(max(0, len(split(t)) - 1) for t in texts)
    assert len(grams(hashes, 99)) == 0
    long = np.frombuffer(b"0123456789abcdefg" * 2, np.uint8)
    h = span_hashes(long, np.array([0, 17, 1]), np.array([17, 17, 16]))
    assert h[0] == h[1] != h[2]
    sliced, cuts = text_bytes(pa.array(["xx", "yyy", None, "z"]).slice(1, 3))
    assert bytes(sliced) == b"yyyz" and cuts.tolist() == [0, 3, 3, 4]


# --- 1 -----------------------------------------------------------------------------------------------------------------


def test_fingerprints(docs, none):
    ordered = sorted(((d, t or "") for d, t, *_ in ROWS), key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode()))
    expected = Counter()
    for (d, own), (_, after) in zip(ordered, ordered[1:] + ordered[:1]):
        q = len(own) // 4
        expected[(d, len(own), hashlib.sha256((own[: len(own) - q] + after[:q]).encode()).hexdigest())] += 1
    got = fingerprints.compare_with_edited(docs).collect()
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == expected
    by_text: dict = {}
    texts = {d: t or "" for d, t, *_ in ROWS if d is not None}
    for r in got:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        if r.doc_id is not None:
            assert by_text.setdefault(texts[r.doc_id], r.fingerprint) == r.fingerprint
    assert fingerprints.compare_with_edited(none).count() == 0
    assert fingerprints.compare_with_edited(docs.filter("doc_id = 803")).first().near_next == 1.0
    assert {r.fingerprint for r in fingerprints.fingerprints(docs).collect()} == {r.fingerprint for r in got}


def test_order_min_hash_sees_order_and_repeats():
    hasher = fingerprints.OrderMinHash(k=1, sketches=256)
    words = [f"w{i}" for i in range(60)]
    shuffled = random.Random(1).sample(words, len(words))
    a, b, c, d = hasher.of([" ".join(x).encode() for x in (words, shuffled, words[:45] + ["n"] * 15, words * 2)])
    like = lambda x, y: (x == y).mean()
    assert 0.3 < like(a, b) < 0.7  # the same set in another order: about half of the pairs keep theirs
    assert 0.25 < like(a, c) < 0.5  # both smallest among the 45 of 75 that are shared: 0.36
    assert like(a, d) < 0.6  # occurrences are numbered


def test_long_texts_are_sketched_in_blocks():
    text = " ".join(f"w{i % 3000}" for i in range(3 * fingerprints.BLOCK)).encode()
    whole = fingerprints.OrderMinHash()
    kmers = grams(Words(np.frombuffer(text, np.uint8), np.array([0, len(text)])).hashes(), fingerprints.K)
    numbered = fingerprints.mix(kmers + fingerprints._occurrences(kmers, np.zeros(len(kmers), int)) * np.uint64(0x9E3779B97F4A7C15))
    expected = [np.sort(np.argsort(numbered * f, kind="stable")[:2]) for f in whole.functions]
    at_once = (fingerprints.mix((fingerprints.mix(kmers[np.array(expected)]) * whole.places).sum(axis=1, dtype=np.uint64)) >> np.uint64(48)).astype(np.uint16)
    assert (whole.of([text])[0] == at_once).all()


# --- 2 -----------------------------------------------------------------------------------------------------------------


def covered_bytes(rows: list[tuple[int, str]], w: int = 100) -> Counter:
    """By the definition, over distinct (id, text): every start of every string."""
    first: dict[bytes, tuple] = {}
    unique = sorted({(d, hashlib.sha256(t.encode()).digest(), t) for d, t in rows})
    marks = {}
    for n, (d, _, t) in enumerate(unique):
        raw = t.encode()
        mark = bytearray(len(raw))
        for p in range(len(raw) - w + 1):
            if first.setdefault(raw[p : p + w], (n, p)) != (n, p):
                mark[p : p + w] = b"\1" * w
        marks[d, t] = raw, mark
    out = Counter()
    for d, t in rows:
        raw, mark = marks[d, t]
        spans = sum(1 for i, m in enumerate(mark) if m and not (i and mark[i - 1]))
        kept = bytes(b for b, m in zip(raw, mark) if not m)
        out[(d, len(raw), sum(mark), spans, hashlib.sha256(kept).hexdigest())] += 1
    return out


def test_suffix_dedup(docs, none):
    got = Counter((d if d is not None else 1 << 62, *rest) for d, *rest in rows_of(suffix_dedup.removal_report(docs)).elements())
    assert got == covered_bytes(ORDERED)
    assert suffix_dedup.removal_report(none).count() == 0
    cut = suffix_dedup.without_repeats(docs)
    assert cut.columns == docs.columns and cut.count() == len(ROWS)
    assert cut.filter("doc_id = 803").first().text == "x"
    assert cut.filter("doc_id = 800").first().text is None


@pytest.mark.parametrize("seed", range(4))
def test_multikey_sort(seed):
    draw = np.random.default_rng(seed)
    data = draw.integers(0, 2 if seed else 1, 400).astype(np.uint8)
    starts = draw.integers(0, 380, 120)
    lengths = np.minimum(draw.integers(0, 60, 120), len(data) - starts)
    order, common = suffix_dedup.multikey_sort(data, starts, lengths)
    strings = [data[a : a + n].tobytes() for a, n in zip(starts, lengths)]
    ordered = [strings[i] for i in order]
    assert ordered == sorted(strings)
    for i in range(1, len(ordered)):
        n = next((j for j, (x, y) in enumerate(zip(ordered[i - 1], ordered[i])) if x != y), min(len(ordered[i - 1]), len(ordered[i])))
        assert common[i] == n


# --- 3 -----------------------------------------------------------------------------------------------------------------


def test_toxicity_learns_pairs():
    draw = random.Random(2)
    lists, labels = [], []
    for _ in range(3000):  # features 0 and 1 are toxic together only
        x = [f for f in (0, 1) if draw.random() < 0.5] + [2 + draw.randrange(20)]
        lists.append(np.array(sorted(set(x))))
        labels.append(float(0 in x and 1 in x))
    bias, weights, factors = toxicity.fit_machine(lists, np.array(labels), 22)
    machine = toxicity.Machine(np.arange(22), bias, weights, factors)
    score = lambda *f: machine.score(np.zeros(len(f), int), np.array(f, int), 1)[0]
    assert score(0, 1, 5) > 0.8 > 0.3 > max(score(0, 5), score(1, 5), score(5))
    assert 2 * score() < 1


def test_toxicity(docs, none, labels, spark):
    train = toxicity.labelled(labels)
    assert train.filter("doc_id IS NULL").count() == 0 and train.count() == train.select("doc_id").distinct().count()
    machine = toxicity.fit(docs, train)
    got = toxicity.score(docs, machine).collect()
    assert len(got) == len(ROWS) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    truth = {d: "edit" in (t or "") for d, t, *_ in ROWS}
    assert np.mean([truth[r.doc_id] == bool(r.predicted) for r in got]) > 0.9
    kept = toxicity.without_toxic(docs, machine)
    assert kept.columns == docs.columns
    assert kept.count() == sum(1 - r.predicted for r in got)
    assert toxicity.score(none, machine).count() == 0
    unlearned = toxicity.fit(none, train)
    assert {r.predicted for r in toxicity.score(docs, unlearned).collect()} == {0}
    assert toxicity.fit(docs, train).weights.tolist() == machine.weights.tolist()


# --- 4 -----------------------------------------------------------------------------------------------------------------


def test_pieces(docs, none):
    got = pieces.encode(docs, carried=("lang", "id"))
    assert got.columns == ["doc_id", "lang", "id", "pieces", "n_pieces", "lossless"]
    again = pieces.encode(docs.repartition(2), carried=("lang", "id"))
    key = lambda r: (r.doc_id, tuple(r.pieces), r.n_pieces, r.lossless)
    assert Counter(map(key, got.collect())) == Counter(map(key, again.collect()))
    assert all(r.lossless and r.n_pieces == len(r.pieces) for r in got.collect())
    assert Counter((r.doc_id, r.text) for r in pieces.decode(got).collect()) == Counter((d, t or "") for d, t, *_ in ROWS)
    assert pieces.encode(none).count() == 0


def test_sampled_segmentations_have_their_shares():
    sampler = pieces.PieceSampler(default_model())
    known = {b: i for i, b in enumerate(sampler.pieces.bytes) if 0 < len(b) <= 16}
    text = b" order"

    def ways(at: int):
        if at == len(text):
            yield ()
        for size in range(1, len(text) - at + 1):
            if (piece := known.get(text[at : at + size])) is not None:
                yield from ((piece, *rest) for rest in ways(at + size))

    weight = {w: math.prod(sampler.weights[p] for p in w) for w in ways(0)}
    n = 30_000
    data, at = pieces.spaced(np.frombuffer(b"order" * n, np.uint8), np.arange(n + 1) * 5)
    counts, ids = sampler.encode(data, at, np.arange(n, dtype=np.uint64))
    found = Counter(tuple(x.tolist()) for x in np.split(ids, np.cumsum(counts)[:-1]))
    assert set(found) <= set(weight)
    total = sum(weight.values())
    for way, w in weight.items():
        p = w / total
        assert abs(found[way] / n - p) < 5 * math.sqrt(p / n) + 1e-4


def test_long_words_are_one_lattice(monkeypatch):
    sampler = pieces.PieceSampler(default_model())
    words = [(b"ordering/" * 300)[:n] for n in (63, 64, 65, 127, 128, 129, 900)] + ["Größenordnung".encode() * 40]
    known = {b: i for i, b in enumerate(sampler.pieces.bytes) if 0 < len(b) <= 16}
    data = np.frombuffer(b"".join(b" " + w for w in words), np.uint8)
    sizes = np.array([len(w) + 1 for w in words])
    starts = np.cumsum(sizes) - sizes
    base, shares, size, piece = sampler.lattice(data, starts, sizes)
    state = np.ceil(shares).astype(np.int64) - 1
    shares = shares - np.maximum(state, np.concatenate([[0.0], shares[:-1]]))
    for word, low in zip(words, base.tolist(), strict=False):
        text = b" " + word
        sums = [1.0]
        for end in range(1, len(text) + 1):
            ways = {s: p for s in range(1, min(16, end) + 1) if (p := known.get(text[end - s : end], sampler.pieces.byte_ids[text[end - 1]] if s == 1 else None)) is not None}
            weights = {s: sums[end - s] * sampler.weights[p] * 16.0**s for s, p in ways.items()}
            sums.append(sum(weights.values()))
            mine = np.flatnonzero(state == low + end)
            assert {s: int(ways[s]) for s in ways} == dict(zip(size[mine].tolist(), piece[mine].tolist(), strict=True))
            assert np.allclose(shares[mine], [weights[s] / sums[-1] for s in size[mine].tolist()], atol=1e-9)
    # Pieces lie across the places where long words used to be cut, every word decodes, and a chunk walked alone gets what many get at once.
    n = 40
    text, at = pieces.spaced(np.frombuffer(words[-1] * n, np.uint8), np.arange(n + 1) * len(words[-1]))
    keys = np.arange(n, dtype=np.uint64)
    counts, ids = sampler.encode(text, at, keys)
    ends = np.cumsum(sampler.pieces.sizes[ids])
    assert sampler.pieces.decode(ids).tobytes() == text.tobytes()
    cuts = (at[:-1, None] + np.arange(64, len(words[-1]), 64)).reshape(-1)
    assert not np.isin(cuts, ends).all()
    for few, draws in ((0, 1), (n, 7), (n - 3, 4096)):
        monkeypatch.setattr(pieces, "_FEW", few)
        monkeypatch.setattr(pieces, "_DRAWS", draws)
        monkeypatch.setattr(pieces, "_STRETCHES", draws)
        assert [x.tolist() for x in sampler.encode(text, at, keys)] == [counts.tolist(), ids.tolist()]


def test_piece_table_spans_every_byte():
    table = PieceTable(default_model())
    chars = np.frombuffer(b"\xf0\x9f\x98\x80ab", np.uint8)[None, :]
    singles = next(iter(table.spans(chars, np.array([6]))))
    assert singles[2].tolist() == list(range(6))
    assert table.decode(singles[3]).tobytes() == chars.tobytes()


# --- 5 -----------------------------------------------------------------------------------------------------------------


def test_quality_counts(docs, none, labels):
    expected = Counter()
    for d, t, *_ in ROWS:
        words, seen, twice = split(t), set(), 0
        for line in (t or "").split("\n"):
            if split(line):
                twice += line in seen
                seen.add(line)
        windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        many = {w for w, n in Counter(windows).items() if n > 1}
        repeated = {j for i, w in enumerate(windows) if w in many for j in range(i, i + 3)}
        failed = len(words) < 50 or 100 * len(repeated) > 50 * len(words)
        expected[(d, len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t or ""), twice, len(repeated), failed)] += 1
    got = quality.quality(docs, labels).collect()
    names = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert Counter(tuple(r[c] for c in names) for r in got) == expected
    assert not any(r.kept and r.base_failed for r in got) and any(r.kept for r in got)
    assert quality.quality(none, labels).count() == 0
    assert not any(r.base_failed is None or r.kept is None for r in quality.quality(docs, labels.limit(0)).collect())


def test_quality_learns_from_every_trusted_document(spark):
    """More than the 50,000 that a sample once held: each document has a word of its own, and all are counted."""
    n = 60_000
    labels = spark.range(n).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"))
    trusted = quality.trusted_ids(labels)
    assert trusted.count() == n
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.concat(F.lit("w"), "id").alias("text")).join(trusted, "doc_id")
    sums = quality.count_buckets(docs, docs).agg(F.sum("n_raw"), F.sum("n_target")).first()
    assert tuple(sums) == (n, trusted.filter("NOT __held").count())


def test_ranks_by_counting(spark, monkeypatch):
    monkeypatch.setattr(quality, "LEFT", 3)
    monkeypatch.setattr(quality, "STRETCHES", 4)
    values = [((i * 37) % 50) / 7 - 3 for i in range(150)] + [2.5] * 20
    rows = spark.createDataFrame([(v,) for v in values], "score double")
    assert [quality.ranked(rows, r) for r in (0, 1, 83, 169)] == [sorted(values)[r] for r in (0, 1, 83, 169)]


def test_quality_ratio(spark):
    counts = spark.createDataFrame([(1, 90, 10), (2, 10, 0)], "bucket long, n_raw long, n_target long")
    ratios = quality.log_ratios(counts)
    size, s = 1 << quality.BUCKET_BITS, quality.SMOOTHING
    p = lambda n, total: math.log((n + s) / (total + s * size))
    assert ratios[1] == pytest.approx(p(10, 10) - p(90, 100)) and ratios[2] == pytest.approx(p(0, 10) - p(10, 100))
    assert ratios[3] > ratios[1] > ratios[2]


# --- 6 -----------------------------------------------------------------------------------------------------------------


def filled(sizes: dict, weights=(5, 2, 1)) -> dict:
    """Targets by sharing again and again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    budget, out, open_ = 1.5 * sum(sizes.values()), {}, set(order)
    while open_:
        level = budget / sum(weight[s] for s in open_)
        over = {s for s in open_ if weight[s] * level > 2 * sizes[s]}
        if not over:
            return out | {s: weight[s] * level for s in open_}
        for s in over:
            out[s] = 2.0 * sizes[s]
            budget -= 2 * sizes[s]
        open_ -= over
    return out


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, "c": 5, None: 70}, {"a": 0}, {"a": 0, "b": 7}, {"é": 3, "z": 3, "Z": 3}, {"a": 500, "b": 3, "c": 4, "d": 5}])
def test_targets(spark, sizes):
    rows = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    got = {r.source: r for r in mixing.targets(rows).collect()}
    for s, target in filled(sizes).items():
        assert got[s].target == pytest.approx(target) and got[s].source_size == sizes[s]
        assert got[s].rate <= 2


def test_mix(docs, none):
    sizes = docs.select("doc_id", "source", mixing.word_count("text").alias("size"))
    assert Counter((r.doc_id, r.size) for r in sizes.collect()) == Counter((d, len(split(t))) for d, t, *_ in ROWS)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    got = Counter((r.doc_id, r.text) for r in mixed.collect())
    assert got == Counter((r.doc_id, r.text) for r in mixing.mix(docs.repartition(2)).collect())
    rates = {r.source: r.rate for r in mixing.targets(sizes).collect()}
    times = Counter((d, t) for d, t, *_ in ROWS)
    for d, t, _, s, *_ in ROWS:
        assert math.floor(rates[s]) * times[d, t] <= got[d, t] <= math.ceil(rates[s]) * times[d, t]
    assert mixing.mix(none).count() == 0


# --- 7 -----------------------------------------------------------------------------------------------------------------


def test_language_id(docs, none):
    model = langid.fit(docs, fold("doc_id", 4) != 2)
    assert model.languages == ["xx", "yy"] and np.allclose(model.probabilities.sum(axis=0), 1)
    got = langid.identify(docs, model).collect()
    truth = {d: (t, lang) for d, t, lang, *_ in ROWS if d is not None and len(split(t)) > 20 and d < 800}
    assert len(got) == len(ROWS) and all(0 <= r.score <= 1 for r in got)
    assert np.mean([r.lang_pred == truth[r.doc_id][1] for r in got if r.doc_id in truth]) > 0.97
    said = {r.doc_id: r.lang_pred for r in got}
    assert said[800] == said[801] == said[802] == "und" and said[813] == "und" and said[803] != "und"
    assert langid.identify(none, model).count() == 0
    assert {r.lang_pred for r in langid.identify(docs, langid.fit(none)).collect()} == {"und"}


def test_rare_languages_are_learned(spark):
    rows = [(i, "alpha beta gamma", "xx") for i in range(400)] + [(1000 + i, "uno dos tres", "yy") for i in range(2)] + [(2000, "ichi ni san", "zz")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    sample = [r.doc_id for r in langid.language_sample(docs, 30).collect()]
    assert len(sample) == len(set(sample)) == 30 and {1000, 1001, 2000} <= set(sample)
    model = langid.fit(docs, most=30)
    assert model.languages == ["xx", "yy", "zz"]
    assert {(r.doc_id, r.lang_pred) for r in langid.identify(docs.filter("doc_id >= 1000"), model).collect()} == {(1000, "yy"), (1001, "yy"), (2000, "zz")}


def test_forward_sums_all_segmentations():
    table = PieceTable(default_model())
    draw = np.random.default_rng(1)
    chances = draw.random((table.size, 2)) / table.size
    known = {b: i for i, b in enumerate(table.bytes) if 0 < len(b) <= 16}
    word = b" there"

    def total(at: int, language: int) -> float:
        if at == len(word):
            return 1.0
        return sum(chances[known[word[at : at + n]], language] * total(at + n, language) for n in range(1, len(word) - at + 1) if word[at : at + n] in known)

    model = langid.LanguageModel(["a", "b"], chances)
    logs = model.log_likelihood(table, np.frombuffer(word, np.uint8), np.array([0]), np.array([len(word)]))[0]
    for language in (0, 1):
        assert logs[language] - len(word) * math.log(langid._LIFT) == pytest.approx(math.log(total(0, language)))


def test_word_parts_put_a_space_in_front():
    texts = ["ab cd", "ef", "", " gh\tij", "k" * 150]
    data, at = text_bytes(pa.array(texts))
    raw, starts, lengths, rows = langid.word_parts(data, at)
    found = [bytes(raw[a : a + n]) for a, n in zip(starts, lengths)]
    assert found[:5] == [b" ab", b" cd", b" ef", b" gh", b" ij"]
    assert b"".join(found[5:]) == b" " + b"k" * 150 and rows.tolist() == [0, 0, 1, 3, 3, 4, 4, 4]


def test_rows_are_compared_one_by_one():
    rows = [b"", b" ab", b" c", b" def"]
    for other, expected in ((rows, [True] * 4), ([b"", b" ab", b" x", b" def"], [True, True, False, True]), ([b"", b" a", b" c", b" defg"], [True, False, True, False])):
        (a, a_at), (b, b_at) = (text_bytes(pa.array(x, pa.binary())) for x in (other, rows))
        assert pieces.equal_rows(a, a_at, b, b_at).tolist() == expected


# --- 8 -----------------------------------------------------------------------------------------------------------------


def weighted(idf: np.ndarray, text: str) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(text.encode(), np.uint8)
    words = Words(raw, np.array([0, len(raw)]))
    return neardup.shingles(words, words.hashes(), idf)[:2]


def test_near_duplicates(docs, none):
    idf = neardup.word_frequencies(docs)
    unique = sorted({t or "" for _, t, *_ in ROWS})
    sets = [weighted(idf, t) for t in unique]
    root = list(range(len(unique)))
    for i in range(len(unique)):
        for j in range(i):
            if neardup.weighted_jaccard(*sets[i], *sets[j]) >= 0.8:
                a, b = sorted((root[i], root[j]))
                root = [a if r == b else r for r in root]
    of = dict(zip(unique, root))
    least: dict[int, int] = {}
    for d, t, *_ in ROWS:
        if d is not None:
            least[of[t or ""]] = min(least.get(of[t or ""], d), d)
    expected = Counter((d, least.get(of[t or ""])) for d, t, *_ in ROWS)
    got = neardup.classes(docs)
    assert Counter((r.doc_id, r.class_id) for r in got.collect()) == expected
    kept = neardup.without_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert Counter(of[r.text or ""] for r in kept.collect()) == Counter(set(root))
    assert neardup.classes(none).count() == 0 and neardup.without_near_duplicates(none).count() == 0


def spread_copies(seed: int = 5) -> list[str]:
    """Edited copies whose similarity to each other lies about the threshold; the text they are copies of is not there."""
    draw = random.Random(seed)
    base = [f"w{draw.randrange(400)}" for _ in range(110)]
    out = []
    for _ in range(250):
        copy = list(base)
        for _ in range(draw.choice([1, 2, 2, 3])):
            copy[draw.randrange(len(copy))] = f"edit{draw.randrange(10_000)}"
        out.append(" ".join(copy))
    return out


@pytest.mark.parametrize("few_links", [neardup.FEW_LINKS, 0])
def test_no_link_of_a_spread_group_is_lost(spark, monkeypatch, few_links):
    monkeypatch.setattr(neardup, "FEW_LINKS", few_links)
    monkeypatch.setattr(neardup, "BLOCK_TEXTS", 40)
    texts = sorted(set(spread_copies()))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    idf = neardup.word_frequencies(docs)
    sets, root = [weighted(idf, t) for t in texts], list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if root[i] != root[j] and neardup.weighted_jaccard(*sets[i], *sets[j]) >= 0.8:
                a, b = sorted((root[i], root[j]))
                root = [a if r == b else r for r in root]
    assert 1 < len(set(root)) < len(texts)
    assert {r.doc_id: r.class_id for r in neardup.classes(docs).collect()} == dict(enumerate(root))


def test_weighted_samples_agree_as_often_as_the_similarity():
    draw = np.random.default_rng(5)
    sampler = neardup.Sampler(samples=4096)
    found = np.sort(draw.integers(0, 1 << 63, 300).astype(np.uint64))
    weights = draw.gamma(2, 2, 300).astype(np.float32)
    other = np.where(draw.random(300) < 0.3, weights * 2, weights).astype(np.float32)
    keep = draw.random(300) < 0.9
    expected = neardup.weighted_jaccard(found, weights, found[keep], other[keep])
    agree = (sampler.of(found, weights) == sampler.of(found[keep], other[keep])).mean()
    assert abs(agree - expected) < 0.04


@pytest.mark.parametrize("n", [1, 30, 150, 3000])
@pytest.mark.parametrize("heavy", [1, 300])
def test_bound_holds_for_every_pair_and_tells_short_texts_apart(n, heavy):
    draw = np.random.default_rng(n + heavy)
    for share in (0.1, 0.6, 0.8, 0.95, 1.0):
        found = np.unique(draw.integers(0, 1 << 64, n, np.uint64))
        weights = draw.gamma(4, 1.5, len(found)).astype(np.float32)
        weights[0] *= heavy
        other = np.unique(np.where(draw.random(len(found)) < share, found, draw.integers(0, 1 << 64, len(found), np.uint64)))
        theirs = np.where(np.isin(other, found), weights[np.minimum(np.searchsorted(found, other), len(found) - 1)], 5).astype(np.float32)
        # As in the exact comparison, shingles that share half a hash are one.
        exact = neardup.weighted_jaccard(*neardup._halved(found, weights), *neardup._halved(other, theirs))
        drawn = np.zeros(neardup.HASHES, np.uint32)
        known = neardup.Faces(neardup.face(drawn, found, weights) + neardup.face(drawn, other, theirs))
        assert known.may_reach(0, np.array([1]), exact).all()
        if n <= 150 and heavy == 1 and 0.5 <= exact <= 0.85:
            assert not known.may_reach(0, np.array([1]), exact + 0.1).any()


def test_shingle_weights():
    idf = np.arange(1 << neardup.DF_BITS) / 1000.0
    value = lambda w: idf[int(span_hashes(np.frombuffer(w.encode(), np.uint8), np.array([0]), np.array([len(w)]))[0] >> np.uint64(64 - neardup.DF_BITS))]
    words = "a b c d e a b c d e a".split()
    expected = Counter()
    for i in range(len(words) - 4):
        expected[tuple(words[i : i + 5])] += np.mean([value(w) for w in words[i : i + 5]])
    assert sorted(weighted(idf, " ".join(words))[1].tolist()) == pytest.approx(sorted(expected.values()), rel=1e-5)
    assert weighted(idf, "a b")[1].tolist() == pytest.approx([(value("a") + value("b")) / 2])
    assert weighted(idf, "")[0].tolist() == weighted(idf, " \n")[0].tolist()


def test_shingles_that_share_half_a_hash_are_one():
    found = np.array([1 << 32, (1 << 32) + 5, 3 << 32], np.uint64)
    half, weights = neardup._halved(found, np.array([1, 2, 4], np.float32))
    assert half.tolist() == [1, 3] and weights.tolist() == [3, 4]


def test_components_of_a_long_chain(spark):
    draw = random.Random(3)
    names = [struct.pack(">I", n) for n in draw.sample(range(1 << 30), 60)]
    pairs = [*zip(names[:40], names[1:40]), *zip(names[40:55], names[41:56]), (names[58], names[59])]
    got = {bytes(r.id): bytes(r.root) for r in neardup.components(spark.createDataFrame([(bytearray(a), bytearray(b)) for a, b in pairs], "id binary, pivot binary")).collect()}
    expected = {}
    for group in (names[:40], names[40:56], names[58:]):
        expected |= {n: min(group) for n in group if n != min(group)}
    assert got == expected


# --- 9 -----------------------------------------------------------------------------------------------------------------


def covered_words(rows: list[tuple[int, str]], w: int = 13) -> Counter:
    first: dict[tuple, int] = {}
    for d, t in rows:
        words = split(t)
        for p in range(len(words) - w + 1):
            key = tuple(words[p : p + w])
            first[key] = min(first.get(key, d), d)
    out = Counter()
    for d, t in rows:
        words = split(t)
        mark = [False] * len(words)
        for p in range(len(words) - w + 1):
            if first[tuple(words[p : p + w])] < d:
                mark[p : p + w] = [True] * w
        kept = " ".join(x for x, m in zip(words, mark) if not m)
        out[(d, len(words), sum(mark), hashlib.sha256(kept.encode()).hexdigest())] += 1
    return out


def test_graph_dedup(docs, none):
    got = Counter((d if d is not None else 1 << 62, *rest) for d, *rest in rows_of(graph_dedup.removal_report(docs)).elements())
    assert got == covered_words(ORDERED)
    assert graph_dedup.removal_report(none).count() == 0
    cut = graph_dedup.without_repeats(docs)
    assert cut.columns == docs.columns and cut.count() == len(ROWS)
    assert cut.filter("doc_id = 804").first().text == "  two  spaces "


def test_unequal_words_behind_an_equal_hash_stay():
    batch = pa.RecordBatch.from_pydict(
        {
            "text": [" ".join(f"w{i}" for i in range(20))],
            "__sha": [b"\0" * 32],
            "__firsts": [[b"\0" * 32]],
            "__spans": [[{"tag": 0, "start": 0, "n": 1, "digest": graph_dedup.word_digest([b"other"] * 13)}]],
        }
    )
    assert list(graph_dedup._texts_and_spans(batch))[0][1] == []


# --- 10 ----------------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("bits", [1, 8])
@pytest.mark.parametrize("n", [1, 7, 8, 1000])
def test_planes(bits, n):
    ids = np.random.default_rng(n).integers(0, 1 << (n % 31 + 1), n).astype(np.uint32)
    assert (token_files.from_planes(token_files.to_planes(ids, bits), n, bits) == ids).all()
    zeros = np.zeros(n, np.uint32)
    assert (token_files.from_planes(token_files.to_planes(zeros, bits), n, bits) == zeros).all()
    assert len(token_files.to_planes(zeros, bits)) == 1


@pytest.mark.parametrize("bits", [1, 8])
def test_token_file_blocks(tmp_path, bits, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_IDS", 100)
    draw = np.random.default_rng(0)
    counts = np.array([0, 5, 250, 0, 100, 45, 0], np.int64)
    ids = draw.integers(0, 50_000, int(counts.sum())).astype(np.uint32)
    out = token_files.TokenFile(str(tmp_path / "a.tok"), bits, pa.int64())
    out.add(pa.array([1, 2, 3]), counts[:3], ids[:255])
    out.add(pa.array([4, None, 6, 7]), counts[3:], ids[255:])
    out.close()
    back = list(token_files.read_token_file(out.path))
    assert [x for names, _, _ in back for x in names.to_pylist()] == [1, 2, 3, 4, None, 6, 7]
    assert np.concatenate([c for _, c, _ in back]).tolist() == counts.tolist()
    assert (np.concatenate([i for _, _, i in back]) == ids).all()


def test_word_encoder_equals_the_tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    assert token_files.drops_white_space(path) and not token_files.drops_white_space(public_tokenizers.path("byte_bpe_50k.json"))
    whole, encoder = Tokenizer.from_file(path), token_files.WordEncoder(path)
    odd = ['"quoted"### it\'s. WE\'LL,, x|y', "J̌ T̈ İstanbul ΣΑΣ ﬁ", "a b　c d\x1ce\x85f", "<|endoftext|>, a<|startoftext|>b", "1,2.3!!", "é. é, ́."]
    texts = [t or "" for _, t, *_ in ROWS] + odd
    texts += ["it's'll x'sy a''s 'twas 'S 12'3 a'reb '' ' -'s 're", "don'", "t '", "s", "'", "ll", "a1b22c-3", "Ab_cD'VEx", "\x1f\x00a b\x7f"]
    texts += ["Été,été'S niño9 ÑU×2÷ Straße-ß ÿÿ", "é", "\u0301x é", "n\u0303o ÀÈ.Ì", "aİ,b é中文é Ǆé", "''é'ré 'é", "ñ'll"]
    raw = [t.encode() for t in texts]
    counts, ids = encoder.encode(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0] + [len(r) for r in raw]), 2)
    expected = [whole.encode(t, add_special_tokens=False).ids + [2] for t in texts]
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == expected


def test_token_files(docs, none, tmp_path):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    got = token_files.read_token_files(token_files.write_token_files(docs, str(tmp_path / "t"), path, bits=1)).collect()
    whole, start, expected = Tokenizer.from_file(path), 0, Counter()
    for d, t in sorted(((d, t or "") for d, t, *_ in ROWS), key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode())):
        ids = np.array(whole.encode(t, add_special_tokens=False).ids + [2], "<u4")
        expected[(d, start, len(ids), zlib.crc32(ids.tobytes()))] += 1
        start += len(ids)
    assert Counter(map(tuple, got)) == expected
    assert token_files.read_token_files(token_files.write_token_files(none, str(tmp_path / "n"), path)).count() == 0
