"""Encoding by the merge automaton against the tokenizers library and against merging pair by pair."""

from __future__ import annotations

import hashlib
import itertools
import random
import struct

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import types as T
from tokenizers import Tokenizer

from sparktiles.llm import common
from sparktiles.llm import merge_automaton as ma

PATH = public_tokenizers.path("byte_bpe_50k.json")
PARTS = ["'s", "'re", "'ll", "'ve", "'d", "'m", "'t", "'x", " ", "  ", "\n", "\t", "a", "the", "hello", "é", "ß", "中文", "123", "٣", "'", "''", "!", "...", "\xa0", " "]
PARTS += ["<|endoftext|>", "<|endof", "text|>", "aaaa", "-----", "\U0001f600", "é", "᠎", "\x85", "\x1c", "²", "Ⅷ", "ʼ", "İ", "\x00"]


@pytest.fixture(scope="module")
def automaton():
    return ma.MergeAutomaton.from_file(PATH)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def packed(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)


def awkward_texts() -> list[str]:
    draw = random.Random(1)
    texts = ["".join(draw.choice(PARTS) for _ in range(draw.randint(0, 30))) for _ in range(1500)]
    texts += ["".join(chr(draw.choice([draw.randint(1, 0x2FF), draw.randint(0x300, 0xD7FF), draw.randint(0xE000, 0x10FFFF)])) for _ in range(40)) for _ in range(500)]
    return texts + ["a" * 3000, "ab" * 2000, " " * 5000, "x" * 600 + "y", "-" * 1500, "", "中" * 1000, "<|endof", "text|>"]


def test_texts_encode_as_the_library_does(automaton, library):
    texts = awkward_texts()
    counts, ids = ma.TextEncoder(automaton).encode(*packed([t.encode() for t in texts]))
    found = np.split(ids, np.cumsum(counts)[:-1])
    for text, got, want in zip(texts, found, library.encode_batch(texts, add_special_tokens=False), strict=True):
        assert got.tolist() == want.ids, text[:80]
    at = np.concatenate([[0], np.cumsum(counts)])
    data, offsets = automaton.decode(ids, at)
    assert [bytes(data[a:b]).decode() for a, b in itertools.pairwise(offsets.tolist())] == texts


def test_every_character_has_the_class_of_the_library(library):
    """Beside a letter, a digit, a mark and a space, the library splits as the class table says."""
    classes = ma.character_classes()
    every = [c for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000]
    for low in range(0, len(every), 20_000):
        text = "".join(f"a{chr(c)}0{chr(c)}!{chr(c)} {chr(c)}" for c in every[low : low + 20_000])
        code = np.frombuffer(text.encode("utf-32-le"), "<u4")
        cut = np.zeros(len(code), bool)
        cut[0] = True
        starts = np.flatnonzero(ma.word_starts(code, classes[code], cut))
        assert starts.tolist() == [a for _, (a, _) in library.pre_tokenizer.pre_tokenize_str(text)]


def merged(word: bytes, merges: list[tuple[bytes, bytes]]) -> list[bytes]:
    parts = [word[i : i + 1] for i in range(len(word))]
    for a, b in merges:
        out, i = [], 0
        while i < len(parts):
            if i + 1 < len(parts) and (parts[i], parts[i + 1]) == (a, b):
                out.append(a + b)
                i += 2
            else:
                out.append(parts[i])
                i += 1
        parts = out
    return parts


@pytest.mark.parametrize("seed", range(6))
def test_random_vocabularies_equal_merging_pair_by_pair(seed):
    draw = random.Random(seed)
    tokens = [bytes([b]) for b in range(256)]
    merges: list[tuple[bytes, bytes]] = []
    usable = [b"a", b"b", b"c"]
    while len(merges) < 25:
        a, b = draw.choice(usable), draw.choice(usable)
        # A merge whose parts meet in their own string, and whose string is new.
        if a + b not in tokens and merged(a + b, merges) == [a, b]:
            merges.append((a, b))
            tokens.append(a + b)
            usable.append(a + b)
    number = {t: i for i, t in enumerate(tokens)}
    automaton = ma.MergeAutomaton(dict(enumerate(tokens)), [(number[a], number[b], number[a + b]) for a, b in merges], {})
    words = [bytes(w) for n in range(1, 8) for w in itertools.product(b"abc", repeat=n)]
    words += [bytes(draw.choice(b"abcd") for _ in range(600)) for _ in range(3)]
    data, offsets = packed(words)
    counts, ids = automaton.encode_words(data, offsets[:-1], np.diff(offsets))
    for word, got in zip(words, np.split(ids, np.cumsum(counts)[:-1]), strict=True):
        assert [tokens[t] for t in got] == merged(word, merges)


def test_spans_of_one_hash_are_told_apart(automaton, library, monkeypatch):
    monkeypatch.setattr(common, "span_hashes", lambda data, starts, lengths: lengths.astype(np.uint64))
    text = "some words and other words once more, some of one length"
    counts, ids = ma.TextEncoder(automaton).encode(*packed([text.encode()]))
    assert ids.tolist() == library.encode(text, add_special_tokens=False).ids


def test_unsuitable_files_are_refused():
    with pytest.raises(ValueError, match="no plain byte-level"):
        ma.MergeAutomaton.from_file(public_tokenizers.path("word_bpe_49k.json"))


SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), *(T.StructField(c, T.StringType()) for c in ("ids", "state", "source"))])


def test_rows_with_nulls_repeats_and_other_columns(spark, library):
    texts = [(1, "plain text", "x", None, "s"), (1, "plain text", "x", None, "s"), (2, None, None, None, None), (None, "", "y", "z", "s"), (3, "word " * 400_000, None, None, "s")]
    docs = spark.createDataFrame(texts, SCHEMA)
    encoded = ma.encode(docs, PATH, carried=("doc_id", "source"))
    rows = {(r.doc_id, r.source): r.ids for r in encoded.collect()}
    assert rows[(2, None)] == [] and rows[(None, "s")] == []
    assert rows[(1, "s")] == library.encode("plain text", add_special_tokens=False).ids
    assert rows[(3, "s")] == library.encode(texts[-1][1], add_special_tokens=False).ids
    assert sorted(r.text for r in ma.decode(encoded, PATH).collect()) == sorted(t[1] or "" for t in texts)
    assert ma.encode(docs.limit(0), PATH).count() == 0
    cut = spark.createDataFrame([(1, [162]), (2, None), (3, [50256, 64])], "doc_id long, ids array<int>")
    back = {r.doc_id: r.text for r in ma.decode(cut, PATH).collect()}
    assert back == {1: library.decode([162], skip_special_tokens=False), 2: "", 3: "<|endoftext|>a"}


def test_op12_against_the_library(spark, library, tmp_path):
    texts = [(i, t, None, None, None) for i, t in enumerate(awkward_texts()[::7])] + [(9999, None, None, None, None)]
    spark.createDataFrame(texts, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r.doc_id: r for r in ma.op12_merge_automaton(spark, str(tmp_path)).collect()}
    assert len(rows) == len(texts)
    for i, text, *_ in texts:
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert rows[i].n_tokens == len(ids)
        assert rows[i].ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert rows[i].decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
