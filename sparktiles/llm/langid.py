"""Language identification by segmentation-marginalised unigrams.

Every language has a probability for each piece of one fixed public vocabulary. A word's probability in a language is the sum over
all its segmentations into pieces, found by the forward algorithm; a text's is the product over its words. The piece
probabilities are learned by expectation maximisation: forward and backward sums give the expected count of every piece over
all segmentations of the training words.

Words are cut at white space and scored with a space in front; a word of over 64 bytes is scored in parts. The training sample
is at most SAMPLE_ROWS documents (a hash of doc_id picks them within each language, so that all languages have a share; one each
where there are more languages than that), counted to words per language by Spark before the one fitting task. Every language of
the training rows that has a word is learned. A null text, or one without a letter, is `und` with score 0; so is every text when
nothing could be learned.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Words, arrow_map, fold, hash_sample, span_hashes, stored, table, text_slices
from .lattice import PART_BYTES, PIECE_BYTES, PieceTable, by_length, default_model, parts_of

SAMPLE_ROWS, ROUNDS, SMOOTHING = 6_000, 4, 0.5
HOLD_OUT = 4
UNKNOWN = "und"
#: Keeps sums over parts of words within the range of a double: a factor per byte, the same for every language.
_LIFT = 2000.0
_LETTER = regex.compile(r"\p{L}")


def word_parts(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, starts, lengths, rows) of the parts of a slice's words, each word with a space in front."""
    words = Words(data, at)
    # One byte more before the text, so that the byte in front of every word can be made a space. A word at the start of a row has
    # the last byte of the row before in front: those words are copied to a place of their own.
    touching = np.isin(words.starts, at)
    out = np.concatenate([np.full(1, 0x20, np.uint8), data])
    out[words.starts[~touching]] = 0x20
    starts, ends, more, size = words.starts.copy(), words.ends + 1, [out], len(out)
    for i in np.flatnonzero(touching):
        word = data[words.starts[i] : words.ends[i]]
        starts[i], ends[i] = size, size + len(word) + 1
        more += [np.full(1, 0x20, np.uint8), word]
        size += len(word) + 1
    parts, lengths = parts_of(out, starts, ends)
    counts = -(-(ends - starts) // PART_BYTES)
    return np.concatenate(more), parts, lengths, np.repeat(words.rows(), counts)


@dataclass
class LanguageModel:
    languages: list[str]
    #: (pieces, languages)
    probabilities: np.ndarray

    def log_likelihood(self, pieces: PieceTable, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """(parts, languages): log of the sum over all segmentations, up to a constant per byte that is the same for all."""
        out = np.empty((len(starts), len(self.languages)))
        lifted = [self.probabilities * _LIFT**s for s in range(PIECE_BYTES + 1)]
        for which, chars in by_length(starts, lengths, data):
            forward, _ = _forward(pieces, chars, lengths[which], lifted)
            out[which] = np.log(np.maximum(forward[np.arange(len(which)), lengths[which]], 1e-300))
        return out


def _forward(pieces: PieceTable, chars: np.ndarray, lengths: np.ndarray, lifted: list[np.ndarray]):
    """Sums over the segmentations of every beginning: (parts, bytes + 1, languages); and the spans with their weights."""
    n, width = chars.shape
    languages = lifted[0].shape[1]
    weights, spans = {}, []
    for size, row, start, piece in pieces.spans(chars, lengths):
        w = lifted[size][piece]
        weights[size] = np.zeros((n, width - size + 1, languages))
        weights[size][row, start] = w
        spans.append((size, row, start, piece, w))
    forward = np.zeros((n, width + 1, languages))
    forward[:, 0] = 1
    for j in range(1, width + 1):
        for size in range(1, min(PIECE_BYTES, j) + 1):
            forward[:, j] += forward[:, j - size] * weights[size][:, j - size]
    return forward, spans


def learn(pieces: PieceTable, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Piece probabilities, (pieces, languages), from words and how often each language has them, (words, languages)."""
    size = pieces.size
    chances = np.full((size, counts.shape[1]), 1.0 / size)
    for _ in range(rounds):
        expected = np.zeros_like(chances)
        lifted = [chances * _LIFT**s for s in range(PIECE_BYTES + 1)]
        for which, chars in by_length(starts, lengths, data):
            forward, spans = _forward(pieces, chars, lengths[which], lifted)
            backward = np.zeros_like(forward)
            backward[np.arange(len(which)), lengths[which]] = 1
            weights = {}
            for s, r, a, _, w in spans:
                weights[s] = np.zeros((len(which), chars.shape[1] - s + 1, counts.shape[1]))
                weights[s][r, a] = w
            for i in range(chars.shape[1] - 1, -1, -1):
                for s in range(1, min(PIECE_BYTES, chars.shape[1] - i) + 1):
                    backward[:, i] += weights[s][:, i] * backward[:, i + s]
            total = forward[np.arange(len(which)), lengths[which]]
            for s, r, a, p, w in spans:
                share = forward[r, a] * w * backward[r, a + s] / total[r] * counts[which[r]]
                for language in range(counts.shape[1]):
                    expected[:, language] += np.bincount(p, share[:, language], minlength=size)
        chances = expected + SMOOTHING
        chances /= chances.sum(axis=0)
    return chances


# --- Spark -------------------------------------------------------------------------------------------------------------


def language_sample(rows: DataFrame, most: int) -> DataFrame:
    """Ids of the sample: of every language the most // languages (one at least) of the smallest hashes, and up to `most` ids in all
    the smallest hashes of the rest."""
    ids = rows.select("doc_id", "lang").distinct()
    n = ids.agg(F.count_distinct("lang")).first()[0]
    order = Window.partitionBy("lang").orderBy(F.md5(F.concat(F.lit("lang"), F.col("doc_id").cast("string")).cast("binary")), "doc_id")
    own = ids.withColumn("__n", F.row_number().over(order)).filter(F.col("__n") <= max(1, most // max(1, n)))
    own = stored(own.select("doc_id").distinct())
    rest = ids.select("doc_id").distinct().join(F.broadcast(own), "doc_id", "left_anti")
    return own.unionByName(hash_sample(rest, "doc_id", max(0, most - own.count()), "lang"))


def fit(docs: DataFrame, train: Column | None = None, most: int = SAMPLE_ROWS, model: str | None = None) -> LanguageModel:
    """Learn from the rows where `train` holds and text and lang are known."""
    model = model or default_model()
    known = docs.filter(F.col("text").isNotNull() & F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    # A document without words teaches nothing of its language.
    worded = known.filter(F.col("text").rlike(r"[^ \t-\r]"))
    ids = language_sample(worded if train is None else worded.filter(train), most)
    rows = known.select("doc_id", "text", "lang").join(F.broadcast(ids), "doc_id").select("text", "lang")

    def make():
        def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for part, data, at in text_slices(batch):
                text, starts, lengths, of = word_parts(data, at)
                names = part.column("lang").to_pylist()
                numbers = {name: i for i, name in enumerate(dict.fromkeys(names))}
                language = np.array([numbers[x] for x in names], np.int64)[of] if len(of) else of
                keys = span_hashes(text, starts, lengths) + language.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                _, one, n = np.unique(keys, return_index=True, return_counts=True)
                raw, back = memoryview(text), list(numbers)
                words = [bytes(raw[a : a + k]) for a, k in zip(starts[one].tolist(), lengths[one].tolist(), strict=True)]
                columns = [pa.array([back[i] for i in language[one]], pa.string()), pa.array(words, pa.binary()), pa.array(n)]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "word", "n"])

        return step

    counts = stored(arrow_map(rows, make, "lang string, word binary, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")))
    languages = [r.lang for r in counts.select("lang").distinct().orderBy("lang").collect()]
    if not languages:
        return LanguageModel([], np.zeros((0, 0)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[bytes, np.ndarray] = {}
        for batch in batches:
            for name, word, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words.setdefault(word, np.zeros(len(languages)))[languages.index(name)] = n
        # In one order whatever order the rows come in, so that sums of floats are the same in every run.
        names = sorted(words)
        sizes = np.array([len(w) for w in names], np.int64)
        data = np.frombuffer(b"".join(names), np.uint8)
        starts = np.cumsum(sizes) - sizes
        chances = learn(PieceTable(model), data, starts, sizes, np.stack([words[w] for w in names]))
        for i in range(len(languages)):
            yield pa.RecordBatch.from_arrays([pa.array([i]), pa.array([chances[:, i].tobytes()], pa.binary())], ["i", "p"])

    learned = counts.select("lang", "word", "n").repartition(1).mapInArrow(run, "i long, p binary").collect()
    return LanguageModel(languages, np.stack([np.frombuffer(r.p) for r in sorted(learned, key=lambda r: r.i)], axis=1))


def identify(docs: DataFrame, known: LanguageModel, model: str | None = None) -> DataFrame:
    """doc_id, lang_pred and score (its share among the learned languages) of every row."""
    model = model or default_model()
    shared = docs.sparkSession.sparkContext.broadcast(known)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def make():
        pieces = PieceTable(model)

        def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            names = shared.value.languages
            for part, data, at in text_slices(batch):
                n = part.num_rows
                if names:
                    text, starts, lengths, of = word_parts(data, at)
                    _, one, which = np.unique(span_hashes(text, starts, lengths), return_index=True, return_inverse=True)
                    logs = shared.value.log_likelihood(pieces, text, starts[one], lengths[one])
                    total = np.stack([np.bincount(of, column[which], minlength=n) for column in logs.T], axis=1)
                    share = np.exp(total - total.max(axis=1, keepdims=True))
                    share /= share.sum(axis=1, keepdims=True)
                    best = total.argmax(axis=1)
                lettered = [t is not None and _LETTER.search(t) is not None for t in part.column("text").to_pylist()]
                said = [names[best[i]] if names and ok else UNKNOWN for i, ok in enumerate(lettered)]
                score = [float(share[i, best[i]]) if names and ok else 0.0 for i, ok in enumerate(lettered)]
                columns = [part.column("doc_id"), pa.array(said, pa.string()), pa.array(score, pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "lang_pred", "score"])

        return step

    return arrow_map(docs.select("doc_id", "text"), make, f"doc_id {kind}, lang_pred string, score double")


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = identify(docs, fit(docs, fold("doc_id", HOLD_OUT) != 2))
    held = F.coalesce(fold("doc_id", HOLD_OUT) == 2, F.lit(False))
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score")
