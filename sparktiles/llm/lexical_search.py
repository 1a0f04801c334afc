"""Ranked lexical search of many items at once: what items share is computed once for each document.

Items are sets of terms. Their lists are ordered by how many items hold a term, and neighbours that at least two items share are joined
into nodes, again and again, until none is left: a graph in which a node is a set of terms and the sum of two others. For a block
of documents, a term's scores are its accumulator, a node's accumulator is made once from its two parts, and an item's scores are the sum of
the few nodes that its terms were joined into. All numbers are integers, so the order of the sums does not matter.

Documents are read once for each batch of items (one batch, unless items hold over BATCH_TERMS terms) and kept as numbers and counts
of the terms that items hold. How many documents hold a term, and how long all are, comes from whole tables; a task keeps the best of its
documents for each item, and two rounds of windows, the first over salted items, keep the best of all.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import U64, arrow_map, ranges, span_hashes, stored, table, text_slices

TOP = 50
#: (item, term) pairs of one batch: what is broadcast, and what one task joins into nodes.
BATCH_TERMS = 200_000
#: Numbers in the accumulators of a block of documents.
BLOCK_CELLS = 1 << 22
SALTS = 32
WAITING = 1 << 16
LAST_ID = np.iinfo(np.int64).max

_TERM = np.zeros(256, bool)
_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


# --- Terms -------------------------------------------------------------------------------------------------------------


def term_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(lowered bytes, starts, lengths, row offsets into the terms) of all terms: letters and digits of ASCII, and all else beyond."""
    inside = np.concatenate([[False], _TERM[data], [False]])
    row_start = np.zeros(len(data) + 1, bool)
    row_start[offsets] = True
    starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | row_start[:-1]))
    ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | row_start[1:])) + 1
    return _LOWER[data], starts, ends - starts, np.searchsorted(starts, offsets)


def terms_of(items: DataFrame) -> DataFrame:
    """Distinct (item_id, term) of items with an id."""

    def make():
        def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for part, data, offsets in text_slices(batch):
                low, starts, lengths, at = term_spans(data, offsets)
                raw = low.tobytes()
                words = [raw[a : a + n].decode() for a, n in zip(starts.tolist(), lengths.tolist(), strict=True)]
                ids = part.column("item_id").take(pa.array(np.repeat(np.arange(len(offsets) - 1), np.diff(at))))
                yield pa.RecordBatch.from_arrays([ids, pa.array(words, pa.string())], ["item_id", "term"])

        return step

    kind = items.schema["item_id"].dataType.simpleString()
    return arrow_map(items.filter("item_id IS NOT NULL").select("item_id", "text"), make, f"item_id {kind}, term string").distinct()


class Vocabulary:
    """Terms by the hash of their bytes, compared byte by byte where a hash is met."""

    def __init__(self, terms: list[str]) -> None:
        each = [t.encode() for t in terms]
        self.lengths = np.array([len(x) for x in each], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.data = np.frombuffer(b"".join(each), np.uint8)
        hashes = span_hashes(self.data, self.starts, self.lengths)
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]
        if len(np.unique(hashes)) < len(hashes):
            raise ValueError("two terms of one hash")

    def find(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The number of each span's term, or -1."""
        if not len(self.hashes):
            return np.full(len(starts), -1)
        hashes = span_hashes(data, starts, lengths)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        found = np.where(self.hashes[at] == hashes, self.order[at], -1)
        hit = np.flatnonzero(found >= 0)
        hit_lengths, want = lengths[hit], found[hit]
        same = hit_lengths == self.lengths[want]
        hit_lengths = np.where(same, hit_lengths, 0)
        bad = np.zeros(int(hit_lengths.sum()) + 1, np.int64)
        np.cumsum(data[ranges(starts[hit], hit_lengths)] != self.data[ranges(self.starts[want], hit_lengths)], out=bad[1:])
        ends = np.cumsum(hit_lengths)
        found[hit[~same | (bad[ends] != bad[ends - hit_lengths])]] = -1
        return found


def term_counts(docs: DataFrame, terms: list[str]) -> DataFrame:
    """doc_id, n (all terms with repeats), and the numbers and counts of the given terms, for every document."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def make():
        vocabulary = Vocabulary(shared.value)

        def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for part, data, offsets in text_slices(batch):
                low, starts, lengths, at = term_spans(data, offsets)
                found = vocabulary.find(low, starts, lengths)
                row = np.repeat(np.arange(len(offsets) - 1), np.diff(at))
                known = found >= 0
                pair, times = np.unique(row[known].astype(U64) << U64(32) | found[known].astype(U64), return_counts=True)
                cuts = np.searchsorted(pair, np.arange(len(offsets), dtype=U64) << U64(32)).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(cuts), pa.array(x.astype(np.int32))) for x in (pair & U64(0xFFFFFFFF), times)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(np.diff(at), pa.int64()), *lists], ["doc_id", "n", "terms", "times"])

        return step

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return arrow_map(rows, make, "doc_id long, n long, terms array<int>, times array<int>")


def document_counts(counted: DataFrame) -> DataFrame:
    """term, df: how many documents hold each term that any holds; a task sends one row per term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            found = np.bincount(batch.column("terms").flatten().to_numpy(zero_copy_only=False))
            total = np.pad(total, (0, max(0, len(found) - len(total))))
            total[: len(found)] += found
        term = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(term.astype(np.int32)), pa.array(total[term])], ["term", "df"])

    return counted.select("terms").mapInArrow(run, "term int, df long").groupBy("term").agg(F.sum("df").alias("df"))


# --- Sharing -----------------------------------------------------------------------------------------------------------


def share(item: np.ndarray, term: np.ndarray, n_terms: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(parts of each new node, item and node of what is left) for distinct (item, term) pairs.

    Nodes below n_terms are terms; node n_terms + i is the sum of parts[i]. Lists are ordered by how many items hold a term (then by its
    number), so that what many items share stands side by side. In each round, the neighbours that most items share are joined;
    an occurrence gives way to a better one beside it, and a pair that keeps fewer than two occurrences stays apart.
    """
    held = np.bincount(term, minlength=n_terms)
    order = np.lexsort((term, -held[term], item))
    item, node, parts, nodes = item[order], term[order].astype(np.int64), [], n_terms
    while len(node) > 1:
        beside = np.flatnonzero(item[1:] == item[:-1])
        pair = node[beside] << 32 | node[beside + 1]
        kinds, kind, times = np.unique(pair, return_inverse=True, return_counts=True)
        rank = np.zeros(len(node) + 1, np.int64)  # of the pair that begins at a place; 0: none
        better = np.empty(len(kinds), np.int64)
        better[np.lexsort((-kinds, times))] = np.arange(1, len(kinds) + 1)
        rank[beside] = np.where(times[kind] > 1, better[kind], 0)
        before = np.concatenate([[0], rank[:-2]])
        chosen = np.flatnonzero((rank[:-1] > 0) & (rank[:-1] > before) & (rank[:-1] > rank[1:]))
        if not len(chosen):
            break
        what, which, kept = np.unique(node[chosen] << 32 | node[chosen + 1], return_inverse=True, return_counts=True)
        stays = kept[which] > 1
        if not stays.any():
            break
        chosen, which = chosen[stays], which[stays]
        used, which = np.unique(which, return_inverse=True)
        parts.append(np.column_stack([what[used] >> 32, what[used] & 0xFFFFFFFF]))
        node[chosen] = nodes + which
        nodes += len(used)
        keep = np.ones(len(node), bool)
        keep[chosen + 1] = False
        item, node = item[keep], node[keep]
    return np.concatenate(parts) if parts else np.zeros((0, 2), np.int64), item, node


class Plan:
    """The graph of a batch of items, by levels: a level's nodes have their parts in those before."""

    def __init__(self, parts: np.ndarray, item: np.ndarray, node: np.ndarray, n_items: int, n_terms: int) -> None:
        self.n_terms, self.n_items, self.n_nodes = n_terms, n_items, n_terms + len(parts)
        level = np.zeros(self.n_nodes, np.int64)
        for i, (a, b) in enumerate(parts.tolist()):
            level[n_terms + i] = max(level[a], level[b]) + 1
        self.levels = [(rows, parts[rows - n_terms]) for k in range(1, int(level.max(initial=0)) + 1) for rows in [np.flatnonzero(level == k)]]
        order = np.argsort(item, kind="stable")
        self.roots, self.items = node[order], np.unique(item)
        self.firsts = np.searchsorted(item[order], self.items)

    def scores(self, leaves: np.ndarray) -> np.ndarray:
        """Scores of `items` (rows) for the documents of a block, from the accumulators of terms (rows 0 to n_terms)."""
        for rows, parts in self.levels:
            leaves[rows] = leaves[parts[:, 0]] + leaves[parts[:, 1]]
        return np.add.reduceat(leaves[self.roots], self.firsts, axis=0)


class Ranking:
    """The best documents of each item so far: score descending, doc_id ascending, a null id last."""

    def __init__(self, n_items: int, top: int) -> None:
        self.top, self.floor = top, np.ones(n_items, np.int64)
        self.kept, self.n = [], 0

    def offer(self, items: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        row, doc = np.nonzero(scores >= self.floor[items][:, None])
        self.kept.append((items[row], scores[row, doc], ids[doc]))
        self.n += len(row)
        if self.n > WAITING + self.top * len(items):
            self.trim()

    def trim(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        item, score, doc = (np.concatenate(x) for x in zip(*self.kept, strict=True)) if self.kept else (np.zeros(0, np.int64),) * 3
        order = np.lexsort((doc, -score, item))
        item, score, doc = item[order], score[order], doc[order]
        firsts = np.flatnonzero(np.concatenate([[True], item[1:] != item[:-1]])) if len(item) else np.zeros(0, np.int64)
        place = np.arange(len(item)) - np.repeat(firsts, np.diff(np.append(firsts, len(item))))
        keep = place < self.top
        full = place == self.top - 1
        self.floor[item[full]] = score[full]
        self.kept, self.n = [(item[keep], score[keep], doc[keep])], int(keep.sum())
        return self.kept[0]


def ranked_blocks(counted: DataFrame, plan: Plan, weights: np.ndarray, n_docs: int, n_terms: int, top: int) -> DataFrame:
    """item (number), doc_id, score: the best of each task's documents."""
    shared = counted.sparkSession.sparkContext.broadcast((plan, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan, weights = shared.value
        ranking = Ranking(plan.n_items, top)
        size = max(16, BLOCK_CELLS // (plan.n_nodes + len(plan.roots)))
        for whole in batches:
            for low in range(0, whole.num_rows, size):
                batch = whole.slice(low, size)
                term, times = (batch.column(c).flatten().to_numpy(zero_copy_only=False).astype(np.int64) for c in ("terms", "times"))
                lengths, n = np.diff(batch.column("terms").offsets.to_numpy()), batch.column("n").to_numpy()
                m = 100 - 50 + (50 * n * n_docs) // max(n_terms, 1)
                doc = np.repeat(np.arange(len(lengths)), lengths)
                leaves = np.zeros((plan.n_nodes, len(lengths)), np.int64)
                leaves[term, doc] = weights[term] * ((1_000_000_000 * times) // (1000 * times + 20 * m[doc]))
                ranking.offer(plan.items, plan.scores(leaves), batch.column("doc_id").fill_null(LAST_ID).to_numpy())
        item, score, ids = ranking.trim()
        if len(item):
            yield pa.RecordBatch.from_arrays([pa.array(item.astype(np.int32)), pa.array(ids, mask=ids == LAST_ID), pa.array(score)], ["item", "doc_id", "score"])

    return counted.mapInArrow(run, "item int, doc_id long, score long")


# --- Spark -------------------------------------------------------------------------------------------------------------


def _search_batch(docs: DataFrame, pairs: DataFrame, top: int) -> DataFrame:
    kind = pairs.schema["item_id"].dataType.simpleString()
    found = pairs.toArrow().to_pandas()
    if found.empty:
        return docs.sparkSession.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    items, item = np.unique(found["item_id"].to_numpy(), return_inverse=True)
    terms, term = np.unique(found["term"].to_numpy().astype(object), return_inverse=True)
    plan = Plan(*share(item, term, len(terms)), len(items), len(terms))
    counted = stored(term_counts(docs, terms.tolist()))
    n_docs, all_terms = counted.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(terms), np.int64)
    for row in document_counts(counted).toLocalIterator():
        df[row["term"]] = row["df"]
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
    ranked = ranked_blocks(counted, plan, weights, n_docs, all_terms, top)
    for keys in (["item", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))], ["item"]):
        order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        ranked = ranked.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    names = docs.sparkSession.createDataFrame(pd.DataFrame({"item": np.arange(len(items)), "item_id": items}), f"item int, item_id {kind}")
    return ranked.join(F.broadcast(names), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, top: int = TOP, batch_terms: int = BATCH_TERMS) -> DataFrame:
    """item_id, rank, doc_id, score: the `top` highest-scoring documents of each item, with scores above 0.

    `docs`: doc_id (whole numbers) and text; `items`: item_id and text; other columns are ignored. A null or empty text has no
    terms. Items without an id are none; rows with one id are one item of all their terms. Every row of `docs` is a document, repeated
    ones too; one without an id counts and comes last among equal scores. An item without a known term gives no row."""
    pairs = stored(terms_of(items))
    batches = -(-pairs.count() // batch_terms)
    if batches < 2:
        return _search_batch(docs, pairs, top)
    dealt = stored(pairs.withColumn("batch", F.pmod(F.xxhash64("item_id"), F.lit(batches))))
    found = [stored(_search_batch(docs, dealt.filter(F.col("batch") == b).drop("batch"), top)) for b in range(batches)]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


OP11_SQL = r"""
WITH doc_terms AS (
  SELECT row_no, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS row_no, doc_id, text FROM documents)
), item_terms AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark WHERE item_id IS NOT NULL
), lengths AS (SELECT row_no, count(*) AS n FROM doc_terms GROUP BY row_no
), totals AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS all_terms FROM lengths
), counts AS (SELECT row_no, doc_id, term, count(*) AS tf FROM doc_terms GROUP BY ALL
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM counts GROUP BY term), totals
), scored AS (
  SELECT i.item_id, c.row_no, c.doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * n_docs) // all_terms)))) AS BIGINT) AS score
  FROM item_terms i JOIN counts c USING (term) JOIN weights USING (term) JOIN lengths USING (row_no), totals
  GROUP BY ALL
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) <= 50
"""


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
