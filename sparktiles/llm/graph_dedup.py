"""Removal of repeated 13-word windows over a compacted De Bruijn graph of tokens.

Every window of 13 words that may repeat (it holds a repeated anchor, see anchors.py) is an edge from its first 12 words to its
last 12. Edges are partitioned by their anchor, so all places of an edge meet, together with the edges before and behind them.
An edge is repeated if two documents have it. Where a repeated edge has one successor only, that successor has it as its only
predecessor, and both occur equally often at the same places, no branch lies between them: every place of the one continues with the other. Runs
of such edges are pieces; joins on the edges at their ends link pieces of different partitions, and pieces linked in the
first document that has them become one path. A path has one list of places, those of its first edge, however long it is.

Paths are then verified at their source: a digest of the words in the first document is compared with the words at every other
place, so equal hashes of different words remove nothing. All of a path's windows start in that first document; places in
later documents are removed.

A null text has no words. Order is by doc_id, null ids last; a window that repeats within one document only stays.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .anchors import IS_FIRST, Anchors, bucketed, find_anchors, first_texts, known_anchors, repeated_anchors, with_facts
from .common import U64, Words, grams, mix, multipliers, ranges, stored, table, text_slices
from .suffix_dedup import _tags, united

WINDOW, K = 13, 6
#: In place of a neighbouring edge: the text ends here, or different places have different ones.
END, BRANCH = U64(0), U64(1)
_MULTIPLIERS = multipliers(WINDOW - K + 1, 31)


def _word_anchors(data: np.ndarray, at: np.ndarray) -> tuple[Anchors, np.ndarray, np.ndarray]:
    words = Words(data, at)
    hashes = words.hashes()
    return find_anchors(grams(hashes, K), words.offsets, WINDOW, K), words.offsets, hashes


def word_anchors(data: np.ndarray, at: np.ndarray) -> tuple[Anchors, np.ndarray]:
    return _word_anchors(data, at)[:2]


# --- Edges -------------------------------------------------------------------------------------------------------------

_EDGES = "bucket int, edges binary, sizes binary, okeys binary, tags binary, starts binary, counts binary, done boolean"
_ARRAYS = (U64, np.int64, np.int64, U64, np.int64, np.int64)


def _packed_edges(found: Anchors, offsets: np.ndarray, hashes: np.ndarray, part: pa.RecordBatch, n: int) -> Iterator[pa.RecordBatch]:
    """Chains of edges, one per anchor, with the edge before and behind, by bucket of the anchor.

    Of equal chains of a slice only those of the first document go on, with the number of all; the others are done: each of
    their windows starts in a document before theirs.
    """
    edges = grams(hashes, WINDOW, 13) | U64(2)  # never END or BRANCH
    sizes = found.last - found.first + 1
    okeys, tags = part.column("__okey").to_numpy()[found.row], _tags(part.column("__sha"))[found.row]
    starts, ends = offsets[found.row], offsets[found.row + 1]
    before = np.where(found.first > starts, edges[np.maximum(found.first - 1, 0)], END)
    behind = np.where(found.last + WINDOW < ends, edges[np.minimum(found.last + 1, len(edges) - 1)], END)
    content = mix(sizes.astype(U64) + found.key)
    for j, m in enumerate(_MULTIPLIERS):
        there = np.minimum(found.first + j, len(edges) - 1)
        content = content + np.where(j < sizes, mix(edges[there] ^ m), U64(0)) * m
    order = np.lexsort((okeys, content))
    head = np.concatenate([[True], content[order][1:] != content[order][:-1]])
    group = np.cumsum(head) - 1
    heads = np.flatnonzero(head)
    least = okeys[order][heads][group]
    later = okeys[order] > least
    count = np.add.reduceat(np.ones(len(order), np.int64), heads)[group]
    # The first document's chains carry the count of those that are done; neighbours that differ are a branch.
    low, high = (f.reduceat(x[order], heads)[group] for f, x in ((np.minimum, before), (np.maximum, before)))
    before[order] = np.where(low == high, low, BRANCH)
    low, high = (f.reduceat(x[order], heads)[group] for f, x in ((np.minimum, behind), (np.maximum, behind)))
    behind[order] = np.where(low == high, low, BRANCH)
    counts = np.ones(len(order), np.int64)
    counts[order] = np.where(head, count - np.add.reduceat(~later, heads)[group] + 1, 1)
    rows = []
    place = found.first - starts
    for which, to, done in ((order[~later], (found.key % U64(n)).astype(np.int64), False), (order[later], okeys % n, True)):
        if not len(which):
            continue
        which = which[np.argsort(to[which], kind="stable")]
        firsts = np.flatnonzero(np.concatenate([[True], to[which][1:] != to[which][:-1]]))
        for a, b in zip(firsts, np.append(firsts[1:], len(which)), strict=True):
            i = which[a:b]
            chain = b""
            if not done:
                flat = np.empty(int(sizes[i].sum()) + 2 * len(i), U64)
                first = np.cumsum(sizes[i] + 2) - sizes[i] - 2
                flat[first], flat[first + sizes[i] + 1] = before[i], behind[i]
                flat[ranges(first + 1, sizes[i])] = edges[ranges(found.first[i], sizes[i])]
                chain = flat.tobytes()
            arrays = (sizes[i], okeys[i], tags[i], place[i], counts[i])
            rows.append((int(to[i[0]]), chain, *(x.tobytes() for x in arrays), done))
    kinds = (pa.int32(), *[pa.binary()] * 6, pa.bool_())
    names = ["bucket", "edges", "sizes", "okeys", "tags", "starts", "counts", "done"]
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)


_PIECES = (
    "head long, tail long, n long, before long, behind long, total long, listed long, okey long, tag long, start long, "
    "later_okeys array<long>, later_tags array<long>, later_starts array<long>"
)


def pieces(flat: np.ndarray, sizes: np.ndarray, okeys: np.ndarray, tags: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> pa.RecordBatch | None:
    """Runs of repeated edges without a branch in one bucket, each once, with the later documents' places of its first edge."""
    first = np.cumsum(sizes + 2) - sizes - 2
    at = ranges(first + 1, sizes)
    chain = np.repeat(np.arange(len(sizes)), sizes)
    edge, before, behind = flat[at], flat[at - 1], flat[at + 1]
    place = starts[chain] + ranges(np.zeros(len(sizes), np.int64), sizes)
    # A chain's inner neighbours are single where they are; only its ends may stand for several places.
    okey, tag, count = okeys[chain], tags[chain], counts[chain]
    order = np.lexsort((place, tag, okey, edge))
    head = np.concatenate([[True], edge[order][1:] != edge[order][:-1]])
    heads = np.flatnonzero(head)
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(head) - 1
    stop = np.append(heads[1:], len(order))
    total = np.add.reduceat(count[order], heads)
    least, most = okey[order][heads], okey[order][stop - 1]
    repeated = (least < most) | (total > stop - heads)

    def single(x: np.ndarray) -> np.ndarray:
        low, high = np.minimum.reduceat(x[order], heads), np.maximum.reduceat(x[order], heads)
        return np.where((low == high) & (low != BRANCH), low, END)

    one_before, one_behind = single(before), single(behind)
    owner = np.zeros(len(order), bool)
    owner[order[heads]] = True
    # linked[i]: no branch between occurrence i and the one behind it in its chain.
    linked = np.zeros(len(order), bool)
    a, b = group[:-1], group[1:]
    linked[:-1] = (chain[:-1] == chain[1:]) & repeated[a] & repeated[b] & (one_behind[a] == edge[1:]) & (one_before[b] == edge[:-1]) & (total[a] == total[b])
    begins = np.flatnonzero(owner & repeated[group] & ~np.concatenate([[False], linked[:-1]]))
    if not len(begins):
        return None
    breaks = np.flatnonzero(~linked)
    ends = breaks[np.searchsorted(breaks, begins)]
    g, t = group[begins], group[ends]
    # Later places: the group's occurrences, which stand in order of document, behind those of the first document.
    in_first = np.add.reduceat((okey[order] == np.repeat(least, stop - heads)).astype(np.int64), heads)
    later = (heads + in_first)[g]
    lengths = stop[g] - later
    which = order[ranges(later, lengths)]
    ends_of = np.concatenate([[0], np.cumsum(lengths)])
    cuts = pa.array(ends_of.astype(np.int32))
    # One number for the set of later places, relative to the first: tasks have settled some places of one piece and not of another.
    shift = (place[which] - np.repeat(place[begins], lengths)).astype(U64)
    summed = np.concatenate([np.zeros(1, U64), np.cumsum(mix(okey[which].astype(U64) ^ mix(tag[which] ^ mix(shift))), dtype=U64)])
    listed = summed[ends_of[1:]] - summed[ends_of[:-1]]
    longs = lambda x: pa.array(np.ascontiguousarray(x).view(np.int64))
    columns = [longs(edge[begins]), longs(edge[ends]), pa.array(ends - begins + 1), longs(one_before[g]), longs(one_behind[t]), pa.array(total[g]), longs(listed)]
    columns += [pa.array(okey[begins]), longs(tag[begins]), pa.array(place[begins])]
    columns += [pa.ListArray.from_arrays(cuts, longs(x[which])) for x in (okey, tag, place)]
    return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _PIECES.split(", ")])


# --- Spark -------------------------------------------------------------------------------------------------------------


def edge_tables(base: DataFrame, firsts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pieces, done): the runs of all buckets, and windows (__okey, tag, start, n) that their task settled."""
    spark = base.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    facts = firsts.join(repeated_anchors(base, firsts, word_anchors), "__okey")
    rows = with_facts(base.select("__okey", "__sha", "text"), facts).filter(IS_FIRST).select("__okey", "__sha", "text", "__places")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, at in text_slices(batch):
                found, offsets, hashes = _word_anchors(data, at)
                found = known_anchors(found, offsets, part.column("__places"))
                if len(found.at):
                    yield from _packed_edges(found, offsets, hashes, part, n)

    names = [c.split()[0] for c in _PIECES.split(", ")]

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                arrays = [np.frombuffer(x, t) for x, t in zip(row[1:7], _ARRAYS, strict=True)]
                if row[7]:
                    # Settled windows travel in the same table: no head, and the place in the owner's columns.
                    _, sizes, okeys, tags, starts, _ = arrays
                    none, lists = pa.nulls(len(sizes), pa.int64()), pa.nulls(len(sizes), pa.list_(pa.int64()))
                    columns = [none, none, pa.array(sizes), none, none, none, none, pa.array(okeys), pa.array(tags.view(np.int64)), pa.array(starts), lists, lists, lists]
                    yield pa.RecordBatch.from_arrays(columns, names)
                else:
                    held.append(arrays)
        if held:
            made = pieces(*(np.concatenate(x) for x in zip(*held, strict=True)))
            if made is not None:
                yield made

    both = stored(rows.mapInArrow(cut, _EDGES).repartitionById(n, "bucket").mapInArrow(build, _PIECES))
    done = both.filter("head IS NULL").select(F.col("okey").alias("__okey"), "tag", "start", "n")
    return both.filter("head IS NOT NULL"), done


def compacted(parts: DataFrame) -> DataFrame:
    """Paths: head, n, okey, tag and start in the first document. Pieces whose ends name each other are one path where the
    first document has them side by side."""
    ends = parts.select(F.col("behind").alias("__head"), F.col("tail").alias("__before"), F.col("total").alias("__total"), F.col("listed").alias("__listed")).filter(
        "__head <> 0"
    )
    follows = (F.col("head") == F.col("__head")) & (F.col("before") == F.col("__before")) & (F.col("total") == F.col("__total")) & (F.col("listed") == F.col("__listed"))
    linked = (
        parts.select("head", "before", "n", "total", "listed", "okey", "tag", "start")
        .join(ends, follows, "left")
        .select("head", "n", "okey", "tag", "start", F.col("__head").isNotNull().alias("linked"))
    )
    line = Window.partitionBy("okey", "tag").orderBy("start")
    beside = F.lag(F.col("start") + F.col("n")).over(line) == F.col("start")
    new = F.when(F.col("linked") & beside, 0).otherwise(1)
    numbered = linked.withColumn("new", new).withColumn("path", F.sum("new").over(line))
    return numbered.groupBy("okey", "tag", "path").agg(F.min_by("head", "start").alias("head"), F.sum("n").alias("n"), F.min("start").alias("start")).drop("path")


def word_digest(words: list[bytes]) -> bytes:
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest()


def with_digests(base: DataFrame, paths: DataFrame) -> DataFrame:
    """head, n and the digest of every path's words, read in its first document. A path of n windows has n + 12 words."""
    listed = paths.groupBy(F.col("okey").alias("__okey")).agg(F.collect_list(F.struct("tag", "start", "n", "head")).alias("__paths"))
    rows = with_facts(base.select("__okey", "__sha", "text"), listed).select("__sha", "text", "__paths")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tags = _tags(batch.column("__sha")).view(np.int64).tolist()
            out = []
            for tag, text, found in zip(tags, batch.column("text").cast(pa.binary()).to_pylist(), batch.column("__paths").to_pylist(), strict=True):
                words = (text or b"").split()
                out += [(p["head"], p["n"], word_digest(words[p["start"] : p["start"] + p["n"] + WINDOW - 1])) for p in found if p["tag"] == tag]
            if out:
                columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.binary()), strict=True)]
                yield pa.RecordBatch.from_arrays(columns, ["head", "n", "digest"])

    # Rows that repeat a document give the same path again.
    return rows.mapInArrow(run, "head long, n long, digest binary").dropDuplicates(["head"])


def repeated_windows(base: DataFrame, firsts: DataFrame) -> DataFrame:
    """__okey and __spans (tag, start, n, digest): n windows from word `start` on that a document before has, too. A null digest
    needs no verification."""
    parts, done = edge_tables(base, firsts)
    paths = with_digests(base, compacted(parts))
    places = F.explode(F.arrays_zip("later_okeys", "later_tags", "later_starts"))
    later = parts.select("head", "later_okeys", "later_tags", "later_starts").join(paths, "head").select("n", "digest", places.alias("p"))
    spans = later.select(F.col("p.later_okeys").alias("__okey"), F.col("p.later_tags").alias("tag"), F.col("p.later_starts").alias("start"), "n", "digest")
    both = spans.unionByName(done.withColumn("digest", F.lit(None).cast("binary")))
    return stored(both.groupBy("__okey").agg(F.collect_list(F.struct("tag", "start", "n", "digest")).alias("__spans")))


def _texts_and_spans(batch: pa.RecordBatch) -> Iterator[tuple[list[bytes], list[tuple[int, int]]]]:
    """Every row's words, and the ranges of words to take out."""
    tags = _tags(batch.column("__sha")).view(np.int64).tolist()
    columns = (batch.column(c).to_pylist() for c in ("__sha", "__firsts", "__spans"))
    for text, tag, sha, first, found in zip(batch.column("text").cast(pa.binary()).to_pylist(), tags, *columns, strict=True):
        words = (text or b"").split()
        if sha not in (first or ()):
            yield words, [(0, len(words))] if len(words) >= WINDOW else []
            continue
        spans = []
        for s in found or ():
            stop = s["start"] + s["n"] + WINDOW - 1
            if s["tag"] == tag and (s["digest"] is None or word_digest(words[s["start"] : stop]) == s["digest"]):
                spans.append((s["start"], stop))
        yield words, united(spans)


def kept_words(words: list[bytes], spans: list[tuple[int, int]]) -> bytes:
    edges = [0, *(e for s in spans for e in s), len(words)]
    return b" ".join(w for a, b in zip(edges[::2], edges[1::2], strict=True) for w in words[a:b])


def _with_spans(docs: DataFrame) -> DataFrame:
    base = bucketed(docs)
    firsts = first_texts(base)
    return with_facts(base, firsts.join(repeated_windows(base, firsts), "__okey", "left"), "left")


def removal_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(len(w), sum(b - a for a, b in s), hashlib.sha256(kept_words(w, s)).hexdigest()) for w, s in _texts_and_spans(batch)]
            if rows:
                columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.string()), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "n_words", "n_removed", "kept_sha256"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = _with_spans(docs.select("doc_id", "text")).select("doc_id", "text", "__sha", "__firsts", "__spans")
    return rows.mapInArrow(run, f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string")


def without_repeats(docs: DataFrame) -> DataFrame:
    """The documents with repeated windows taken out of `text`, all columns kept. Texts that lose nothing stay as they are; of the
    others the kept words are joined by one space."""

    names, schema = docs.columns, docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [kept_words(w, s).decode() if s else None for w, s in _texts_and_spans(batch)]
            old = batch.column("text")
            new = pa.array([o if t is None else t for t, o in zip(texts, old.to_pylist(), strict=True)], old.type)
            yield pa.RecordBatch.from_arrays([new if c == "text" else batch.column(c) for c in names], names)

    return _with_spans(docs).select(*names, "__sha", "__firsts", "__spans").mapInArrow(run, schema)


def op9_graph_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removal_report(table(spark, sf_dir, "documents"))


OP9_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
places AS (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13),
windows AS (SELECT doc_id, i, md5(array_to_string(w[i : i + 12], ' ')) AS win FROM places),
firsts AS (SELECT win, min(doc_id) AS least FROM windows GROUP BY win),
repeated AS (SELECT doc_id, i FROM windows JOIN firsts USING (win) WHERE doc_id > least),
gone AS (SELECT DISTINCT doc_id, i + k AS place, true AS cut FROM repeated, range(13) AS t(k)),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS place FROM d),
kept AS (
  SELECT doc_id, count(*) FILTER (cut) AS n_removed, string_agg(word, ' ' ORDER BY place) FILTER (cut IS NULL) AS rest
  FROM words LEFT JOIN gone USING (doc_id, place) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(rest, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""
