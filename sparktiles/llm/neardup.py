"""Near-duplicates by improved consistent weighted sampling over TF-IDF shingles.

A text is the weighted set of its five-word shingles: times in the text x mean inverse document frequency of the five words. Word
frequencies are counted over all documents in 2^DF_BITS hashed buckets, so the table that every task gets has a fixed size; a
table of the shingles' own frequencies would be as large as the corpus, and would make a text's shingles count less the more
copies of it there are. A text of one to four words is one shingle; texts without words are all alike.

HASHES samples are drawn per text such that two texts agree in one with the probability of their weighted Jaccard similarity.
Bands of ROWS samples bucket the texts. In every bucket all are compared with a few pivots, the texts that share most buckets;
then, in blocks, those outside the bucket's largest class with everyone of another class. Only texts that are of one class already
are not compared, so no link between classes is lost, and a bucket costs its size times the texts outside its largest class.
Compared means: a bound that no similar pair fails, then the exact weighted Jaccard similarity of the texts; a text's best estimates
from the samples are tried first. For the bound a text's weights are added up by BINS ranges of the shingles' hashes: what two texts
have in common is at most the sum of the lesser weights of each range. Linked texts are classes, found by alternating stars. Equal
texts are one text throughout.

At a similarity of 0.8 a pair shares no bucket once in 100,000. Null texts are empty. Class ids are the smallest doc_id of the
class, null only if no document of it has an id.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .anchors import LAST
from .common import U64, Words, arrow_map, gram_places, grams, mix, multipliers, shared_folder, stored, table, text_slices

SHINGLE, SIMILARITY = 5, 0.8
ROWS, BANDS = 3, 16
HASHES = ROWS * BANDS
#: Ranges of hashes, a power of two, by which a text's weights are added up for the bound; and the bytes that stand for a text where
#: texts are compared: 16 bits of each sample, the total of the weights, one byte for each range.
BINS = 256
FACE = 2 * HASHES + 4 + BINS
#: Shares of the total that a range's byte may stand for: none, then BINS * 32 parts in steps of equal ratio.
LEVELS = np.concatenate([[0], np.exp(np.linspace(-np.log(BINS * 32), 0, 255))]).astype(np.float32)
DF_BITS = 16
#: Pivots of a bucket in the first rounds, and texts that are compared with them in one place; texts on a side of a block after them; pairs
#: a text gives at first.
PIVOTS, PART_TEXTS, BLOCK_TEXTS, FIRST_PAIRS = (1, 4, 16), 4096, 512, 2
#: Links that are few enough to be joined to classes on the driver.
FEW_LINKS = 50_000
#: Shingles looked at together: bounds the memory of a long text.
BLOCK = 4096


# --- Weighted shingles -------------------------------------------------------------------------------------------------


def shingles(words: Words, hashes: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(shingles, weights, row offsets): each row's distinct shingles in ascending order."""
    weight = idf[(hashes >> U64(64 - DF_BITS)).astype(np.int64)]
    running = np.concatenate([[0.0], np.cumsum(weight)])
    places = gram_places(words.offsets, SHINGLE)
    rows = words.rows()[places]
    found = grams(hashes, SHINGLE)[places] if len(places) else np.zeros(0, U64)
    mean = (running[places + SHINGLE] - running[places]) / SHINGLE
    short = np.flatnonzero(words.counts < SHINGLE)
    if len(short):
        first, counts = words.offsets[short], words.counts[short]
        whole = mix(counts.astype(U64) + U64(77))
        for j, m in enumerate(multipliers(SHINGLE - 1, 41)):
            at = np.minimum(first + j, max(0, len(hashes) - 1))
            whole = whole + np.where(j < counts, hashes[at] * m if len(hashes) else U64(0), U64(0))
        rows, found = np.concatenate([rows, short]), np.concatenate([found, mix(whole)])
        mean = np.concatenate([mean, np.where(counts > 0, (running[first + counts] - running[first]) / np.maximum(counts, 1), 1.0)])
    order = np.lexsort((found, rows))
    rows, found, mean = rows[order], found[order], mean[order]
    head = np.flatnonzero(np.concatenate([[True], (found[1:] != found[:-1]) | (rows[1:] != rows[:-1])]))
    times = np.diff(np.append(head, len(found)))
    return found[head], (times * mean[head]).astype(np.float32), np.searchsorted(rows[head], np.arange(len(words.counts) + 1))


class Sampler:
    """Improved consistent weighted sampling. The random numbers of a shingle and a sample are drawn from tables of the
    distributions at places hashed from both."""

    def __init__(self, samples: int = HASHES, seed: int = 17) -> None:
        draw = np.random.default_rng(seed)
        self.r = draw.gamma(2, 1, 1 << 16).astype(np.float32)
        self.log_c = np.log(draw.gamma(2, 1, 1 << 16)).astype(np.float32)
        self.beta = draw.random(1 << 16).astype(np.float32)
        self.functions = multipliers(samples, seed)[:, None]

    def of(self, found: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """32-bit samples of one text."""
        logs = np.log(weights)
        best = np.full(len(self.functions), np.inf, np.float32)
        out = np.zeros(len(self.functions), U64)
        line = np.arange(len(self.functions))
        for low in range(0, len(found), BLOCK):
            s = found[low : low + BLOCK]
            h = self.functions * s[None, :]
            r = self.r[(h >> U64(48)).astype(np.int64)]
            beta = self.beta[((h >> U64(32)) & U64(0xFFFF)).astype(np.int64)]
            t = np.floor(logs[low : low + BLOCK] / r + beta)
            a = self.log_c[((h >> U64(16)) & U64(0xFFFF)).astype(np.int64)] - r * (t - beta) - r
            least = a.argmin(axis=1)
            value = a[line, least]
            better = value < best
            sample = mix(s[least] ^ mix(t[line, least].astype(np.int64).astype(U64)))
            best, out = np.where(better, value, best), np.where(better, sample, out)
        return (out >> U64(32)).astype(np.uint32)


def weighted_jaccard(a: np.ndarray, wa: np.ndarray, b: np.ndarray, wb: np.ndarray) -> float:
    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    least = np.minimum(wa[i], wb[j]).sum(dtype=np.float64)
    return float(least / (wa.sum(dtype=np.float64) + wb.sum(dtype=np.float64) - least))


def face(drawn: np.ndarray, found: np.ndarray, weights: np.ndarray) -> bytes:
    """What a text is compared by before its shingles are: FACE bytes. Weights of a range are rounded up."""
    ranged = np.bincount((found >> U64(64 - BINS.bit_length() + 1)).astype(np.int64), weights, minlength=BINS)
    total = np.array([ranged.sum()], np.float32)
    level = np.searchsorted(LEVELS, (ranged / max(total[0], 1e-30)).astype(np.float32)).clip(0, 255)
    return drawn.astype(np.uint16).tobytes() + total.tobytes() + level.astype(np.uint8).tobytes()


class Faces:
    """Faces of many texts: samples, weights by range, and totals."""

    def __init__(self, joined: bytes) -> None:
        raw = np.frombuffer(joined, np.uint8).reshape(-1, FACE)
        self.samples = raw[:, : 2 * HASHES].copy().view(np.uint16)
        total = raw[:, 2 * HASHES : 2 * HASHES + 4].copy().view(np.float32)
        self.totals = total[:, 0]
        self.ranged = LEVELS[raw[:, 2 * HASHES + 4 :]] * total

    def may_reach(self, a: np.ndarray | int, b: np.ndarray, similarity: float) -> np.ndarray:
        """Whether pairs can be as similar as that; never false for a pair that is."""
        common = np.minimum(self.ranged[a], self.ranged[b]).sum(axis=1)
        return common * (1 + similarity) >= similarity * (self.totals[a] + self.totals[b]) * (1 - 1e-4)

    def equal(self, a: np.ndarray | int, b: np.ndarray) -> np.ndarray:
        return (self.samples[a] == self.samples[b]).sum(axis=1)


# --- Spark: from documents to samples ----------------------------------------------------------------------------------


def word_frequencies(docs: DataFrame) -> np.ndarray:
    """Inverse document frequency by bucket of words: 1 + ln((1 + documents) / (1 + documents with a word of the bucket)). At
    most 2^DF_BITS numbers come to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, n = np.zeros(1 << DF_BITS, np.int64), 0
        for batch in batches:
            n += batch.num_rows
            for _, data, at in text_slices(batch):
                words = Words(data, at)
                bucket = (words.hashes() >> U64(64 - DF_BITS)).astype(np.int64)
                counts += np.bincount(np.unique(words.rows() << DF_BITS | bucket) & ((1 << DF_BITS) - 1), minlength=len(counts))
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(used, -1)), pa.array(np.append(counts[used], n))], ["bucket", "n"])

    found = docs.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    counts = {r.bucket: r.n for r in found}
    total = counts.pop(-1, 0)
    df = np.zeros(1 << DF_BITS)
    df[list(counts)] = list(counts.values())
    return 1 + np.log((1 + total) / (1 + df))


def _text_id() -> F.Column:
    """16 bytes that stand for a text."""
    return F.substring(F.unhex(F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)), 1, 16)


def _order_key() -> F.Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST))


def samples(docs: DataFrame, idf: np.ndarray) -> DataFrame:
    """doc_id, id, okey, samples and face of every row; a narrow table, written once."""
    shared = docs.sparkSession.sparkContext.broadcast(idf)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def make():
        sampler = Sampler()

        def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for part, data, at in text_slices(batch):
                words = Words(data, at)
                found, weights, cuts = shingles(words, words.hashes(), shared.value)
                rows = [(found[a:b], weights[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                drawn = [sampler.of(*row) for row in rows]
                made = [pa.array([x.tobytes() for x in drawn], pa.binary()), pa.array([face(x, *row) for x, row in zip(drawn, rows, strict=True)], pa.binary())]
                columns = [part.column(c) for c in ("doc_id", "id", "okey")]
                yield pa.RecordBatch.from_arrays([*columns, *made], ["doc_id", "id", "okey", "samples", "face"])

        return step

    rows = docs.select("doc_id", _text_id().alias("id"), _order_key().alias("okey"), "text")
    return stored(arrow_map(rows, make, f"doc_id {kind}, id binary, okey long, samples binary, face binary"))


def _bucketed(rows: DataFrame, key: str) -> DataFrame:
    spark = rows.sparkSession
    n, name = int(spark.conf.get("spark.sql.shuffle.partitions")), f"llm_{uuid.uuid4().hex}"
    rows.write.bucketBy(n, key).option("compression", "zstd").option("path", shared_folder(spark)).saveAsTable(name)
    found = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the name only: the files are in the shared folder
    return found


def _halved(found: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shingles by the upper half of their hash, ascending as they are; those few of a text that share it count as one."""
    half = (found >> U64(32)).astype(np.uint32)
    heads = np.flatnonzero(np.concatenate([[True], half[1:] != half[:-1]]))
    return half[heads], np.add.reduceat(weights, heads).astype(np.float32)


def vectors(docs: DataFrame, wanted: DataFrame, idf: np.ndarray) -> DataFrame:
    """id, shingles (32 bits each) and weights of the texts whose id is wanted, bucketed by id."""
    shared = docs.sparkSession.sparkContext.broadcast(idf)
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, at in text_slices(batch):
                words = Words(data, at)
                found, weights, cuts = shingles(words, words.hashes(), shared.value)
                rows = [_halved(found[a:b], weights[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                columns = [pa.array([x.tobytes() for x in c], pa.binary()) for c in zip(*rows, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("id"), *columns], ["id", "shingles", "weights"])

    rows = docs.select(_text_id().alias("id"), _order_key().alias("okey"), "text").repartition(n, "id")
    # One row per text: its first document's.
    first = rows.join(wanted.hint("shuffle_hash"), ["id", "okey"], "left_semi")
    return _bucketed(first.select("id", "text").mapInArrow(run, "id binary, shingles binary, weights binary"), "id")


# --- Spark: from samples to links --------------------------------------------------------------------------------------


def band_keys(drawn: np.ndarray) -> np.ndarray:
    """(texts, bands): a hash of each ROWS samples and their place."""
    salts, places = multipliers(ROWS, 51), mix(np.arange(BANDS, dtype=U64))
    return mix((mix(drawn.reshape(-1, BANDS, ROWS).astype(U64)) * salts).sum(axis=2, dtype=U64) ^ places).view(np.int64)


def bands(texts: DataFrame) -> DataFrame:
    """id and band of every text, BANDS rows each."""

    def make():
        def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            keys = band_keys(np.frombuffer(b"".join(batch.column("samples").to_pylist()), np.uint32))
            which = pa.array(np.repeat(np.arange(batch.num_rows), BANDS))
            yield pa.RecordBatch.from_arrays([batch.column("id").take(which), pa.array(keys.ravel())], ["id", "band"])

        return step

    return arrow_map(texts.select("id", "samples"), make, "id binary, band long")


def _shared(rows: DataFrame) -> DataFrame:
    """id, band and n, the bucket's size, where it is two or more."""
    sizes = rows.groupBy("band").agg(F.count("*").alias("n")).filter("n > 1")
    return rows.select("id", "band").join(sizes, "band").select("id", "band", "n")


def _verified(pairs: DataFrame, vectors: DataFrame, similarity: float) -> DataFrame:
    """Pairs whose weighted Jaccard similarity is reached."""
    other = vectors.select(F.col("id").alias("pivot"), F.col("shingles").alias("shingles2"), F.col("weights").alias("weights2"))
    both = pairs.join(vectors, "id").join(other, "pivot")
    names = ("shingles", "weights", "shingles2", "weights2")

    def make():
        def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            ok = []
            for a, wa, b, wb in zip(*(batch.column(c) for c in names), strict=True):
                arrays = [np.frombuffer(x.as_buffer(), t) for x, t in ((a, np.uint32), (wa, np.float32), (b, np.uint32), (wb, np.float32))]
                ok.append(weighted_jaccard(*arrays) >= similarity)
            yield batch.select(["id", "pivot"]).filter(pa.array(ok, pa.bool_()))

        return step

    return arrow_map(both.select("id", "pivot", *names), make, "id binary, pivot binary")


def _open(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """id, band, degree, root and the bucket's facts, of buckets whose texts are not all of one class yet: `main` is the class with
    most texts of the bucket, `others` and `mains` count the texts outside and inside it."""
    labelled = rows.select("id", "band", "degree").join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    per_class = labelled.groupBy("band", "root").agg(F.count("*").alias("n"))
    facts = per_class.groupBy("band").agg(F.max(F.struct("n", "root")).alias("most"), F.sum("n").alias("all"))
    facts = facts.filter("all > most.n").select("band", F.col("most.root").alias("main"), F.col("most.n").alias("mains"), (F.col("all") - F.col("most.n")).alias("others"))
    return stored(labelled.join(facts, "band").select("id", "band", "degree", "root", "main", "others", "mains"))


def _pivot_pairs(rows: DataFrame, texts: DataFrame, most: int, similarity: float) -> DataFrame:
    """id and pivot: the FIRST_PAIRS likeliest pairs of a text with a pivot of another class, over all its open buckets.

    Buckets are dealt out in parts of about PART_TEXTS texts, each with all pivots in front, and faces are compared where they
    stand: only pairs that may be similar leave the task."""
    order = Window.partitionBy("band").orderBy(F.desc("degree"), "id")
    parts = F.ceil((F.col("others") + F.col("mains")) / PART_TEXTS).cast("int")
    named = rows.select("band", "id", "root", "degree", parts.alias("__parts"))
    pivots = named.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)
    pivots = pivots.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("__parts") - 1)))
    members = named.withColumns({"rank": F.lit(most + 1), "part": F.expr("int(pmod(xxhash64(id), __parts))")})
    columns = ("band", "part", "rank", "id", "root")
    both = pivots.select(*columns).unionByName(members.select(*columns)).join(texts.select("id", "face"), "id")
    dealt = both.select(*columns, "face").repartition("band", "part").sortWithinPartitions("band", "part", "rank", "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None  # the pivots of the group that the last batch ended in
        for batch in batches:
            if not batch.num_rows:
                continue
            block = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            band, part, rank = (block.column(c).to_numpy() for c in ("band", "part", "rank"))
            ids, roots = (np.array(block.column(c).to_pylist(), "S16") for c in ("id", "root"))
            known = Faces(b"".join(block.column("face").to_pylist()))
            begins = np.concatenate([[True], (band[1:] != band[:-1]) | (part[1:] != part[:-1])])
            group = np.cumsum(begins) - 1
            first = np.flatnonzero(begins)[group]
            names = block.column("id").combine_chunks()
            for k in range(most):
                a = np.flatnonzero(rank > most)
                b = np.minimum(first[a] + k, len(band) - 1)
                fit = (group[a] == group[b]) & (rank[b] <= most) & (roots[a] != roots[b]) & (ids[a] != ids[b])
                a, b = a[fit], b[fit]
                like = known.may_reach(a, b, similarity)
                a, b = a[like], b[like]
                if len(a):
                    yield pa.RecordBatch.from_arrays([names.take(pa.array(a)), names.take(pa.array(b)), pa.array(known.equal(a, b).astype(np.int32))], ["id", "pivot", "equal"])
            held = block.filter(pa.array((group == group[-1]) & (rank <= most)))

    found = dealt.mapInArrow(run, "id binary, pivot binary, equal int")
    best = found.groupBy("id").agg(F.slice(F.sort_array(F.collect_set(F.struct("equal", "pivot")), asc=False), 1, FIRST_PAIRS).alias("best"))
    return best.select("id", F.explode("best").alias("best")).select("id", F.col("best.pivot").alias("pivot"))


def _blocks(rows: DataFrame) -> DataFrame:
    """Rows of open buckets with the block (i, kind, j) they are compared in: some texts outside the main class with some inside it, or
    with some others outside. A block has about 2 * BLOCK_TEXTS texts; a bucket has so many blocks that every pair of different classes
    meets."""
    outer, inner = (F.ceil(F.col(c) / BLOCK_TEXTS).cast("int") for c in ("others", "mains"))
    rows = rows.withColumns({"__outer": outer, "__inner": inner, "__hash": F.xxhash64("id", "band")})
    inside = rows.filter("root = main").withColumns({"i": F.explode(F.sequence(F.lit(0), F.col("__outer") - 1)), "kind": F.lit(0), "j": F.expr("int(pmod(__hash, __inner))")})
    outside = rows.filter("root <> main").withColumn("__own", F.expr("int(pmod(__hash, __outer))"))
    with_main = outside.withColumns({"i": F.col("__own"), "kind": F.lit(0), "j": F.explode(F.sequence(F.lit(0), F.col("__inner") - 1))})
    other = outside.filter("__outer > 1").withColumn("__other", F.explode(F.sequence(F.lit(0), F.col("__outer") - 1))).filter("__own <> __other")
    with_other = other.withColumns({"i": F.least("__own", "__other"), "kind": F.lit(1), "j": F.greatest("__own", "__other")})
    names = ("id", "band", "root", "main", "i", "kind", "j")
    return inside.select(*names).unionByName(with_main.select(*names)).unionByName(with_other.select(*names))


def _likely(ids: np.ndarray, known: Faces, roots: np.ndarray, outside: np.ndarray, most: int, similarity: float) -> tuple[list, bool]:
    """(a, b) of texts of different classes in a block that may be similar, and whether some were left for later: a text gives its
    `most` best pairs."""
    out, cut = [], False
    for a in np.flatnonzero(outside):
        b = np.flatnonzero((roots != roots[a]) & (~outside | (np.arange(len(ids)) > a)))
        b = b[known.may_reach(a, b, similarity)]
        order = np.lexsort((ids[b], -known.equal(a, b)))
        cut |= len(b) > most
        out += [(a, x) for x in b[order[:most]]]
    return out, cut


def _cross_pairs(rows: DataFrame, texts: DataFrame, most: int, similarity: float) -> DataFrame:
    """id and pivot of likely pairs between classes of open buckets; a row of nulls where some were left for later."""
    both = _blocks(rows).join(texts.select("id", "face"), "id")

    def run(block: pa.Table) -> pa.Table:
        ids, roots, main = (np.array(block.column(c).to_pylist(), "S16") for c in ("id", "root", "main"))
        known = Faces(b"".join(block.column("face").to_pylist()))
        found, cut = _likely(ids, known, roots, roots != main, most, similarity)
        names = block.column("id").to_pylist()
        left, right = [max(names[a], names[b]) for a, b in found], [min(names[a], names[b]) for a, b in found]
        left, right = (x + [None] * cut for x in (left, right))
        return pa.table({"id": pa.array(left, pa.binary()), "pivot": pa.array(right, pa.binary())})

    return both.groupBy("band", "i", "kind", "j").applyInArrow(run, "id binary, pivot binary")


def _joined(roots: DataFrame, matched: DataFrame) -> DataFrame:
    """Classes (id and root) after some more links."""
    ends = matched.join(roots, "id", "left").select("pivot", F.coalesce("root", "id").alias("a"))
    ends = ends.join(roots.select(F.col("id").alias("pivot"), "root"), "pivot", "left").select(F.col("a").alias("id"), F.coalesce("root", "pivot").alias("pivot"))
    more = stored(components(ends)).withColumnRenamed("root", "newer")
    old = roots.join(more.withColumnRenamed("id", "root"), "root", "left").select("id", F.coalesce("newer", "root").alias("root"))
    own = more.join(roots, "id", "left_anti").select("id", F.col("newer").alias("root"))
    return stored(old.unionByName(own))


def links(docs: DataFrame, texts: DataFrame, idf: np.ndarray, similarity: float = SIMILARITY) -> DataFrame:
    """id and pivot of similar texts. Rounds with pivots join most texts of a bucket cheaply; then any two texts of a bucket that are
    still of different classes are compared, so a text leaves only with a bucket that is one class."""
    members = stored(_shared(bands(texts)))
    if members.isEmpty():
        return members.select("id", F.col("id").alias("pivot"))
    wanted = texts.select("id", "okey").join(members.select("id").distinct(), "id", "left_semi")
    known = vectors(docs, wanted, idf)
    # Texts that share most buckets come first: of a group of edited copies that is the text they are copies of.
    degree = stored(members.groupBy("id").agg(F.sum("n").alias("degree")))
    ranked = stored(members.select("id", "band").join(degree, "id"))
    found = texts.sparkSession.createDataFrame([], "id binary, pivot binary")
    tested, roots = found, texts.sparkSession.createDataFrame([], "id binary, root binary")

    def settle(pairs: DataFrame) -> None:
        nonlocal found, roots
        matched = stored(_verified(pairs, known, similarity))
        found, roots = found.unionByName(matched), _joined(roots, matched)

    for most in PIVOTS:
        rows = _open(ranked, roots)
        if rows.isEmpty():
            return found.distinct()
        settle(stored(_pivot_pairs(rows, texts, most, similarity)))
    most = FIRST_PAIRS
    while True:
        rows = _open(ranked, roots)
        if rows.isEmpty():
            return found.distinct()
        pairs = stored(_cross_pairs(rows, texts, most, similarity).distinct())
        fresh = stored(pairs.filter("id IS NOT NULL").join(tested, ["id", "pivot"], "left_anti"))
        settle(fresh)
        if pairs.filter("id IS NULL").isEmpty():
            return found.distinct()
        tested, ranked, most = tested.unionByName(fresh), rows.select("id", "band", "degree"), most * 8


# --- Spark: classes ----------------------------------------------------------------------------------------------------


def _stars(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step on edges (a, b); every step joins nodes to smaller ones of their component."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
    # Each node with the smaller ones only.
    down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    down = stored(down)
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    small = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return stored(small.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())


def _few_components(edges: list[tuple[bytes, bytes]]) -> list[tuple[bytearray, bytearray]]:
    up: dict[bytes, bytes] = {}

    def top(x: bytes) -> bytes:
        while (y := up.get(x, x)) != x:
            up[x] = up.get(y, y)
            x = y
        return x

    for a, b in edges:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return [(bytearray(x), bytearray(top(x))) for x in list(up) if top(x) != x]


def components(found: DataFrame) -> DataFrame:
    """id and root (the smallest id) of every linked text."""
    edges = stored(found.filter("id <> pivot").select(F.greatest("id", "pivot").alias("a"), F.least("id", "pivot").alias("b")).distinct())
    few = edges.limit(FEW_LINKS + 1).collect()
    if len(few) <= FEW_LINKS:
        return edges.sparkSession.createDataFrame(_few_components([(bytes(r.a), bytes(r.b)) for r in few]), "id binary, root binary")
    mark = lambda e: tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
    before = mark(edges)
    while before[0]:
        edges = _stars(edges)
        after = mark(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("id"), F.col("b").alias("root"))


def classes(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, okey, id (of the text), class_id and kept of every row; kept is true for the rows of one document per class."""
    idf = word_frequencies(docs)
    rows = samples(docs, idf)
    texts = _bucketed(rows.groupBy("id").agg(F.min("okey").alias("okey"), F.first("samples").alias("samples"), F.first("face").alias("face")), "id")
    rooted = stored(components(links(docs, texts, idf, similarity)))
    roots = rooted.unionByName(rooted.select(F.col("root").alias("id"), "root").distinct())
    of_text = texts.select("id", "okey").join(roots, "id", "left").select("id", "okey", F.coalesce("root", "id").alias("root"))
    # The first document of a class: smallest key, then smallest text id.
    leaders = of_text.groupBy("root").agg(F.min(F.struct("okey", "id")).alias("first"))
    known = stored(of_text.join(leaders, "root").select("id", F.col("first.okey").alias("class_key"), F.col("first.id").alias("class_text")))
    joined = rows.select("doc_id", "okey", "id").join(known, "id")
    class_id = F.when(F.col("class_key") != LAST, F.col("class_key"))
    kept = (F.col("okey") == F.col("class_key")) & (F.col("id") == F.col("class_text"))
    return joined.select("doc_id", "okey", "id", class_id.alias("class_id"), kept.alias("kept"))


def without_near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One document of each class, the one with the smallest doc_id, with all its columns. Of rows that repeat it, one stays."""
    found = stored(classes(docs, similarity).filter("kept").groupBy("id", "okey").agg(F.count("*").alias("times")))
    facts = found.select(F.col("id").alias("__id"), F.col("okey").alias("__okey"), "times").withColumnRenamed("times", "__times")
    marked = docs.withColumns({"__id": _text_id(), "__okey": _order_key()})
    kept = marked.join(facts.hint("shuffle_hash"), ["__id", "__okey"])
    single = kept.filter("__times = 1").select(*docs.columns)
    # Rows without order among themselves: the one with the smallest other columns stays.
    twice = kept.filter("__times > 1")
    line = Window.partitionBy("__id", "__okey").orderBy(*[F.col(f"`{c}`").cast("string") for c in docs.columns if c != "text"])
    return single.unionByName(twice.withColumn("__n", F.row_number().over(line)).filter("__n = 1").select(*docs.columns))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "kept")
