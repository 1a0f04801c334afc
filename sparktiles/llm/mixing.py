"""Mixing sources to target weights.

Words are summed by source (a combined aggregation), the budget is dealt to the sources by weight up to a ceiling, and the rate
target / source words says how often a document is taken: floor(rate) times, and once more where a number hashed from its id
is below the fraction. The table of sources is one row per source; it is written, so Spark knows its size when it joins it to
the documents and broadcasts it only if it is small.

A null or empty text has no words, and is taken like any other of its source. A null source is a source of its own, the last
one. Rows that repeat an id get the same decision. A source without words has target 0 and is not taken. No rows, no result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stored, table

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
BUDGET, CEILING = 1.5, 2
SEED = "mix-1"


def word_count(text: str) -> Column:
    return F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, budget: float = BUDGET, ceiling: int = CEILING) -> DataFrame:
    """source, source_size, target, rate from rows with source and size.

    Weights go to the sources in code point order, null last, over and over. They share budget x all words; a source gets at
    most ceiling x its own, and what it leaves is shared by the others' weights. In the order of ceiling x size / weight the
    sources that reach their ceiling come first, so running sums find them all at once.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    filling = Window.orderBy(F.col("most") / F.col("weight"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    turn = (F.row_number().over(order) - 1) % len(weights) + 1
    ranked = (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("rank", F.row_number().over(order))
        .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), turn.cast("int")))
        .withColumn("most", ceiling * F.col("source_size"))
    )
    left = F.lit(budget) * F.sum("source_size").over(every) - F.coalesce(F.sum("most").over(filling), F.lit(0))
    weight_left = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(filling), F.lit(0))
    leveled = ranked.withColumn("full", F.col("most") / F.col("weight") <= left / weight_left)
    spent = F.sum(F.when(F.col("full"), F.col("most")).otherwise(0)).over(every)
    open_weight = F.sum(F.when(F.col("full"), 0).otherwise(F.col("weight"))).over(every)
    level = (F.lit(budget) * F.sum("source_size").over(every) - spent) / open_weight
    target = F.when(F.col("full"), F.col("most").cast("double")).otherwise(F.col("weight") * level)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    return leveled.withColumn("target", target).select("source", "source_size", "target", rate.alias("rate"))


def copies(rate: Column, doc_id: Column, seed: str = SEED) -> Column:
    """floor(rate), and one more with probability rate - floor(rate), decided by 52 bits hashed from seed and id."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary")), 1, 13)
    chance = F.conv(digits, 16, 10).cast("double") / F.lit(float(1 << 52))
    return (F.floor(rate) + (chance < rate - F.floor(rate)).cast("long")).cast("long")


def with_rates(rows: DataFrame, rates: DataFrame) -> DataFrame:
    """Rows with the columns of their source; null sources meet. Rates must have no column of the rows but source."""
    other = rates.withColumnRenamed("source", "__source")
    return rows.join(other, rows["source"].eqNullSafe(other["__source"])).drop("__source")


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, budget: float = BUDGET, ceiling: int = CEILING, seed: str = SEED) -> DataFrame:
    """The mix itself: every document as often as it is taken, with its own columns only, whatever they are called."""
    sizes = docs.select("source", word_count("text").alias("size"))
    rates = stored(targets(sizes, weights, budget, ceiling)).select("source", F.col("rate").alias("__rate"))
    taken = with_rates(docs, rates).withColumn("__copies", copies(F.col("__rate"), F.col("doc_id"), seed))
    each = F.explode(F.array_repeat(F.lit(True), F.col("__copies").cast("int")))
    return taken.withColumn("__copy", each).select([docs[c] for c in docs.columns])


def op6_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = stored(table(spark, sf_dir, "documents").select("doc_id", "source", word_count("text").alias("size")))
    rated = with_rates(sizes, stored(targets(sizes)))
    return rated.select("doc_id", "size", "source_size", "target", (F.col("size") * copies(F.col("rate"), F.col("doc_id"))).alias("taken"))


OP6_SQL = f"""
    WITH sizes AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size FROM documents),
    per AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sizes GROUP BY source),
    ranked AS (SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) AS rank FROM per),
    weighted AS (SELECT *, CASE (rank - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, {CEILING} * source_size AS most FROM ranked),
    filled AS (SELECT *, CAST(sum(source_size) OVER () AS DOUBLE) * {BUDGET} AS budget,
        CAST(coalesce(sum(most) OVER before, 0) AS DOUBLE) AS most_before,
        CAST(sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS DOUBLE) AS weight_left
      FROM weighted WINDOW before AS (ORDER BY most / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    leveled AS (SELECT *, most / weight <= (budget - most_before) / weight_left AS is_full FROM filled),
    shared AS (SELECT *, CASE WHEN is_full THEN CAST(most AS DOUBLE) ELSE weight * ((budget
        - CAST(sum(CASE WHEN is_full THEN most ELSE 0 END) OVER () AS DOUBLE))
        / CAST(sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER () AS DOUBLE)) END AS target FROM leveled),
    rates AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate FROM shared),
    drawn AS (SELECT s.doc_id, s.size, r.source_size, r.target, r.rate,
        CAST(CAST('0x' || substr(md5('{SEED}:' || coalesce(CAST(s.doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) AS DOUBLE) / {float(1 << 52)!r} AS chance
      FROM sizes s JOIN rates r ON s.source IS NOT DISTINCT FROM r.source)
    SELECT doc_id, size, source_size, target,
      CAST(size * (floor(rate) + CASE WHEN chance < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM drawn"""
