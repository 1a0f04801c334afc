"""From documents to training tokens: toxic texts go, one document of each group of near-duplicates stays, repeated strings are cut
out, sources are mixed to their weights, and what is left is encoded as sampled pieces.

A stage takes (spark, docs, sf_dir) and returns what it keeps, with the columns of `documents`; the last one returns doc_id, lang,
source, pieces, n_pieces and lossless. Stages are written to the shared folder and read again, so a lost executor costs no more than
its part of one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparktiles.llm import mixing, neardup, pieces, suffix_dedup, toxicity
from sparktiles.llm.common import fold, stored, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Fitted on the labelled documents outside the held-out fold; all documents are judged."""
    train = toxicity.labelled(table(spark, sf_dir, "labels"), fold("doc_id", toxicity.HOLD_OUT) != 0)
    return toxicity.without_toxic(docs, toxicity.fit(docs, train))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.without_near_duplicates(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays, with what is left of its text; n_chars is counted again."""
    cut = suffix_dedup.without_repeats(docs)
    return cut.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.char_length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.encode(docs, carried=("lang", "source"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("suffix_dedup", cut_repeats),
    ("mixing", mix_sources),
    ("pieces", encode),
]

#: No SQL expresses these stages. Their operators are compared with brute-force versions in the tests; the rows of run() are not yet.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
