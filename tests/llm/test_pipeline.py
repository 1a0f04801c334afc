"""The pipeline's stages, and the registered queries on the smallest tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from sparktiles.llm import queries
from sparktiles.llm.common import stored

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the generated tables")


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    toxic = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").filter("toxic = 1").collect()}
    counts, columns = [docs.count()], docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, SF))
        assert docs.columns == columns, name
        counts.append(docs.count())
    assert counts[0] >= counts[1] >= counts[2] == counts[3] and counts[2] > 0.7 * counts[0]
    assert docs.filter("n_chars <> char_length(text)").count() == 0
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert last.count() == counts[4] and last.filter("NOT lossless").count() == 0
    assert len(toxic) > 0


def test_every_operator_is_registered():
    names = set(entry.queries())
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{i}" for i in range(1, 14)}
    assert "pipeline" in names and set(queries.oracle_sql()) <= names


@pytest.mark.parametrize("name", ["op2_suffix_dedup", "op9_graph_dedup", "op6_source_mix", "op11_lexical_search", "op13_hard_negatives"])
def test_queries_equal_their_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for table in ("documents", "benchmark", "embeddings"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    got = queries.queries()[name](spark, SF)
    columns = sorted(got.columns)
    expected = sorted(con.sql(f"SELECT {', '.join(columns)} FROM ({queries.oracle_sql()[name]})").fetchall())
    assert expected and sorted(tuple(r) for r in got.select(*columns).collect()) == expected
