"""Registered queries next to their SQL, and the pipeline's stages."""

from collections import Counter

import duckdb
import pytest

import __spark_entry__
import corpus_pipeline
from stipend.llm import queries

FOLDER = "/root/testdata/sf0.001"
LARGER = "/root/testdata/sf0.01"
TABLES = ("documents", "embeddings", "pages", "labels", "benchmark")


@pytest.mark.parametrize("name", queries.SQL)
def test_query_equals_sql(spark, name):
    base = duckdb.connect()
    for table in TABLES:
        base.execute(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    want = base.sql(queries.SQL[name])
    got = queries.QUERIES[name](spark, FOLDER)
    at = [want.columns.index(c) for c in got.columns]
    assert Counter(map(tuple, got.collect())) == Counter(tuple(r[n] for n in at) for r in want.fetchall())


def test_all_are_registered():
    assert {n.split("_")[0] for n in __spark_entry__.queries() if n.startswith("op")} >= {f"op{n}" for n in range(1, 14)}
    assert "pipeline" in __spark_entry__.queries()


def test_pipeline_stages(spark):
    docs = queries.table(spark, LARGER, "documents")
    labels = {r.doc_id: r for r in queries.table(spark, LARGER, "labels").collect()}
    first = {r.doc_id for r in corpus_pipeline.quality_classifier(spark, docs, LARGER).collect()}
    bad = {i for i, r in labels.items() if r.quality == 0 or r.toxic == 1}
    good = set(labels) - bad
    assert len(first & bad) <= 0.2 * len(bad) and len(first & good) >= 0.95 * len(good)
    docs = queries.table(spark, FOLDER, "documents")
    for name, apply in corpus_pipeline.STAGES[1:4]:
        assert apply(spark, docs, FOLDER).columns == docs.columns, name
    packed = corpus_pipeline.run(spark, FOLDER)
    assert {"doc_id", "sequence_id", "offset"} <= set(packed.columns) and packed.count() > 0
