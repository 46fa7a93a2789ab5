"""The registered queries: names, twins, whole tables; the pipeline against its operators one by one."""

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from check_oracle import compare
from gleaner.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"


def test_one_query_for_each_operator():
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_twin(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    status, _, _, note = compare(spark, con, name, SF)
    assert status == "ok", note


@pytest.mark.parametrize("name", ["op3_bagminhash", "op7_pseudonyms", "op8_embedding_links", "op10_token_ids"])
def test_a_row_for_each_row(spark, name):
    source, key = ("embeddings", "vec_id") if "op8" in name else ("documents", "doc_id")
    ids = spark.read.parquet(f"{SF}/{source}.parquet").select(key)
    assert sorted(r[0] for r in QUERIES[name](spark, SF).select(key).collect()) == sorted(r[0] for r in ids.collect())


def test_pipeline(spark):
    assert len(corpus_pipeline.STAGES) == 5
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    left = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = left
        left = spark.createDataFrame(stage(spark, before, SF).collect(), docs.schema)
        assert left.columns == docs.columns, name
        if name != "mixing":
            assert left.exceptAll(before).count() == 0
        assert left.count() > 0
    rows = corpus_pipeline.run(spark, SF)
    assert rows.count() == left.count()
    ends = rows.agg(F.sum("n_tokens"), F.max(F.col("start") + F.col("n_tokens"))).first()
    assert ends[0] == ends[1]
