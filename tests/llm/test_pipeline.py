import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from changeloom.llm import queries, simhash

SF = "/root/testdata/sf0.001"


def test_stages_hand_on_whole_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, SF)
        assert docs.columns == before.columns
        assert docs.select("doc_id", "text").exceptAll(before.select("doc_id", "text")).dropDuplicates().join(
            before.select("doc_id", "text"), ["doc_id", "text"], "left_anti"
        ).count() == 0
    assert len(corpus_pipeline.STAGES) == 5


def test_near_duplicates_stage_keeps_the_smallest_ids(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    left = {r["doc_id"] for r in corpus_pipeline.without_near_duplicates(spark, docs, SF).collect()}
    assert left == {r["component_id"] for r in simhash.near_duplicates(docs).collect()}


def test_run_accounts_for_every_sequence(spark):
    rows = corpus_pipeline.run(spark, SF).toPandas()
    assert sorted(rows["slot"]) == list(range(len(rows))) and (rows["tokens"] > 0).all()


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "labels", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    got = entry.queries()[name](spark, SF)
    expected = con.execute(entry.oracle_sql()[name]).fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(expected)
