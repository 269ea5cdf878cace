"""Benchmark items without id, against the query's own SQL and in the pipeline's stage."""

import duckdb

import corpus_pipeline
from roadtally.llm.registry import DECONTAMINATION, decontamination

from tests.llm.fixtures import table, words
from tests.oracle import compare

ITEM, OTHER = words(30, 401), words(12, 402)


def folder(spark, tmp_path):
    rows = [
        (1, " ".join(["before", *ITEM[3:20], "after"]), "en", "a"), (2, " ".join(OTHER), "en", "a"), (3, " ".join(ITEM[:9]), "en", "a"),
        (4, " ".join([*OTHER, *ITEM]), "en", "b"), (5, "nothing of it", "en", "b"), (6, None, "en", "b"), (7, "short item", "en", "b"),
    ]
    table(spark, rows).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    items = [(None, " ".join(ITEM)), (8, " ".join(OTHER)), (None, "Short item"), (9, "short ITEM"), (None, None)]
    spark.createDataFrame(items, "item_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def test_hits_as_in_sql(spark, tmp_path):
    path = folder(spark, tmp_path)
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}/{name}.parquet/*.parquet'")
    got = decontamination(spark, path)
    assert compare(got, con, DECONTAMINATION) == ""
    assert {r["doc_id"]: (r["n_hit"], r["n_items"], r["contaminated"]) for r in got.collect()} == {
        1: (17, 0, True), 2: (12, 1, True), 3: (0, 0, False), 4: (42, 1, True), 5: (0, 0, False), 6: (0, 0, False), 7: (2, 1, True)}


def test_stage_drops_their_documents(spark, tmp_path):
    path = folder(spark, tmp_path)
    left = corpus_pipeline.decontaminate(spark, spark.read.parquet(f"{path}/documents.parquet"), path)
    assert sorted(r["doc_id"] for r in left.collect()) == [3, 5, 6]
