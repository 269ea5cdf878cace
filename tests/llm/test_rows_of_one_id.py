"""Rows that share an id: no different text is lost, and very many of them end in seconds."""

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from roadtally.llm import language_id
from roadtally.llm.line_dedup import dedup_lines
from roadtally.llm.substring_dedup import dedup_substrings
from roadtally.llm.suffix_dedup import dedup_suffixes

from tests.llm.fixtures import table, words


def test_no_text_of_an_id_is_lost(spark):
    texts = {i: [" ".join(words(40, 100 * i + j)) for j in range(6)] for i in range(8)}
    rows = [(i, t, "en", "a") for i, own in texts.items() for t in own]
    # equal rows, and one that nearly equals a text of a smaller id
    odd = [(3, texts[3][0], "en", "a"), (7, texts[2][1] + " more", "en", "a"), (None, texts[1][0], "en", "a"), (None, texts[1][0], "en", "a")]
    want = sorted([(i, t) for i, own in texts.items() for t in own] + [(-1, texts[1][0])] * 2)
    for order in (rows + odd, (rows + odd)[::-1]):
        docs = table(spark, order).repartition(3)
        got = corpus_pipeline.near_dedup(spark, docs, "")
        assert got.columns == docs.columns
        assert sorted((-1 if r["doc_id"] is None else r["doc_id"], r["text"]) for r in got.collect()) == want


@pytest.fixture(scope="module")
def many(spark, tmp_path_factory):
    """20,000 equal rows and 20,000 rows of one id with texts of their own."""
    path = str(tmp_path_factory.mktemp("many") / "rows")
    equal = " ".join(words(60, 3))
    rows = [(-1, equal, "en", "a")] * 20_000 + [(-1, f"{equal} {i}\n" + " ".join(words(12, i)), "en", "a") for i in range(20_000)]
    table(spark, rows).write.parquet(path)
    return spark.read.parquet(path)


def test_very_many_rows_of_one_id(spark, many):
    found = dedup_substrings(many).groupBy("n_words", "n_removed").count().collect()
    assert {(r["n_words"], r["n_removed"], r["count"]) for r in found} == {(60, 60, 20_000), (73, 60, 20_000)}
    assert dedup_lines(many).agg({"n_dropped": "sum"}).first()[0] == 0
    found = dedup_suffixes(many, window=250).where("n_removed > 250").count()
    assert found == 40_000


def test_language_sample_is_bounded(spark, many, monkeypatch):
    seen = []
    monkeypatch.setattr(language_id.ByteCnn, "fit", lambda self, x, y: seen.append(len(x)) or self)
    settings = language_id.Settings(rows=50)
    language_id.train(many.withColumn("doc_id", F.lit(3)), settings)
    assert 50 <= seen[0] <= 50 * settings.windows
