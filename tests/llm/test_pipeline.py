"""The stages one after the other against plain Python."""

from collections import Counter

import pytest

import corpus_pipeline
from roadtally.llm.language_id import identify

from tests.llm.fixtures import odd_rows, table, words
from tests.llm.test_native import plain_contamination, plain_mix
from tests.llm.test_near_dedup import plain
from tests.llm.test_token_output import expected

COLUMNS = ("doc_id", "text", "lang", "source")


def picked(df):
    return [tuple(r[c] for c in COLUMNS) for r in df.collect()]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    item = words(30, 99)
    rows = odd_rows() + [(500 + i, " ".join(words(80, 1000 + i) + (item[4:20] if i % 5 == 0 else [])), "en", "abc"[i % 3]) for i in range(40)]
    rows += [(None, " ".join(words(30, 50) + item), "en", "a"), (900, "123 456", "en", "a")]
    table(spark, rows).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(7, " ".join(item))], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    bench = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    columns = docs.columns
    now = docs
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = picked(now)
        got = stage(spark, now, folder)
        if n < 4:
            assert got.columns == columns
            got.write.parquet(f"{folder}/stage-{n}.parquet")
            got = spark.read.parquet(f"{folder}/stage-{n}.parquet")
        if name == "language":
            bad = {(r["doc_id"]) for r in identify(now).where("lang_pred = 'und'").collect()}
            assert Counter(picked(got)) == Counter(r for r in before if r[0] not in bad or (r[0] is None and r[1]))
        elif name == "near_dedup":
            gone = {d for d, _, _, kept in plain(before) if not kept}
            want = {r[0] for r in before if r[0] not in gone}
            assert {r[0] for r in picked(got)} == want and len([r for r in picked(got) if r[0] is not None]) == len(want - {None})
            assert sum(r[0] is None for r in picked(got)) == sum(r[0] is None for r in before)
        elif name == "decontaminate":
            flags = {r: plain_contamination([r], bench)[0][-1] for r in before}
            assert Counter(picked(got)) == Counter(r for r in before if not flags[r]) and any(flags.values())
        elif name == "mix":
            want = Counter()
            for d, _, _, _, taken in plain_mix(before):
                want[d] += taken
            have = Counter()
            for d, t, *_ in picked(got):
                have[d] += len(t.split())
            assert have == Counter({d: n for d, n in want.items() if n})
        else:
            want, _ = expected(before)
            assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got.collect()) == Counter(want)
        now = got


def test_run(spark, folder):
    got = corpus_pipeline.run(spark, folder).orderBy("start").collect()
    assert [r["start"] for r in got] == [sum(x["n_tokens"] for x in got[:i]) for i in range(len(got))]
    assert got and got[0].asDict().keys() == {"doc_id", "start", "n_tokens", "ids_crc32"}
