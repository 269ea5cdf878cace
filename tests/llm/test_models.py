"""Language ID on held-out documents; neighbour search against brute force."""

import zlib

import numpy as np

from roadtally.llm.language_id import Settings, identify
from roadtally.llm.vector_search import BlockIndex, POPCOUNT, nearest
from roadtally.llm import vector_search

from tests.llm.fixtures import table

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r["doc_id"]: r for r in identify(docs, Settings(epochs=4)).collect()}
    rows = docs.select("doc_id", "lang", "text").collect()
    assert len(got) == len(rows)
    out = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert {r["doc_id"] for r in out} == {d for d, r in got.items() if r["held_out"]}
    assert np.mean([got[r["doc_id"]]["lang_pred"] == r["lang"] for r in out]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_odd_texts(spark):
    rows = [(i, f"the thing and that {i} there", "en", "a") for i in range(40)] + [(100 + i, f"der hund und das {i} nicht", "de", "a") for i in range(40)]
    odd = [(200, None, "en", "a"), (201, "", "en", "a"), (202, "12 34 !?", "en", "a"), (203, "é", None, "a"), (None, "the dog", "en", None), (204, "der hund und " * 90000, None, "a")]
    got = {r["doc_id"]: r for r in identify(table(spark, rows + odd), Settings(epochs=6)).collect()}
    assert [got[i]["lang_pred"] for i in (200, 201, 202)] == ["und"] * 3 and got[200]["score"] == 0
    assert got[203]["lang_pred"] in ("de", "en") and got[None]["held_out"] is False and got[204]["lang_pred"] == "de"
    assert identify(table(spark, [])).count() == 0
    assert {r["lang_pred"] for r in identify(table(spark, odd[3:4])).collect()} == {"und"}


def brute(rows, k, every):
    fine = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for i, q in fine:
        if i % every == 0:
            out[i] = sorted(((-float((v * q).sum()), j) for j, v in fine if j != i))[:k]
    return out


def test_index_finds_every_code_in_the_radius():
    rng = np.random.default_rng(1)
    codes = rng.integers(0, 256, (500, 8), dtype=np.uint8)
    for radius in (0, 3, 9, 20, 26):
        index = BlockIndex(codes, radius)
        for q in rng.integers(0, 256, (20, 8), dtype=np.uint8):
            assert index.within(q).tolist() == np.flatnonzero(POPCOUNT[codes ^ q].sum(axis=1) <= radius).tolist()


def test_recall(spark, monkeypatch):
    monkeypatch.setattr(vector_search, "BLOCK_ROWS", 150)
    monkeypatch.setattr(vector_search, "BLOCK_QUERIES", 9)
    frame = spark.read.parquet(f"{SF}/embeddings.parquet")
    want = brute([(r["vec_id"], r["embedding"]) for r in frame.collect()], 20, 20)
    got = {}
    for r in nearest(frame).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    assert got.keys() == want.keys() and all(sorted(g) == list(range(1, 21)) for g in got.values())
    assert np.mean([len({v for v, _ in got[q].values()} & {j for _, j in w}) / 20 for q, w in want.items()]) > 0.9
    for q, w in want.items():
        exact = {j: -s for s, j in w}
        assert all(abs(s - exact[v]) < 1e-12 for v, s in got[q].values() if v in exact)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [0.5, 5.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [0.0, 0.0]), (40, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (None, [1.0, 1.0]), (7, []), (8, [-3.0, 0.5])]
    frame = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<float>, id string, rank int")
    got = {}
    for r in nearest(frame, k=3).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert {q: sorted(g) for q, g in got.items()} == {0: [(1, 1, 1.0), (2, 2, 1.0), (3, 20, 0.5)], 20: [(1, 8, 1.0), (2, 0, 0.5), (3, 1, 0.5)]}
    assert nearest(frame.where("vec_id > 100")).count() == 0
