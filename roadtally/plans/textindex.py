"""An inverted index of trigrams for texts that are searched again and again."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadtally.operators.columns import quoted
from roadtally.operators.filters import search

#: Characters of a gram; a shorter query cannot use the index.
GRAM = 3
#: Grams of a query that are looked up, the rarest first.
LOOKED_UP = 8
#: Share of the rows above which a query's rarest gram saves nothing over a scan.
COMMON = 0.2
#: Characters whose grams are sorted at once; a longer text is cut, with an overlap that loses no gram.
PIECE = 1 << 21


def _pieces(texts: list[list[str | None]]) -> Iterator[list[tuple[int, str]]]:
    """(row, part of a text) lists of about PIECE characters; `texts` has a list for each column."""
    held: list[tuple[int, str]] = []
    size = 0
    for row, found in enumerate(zip(*texts)):
        for text in found:
            for at in range(0, len(text or "") - GRAM + 1, PIECE):
                held.append((row, text[at : at + PIECE + GRAM - 1]))
                size += len(held[-1][1])
                if size >= PIECE:
                    yield held
                    held, size = [], 0
    if held:
        yield held


def _grams(held: list[tuple[int, str]]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Different grams of the texts in order, where each one's rows begin in the third part (and its end), and the different rows.

    Characters are numbered in order and a gram's numbers are packed into one
    word with its row, so that one sort gives grams and rows. Rows are taken
    apart where both do not fit into a word.
    """
    rows, owner = np.unique([row for row, _ in held], return_inverse=True)
    codes = np.frombuffer("".join(t for _, t in held).encode("utf-32-le"), np.uint32)
    sizes = np.fromiter((len(t) for _, t in held), np.int64, len(held))
    used = np.flatnonzero(np.bincount(codes))
    number = np.zeros(int(used[-1]) + 1, np.uint64)
    number[used] = np.arange(len(used))
    bits = max(1, (len(used) - 1).bit_length())
    room = 63 - GRAM * bits
    numbered = number[codes]
    starts = np.ones(len(codes), dtype=bool)
    ends = np.cumsum(sizes)
    for back in range(1, GRAM):
        starts[ends - back] = False
    at = np.flatnonzero(starts)
    word = numbered[at]
    for i in range(1, GRAM):
        word = word << np.uint64(bits) | numbered[at + i]
    if room < 1 or len(rows) > 1 << room:
        pairs = np.unique(np.stack([word, np.repeat(owner, sizes)[at].astype(np.uint64)]), axis=1)
        gram, row = pairs
    else:
        packed = np.sort(word << np.uint64(room) | np.repeat(owner, sizes).astype(np.uint64)[at])
        packed = packed[np.concatenate(([True], packed[1:] != packed[:-1]))]
        gram, row = packed >> np.uint64(room), packed & np.uint64((1 << room) - 1)
    first = np.flatnonzero(np.concatenate(([True], gram[1:] != gram[:-1])))
    mask = np.uint64((1 << bits) - 1)
    letters = [used[(gram[first] >> np.uint64(bits * (GRAM - 1 - i)) & mask).astype(np.int64)] for i in range(GRAM)]
    text = np.stack(letters, axis=1).astype("<u4").tobytes().decode("utf-32-le")
    grams = [text[i : i + GRAM] for i in range(0, len(text), GRAM)]
    return grams, np.append(first, len(gram)), rows[row.astype(np.int64)]


def build_index(df: DataFrame, key: str, cols: list[str], folder: str, year_col: str | None = None, mode: str = "overwrite") -> None:
    """Postings (gram, n, keys), `grams` (gram, n) and `rows` below `folder`, for searches in `cols` and the year as text.

    A task's texts give rows of a gram and the keys that hold it, one for each
    gram of about PIECE characters, and the task writes them sorted by gram.
    Nothing is shuffled, so no task has more postings than its texts have
    characters, however common a gram is; a look-up reads of each file the
    parts that hold its grams. Rows without key have no postings; searches
    scan them. A text of several parts counts once for each in `n`.
    """
    spark = df.sparkSession
    texts = [F.lower(F.col(quoted(c)).cast("string")).alias(f"_{i}") for i, c in enumerate(c for c in [*cols, *([year_col] if year_col else [])] if c in df.columns)]
    rows = df.where(F.col(quoted(key)).isNotNull()).select(F.col(quoted(key)).alias("key"), *texts)
    kind = rows.schema["key"].dataType

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("key")
            for held in _pieces([c.to_pylist() for c in batch.columns[1:]]):
                grams, cuts, row = _grams(held)
                lists = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), keys.take(pa.array(row)))
                yield pa.RecordBatch.from_arrays([pa.array(grams, pa.string()), pa.array(np.diff(cuts), pa.int64()), lists], ["gram", "n", "keys"])

    postings = rows.mapInArrow(post, f"gram string, n long, keys array<{kind.simpleString()}>").sortWithinPartitions("gram")
    postings.write.mode(mode).parquet(f"{folder}/postings")
    counted = spark.read.parquet(f"{folder}/postings").groupBy("gram").agg(F.sum("n").alias("n"))
    counted.repartitionByRange("gram").sortWithinPartitions("gram").write.mode(mode).parquet(f"{folder}/grams")
    df.agg(F.count(F.lit(1)).alias("n")).write.mode(mode).parquet(f"{folder}/rows")


def candidates(spark: SparkSession, folder: str, query: str) -> DataFrame | None:
    """Keys of the rows that hold the query's rarest grams; None if the index is no help: short queries and common ones."""
    q = (query or "").lower()
    grams = sorted({q[i : i + GRAM] for i in range(len(q) - GRAM + 1)})
    if not grams:
        return None
    # at most a row for each gram of the query
    known = {r["gram"]: r["n"] for r in spark.read.parquet(f"{folder}/grams").where(F.col("gram").isin(grams)).collect()}
    postings = spark.read.parquet(f"{folder}/postings")
    if len(known) < len(grams):
        return postings.where(F.lit(False)).select(F.explode("keys").alias("key"))
    if min(known.values()) > COMMON * spark.read.parquet(f"{folder}/rows").first()["n"]:
        return None
    rare = sorted(grams, key=lambda g: (known[g], g))[:LOOKED_UP]
    # rows of one key, and parts of one text, post a gram more than once
    met = postings.where(F.col("gram").isin(rare)).select("gram", F.explode("keys").alias("key")).groupBy("key").agg(F.size(F.collect_set("gram")).alias("met"))
    return met.where(F.col("met") == len(rare)).select("key")


def search_indexed(df: DataFrame, folder: str, query: str, key: str, cols: list[str], year_col: str | None = None) -> DataFrame:
    """The rows that `search` gives, by way of the index of the same columns.

    The index nominates rows, the search itself decides on them, so the result
    is exact; where the index is no help the whole table is searched.
    """
    nominated = candidates(df.sparkSession, folder, query)
    if nominated is None:
        return search(df, query, cols, year_col)
    own = F.col(quoted(key))
    parts = [df.join(nominated.withColumnRenamed("key", "_nominated"), own == F.col("_nominated"), "left_semi"), df.where(own.isNull())]
    return reduce(DataFrame.unionByName, [search(p, query, cols, year_col) for p in parts])
