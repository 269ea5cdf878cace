"""Approximate nearest neighbours: multi-index hashing of learned binary codes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadtally.llm.common import staged

#: Rows of a block, which a task indexes, and about how many queries probe it there; more queries meet a copy of the block.
BLOCK_ROWS, BLOCK_QUERIES = 1 << 14, 1 << 16
POPCOUNT = np.array([bin(i).count("1") for i in range(256)], np.uint8)


@dataclass(frozen=True)
class Settings:
    """`rotations` learned rotations give dim bits each. They, and the radius, are fitted on at most `sample` rows."""

    rotations: int = 4
    iterations: int = 20
    sample: int = 8192
    #: Share of the sample's nearest pairs that the radius has to hold.
    share: float = 0.985
    seed: int = 3


@dataclass
class Codes:
    """Signs of rotated vectors, eight bits a substring, and the Hamming radius that is searched."""

    rotation: np.ndarray
    longest: float
    radius: int = 0

    @classmethod
    def learn(cls, vectors: np.ndarray, longest: float, k: int, total: int, s: Settings) -> "Codes":
        """Iterative quantisation: rotations that bring vectors nearest to their signs; the radius from the sample's own neighbours.

        The k nearest of `total` rows are as near as the k * n / total nearest
        of a sample of n, so the sample tells how far their codes lie apart.
        """
        rng = np.random.default_rng(s.seed)
        x = cls._unit(vectors, longest)
        found = []
        for _ in range(s.rotations):
            r = np.linalg.qr(rng.normal(size=(x.shape[1], x.shape[1])))[0]
            for _ in range(s.iterations):
                u, _, v = np.linalg.svd(np.where(x @ r > 0, 1.0, -1.0).T @ x)
                r = (u @ v).T
            found.append(r)
        codes = cls(np.concatenate(found, axis=1), longest)
        near = max(1, round(k * len(x) / max(1, total)))
        bits, distances = codes.of(vectors), []
        asked = codes.of(vectors, query=True)
        for i in rng.permutation(len(x))[:400]:
            score = vectors @ vectors[i]
            score[i] = -np.inf
            nearest = np.argpartition(-score, min(near, len(x)) - 1)[:near]
            distances.append(POPCOUNT[bits[nearest[nearest != i]] ^ asked[i]].sum(axis=1, dtype=np.int64))
        distances = np.concatenate([np.zeros(1, np.int64), *distances])
        codes.radius = int(np.quantile(distances, s.share))
        return codes

    @staticmethod
    def _unit(vectors: np.ndarray, longest: float, query: bool = False) -> np.ndarray:
        """Vectors on a sphere where angles order inner products: rows get a coordinate that fills up their length."""
        lengths = np.linalg.norm(vectors, axis=1, keepdims=True)
        if query:
            return np.hstack([vectors / lengths, np.zeros_like(lengths)])
        rest = np.sqrt(np.maximum(0, 1 - (lengths / longest) ** 2))
        return np.hstack([vectors / longest, rest])

    def of(self, vectors: np.ndarray, query: bool = False) -> np.ndarray:
        return np.packbits(self._unit(vectors, self.longest, query) @ self.rotation > 0, axis=1)


class BlockIndex:
    """Multi-index of a block: for each substring, the rows that each value can reach.

    A code within `radius` of a query's is within floor(radius / m) of it in
    one of the first radius mod m + 1 substrings, or within one less in one of
    the others. The rows whose substring is that near to a value are kept as
    a bitmap for each value, so a probe is a union of one bitmap a substring.
    """

    def __init__(self, codes: np.ndarray, radius: int):
        self.codes, self.radius = codes, radius
        m = codes.shape[1]
        base, more = divmod(radius, m)
        values = np.arange(256, dtype=np.uint8)
        apart = POPCOUNT[values[:, None] ^ values[None]]
        self.bitmaps = []
        for j in range(m):
            reach = base if j <= more else base - 1
            rows = np.packbits(codes[:, j][None] == values[:, None], axis=1) if reach >= 0 else None
            self.bitmaps.append(None if rows is None else np.stack([np.bitwise_or.reduce(rows[near], axis=0) for near in apart <= reach]))

    def within(self, code: np.ndarray) -> np.ndarray:
        """Every row whose code is within the radius."""
        hit = np.bitwise_or.reduce([b[v] for b, v in zip(self.bitmaps, code) if b is not None])
        rows = np.flatnonzero(np.unpackbits(hit, count=len(self.codes)))
        return rows[POPCOUNT[self.codes[rows] ^ code].sum(axis=1, dtype=np.int64) <= self.radius]


def _matrix(column: pa.Array) -> np.ndarray:
    return np.array(column.to_pylist(), np.float64)


def _usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """id, v of the rows that take part."""
    v = F.col(vector_col).cast("array<double>")
    fine = F.col(id_col).isNotNull() & v.isNotNull() & F.exists(v, lambda x: x != 0) & F.forall(
        v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vectors.where(F.coalesce(fine, F.lit(False))).select(F.col(id_col).cast("long").alias("id"), v.alias("v"))


def nearest(
    vectors: DataFrame, k: int = 20, every: int = 20, settings: Settings = Settings(), id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """query_id, rank, vec_id, score: the k rows of largest inner product for each row whose id `every` divides.

    Rows become binary codes; all rows are indexed, in blocks, and every query
    retrieves all codes within the learned Hamming radius, which are ranked by
    the inner product of the original vectors in double precision, ties to the
    smaller id. A query that finds fewer than k in its radius is answered by
    comparing it with all rows. The rows of a query's own id are no candidates.

    Vectors that are null, zero or hold null or non-finite components, vectors
    of another length than most, and rows without id take no part. With fewer
    than k candidates all are returned. Empty table: no rows.
    """
    spark = vectors.sparkSession
    rows = _usable(vectors, id_col, vector_col)
    shape = rows.groupBy(F.size("v").alias("dim")).agg(
        F.count(F.lit(1)).alias("n"), F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)).alias("longest")).orderBy(F.desc("n"), "dim").first()
    if shape is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dim, total = shape["dim"], shape["n"]
    rows = rows.where(F.size("v") == dim)
    picked = rows.orderBy(F.xxhash64("id"), "id").limit(settings.sample).collect()
    longest = float(np.sqrt(shape["longest"])) * (1 + 1e-12)
    codes = Codes.learn(np.array([r["v"] for r in picked], np.float64), longest, k, total, settings)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("v")).reshape(-1, dim)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array([v.tobytes() for v in x], pa.binary()), pa.array([c.tobytes() for c in codes.of(x)], pa.binary())], ["id", "v", "code"])

    table = staged(spark, rows.mapInArrow(encode, "id long, v binary, code binary"), "codes")
    blocks = -(-total // BLOCK_ROWS)
    queries = table.where(F.col("id") % every == 0).select("id", "v")

    def search(asked: DataFrame, whole: bool) -> DataFrame:
        """Each block's best k for each query, as rows query, id, score."""
        ways = max(1, -(-total // every // BLOCK_QUERIES))

        def dealt(column: str, n: int) -> Column:
            return F.pmod(F.xxhash64("id", F.lit(column)), F.lit(n)).cast("int").alias(column)

        def copied(column: str, n: int) -> Column:
            return F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(column)

        placed = table.select(dealt("block", blocks), copied("way", ways), F.lit(0).alias("role"), "id", "v", "code").unionByName(
            asked.select(copied("block", blocks), dealt("way", ways), F.lit(1).alias("role"), "id", "v", F.lit(None).cast("binary").alias("code")))

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            at, held, index, ids, base = None, [], None, None, None

            def close() -> None:
                nonlocal index, ids, base
                ids = np.array([h[0] for h in held], np.int64)
                base = np.frombuffer(b"".join(h[1] for h in held), np.float64).reshape(-1, dim)
                index = None if whole or not held else BlockIndex(np.frombuffer(b"".join(h[2] for h in held), np.uint8).reshape(len(held), -1), codes.radius)
                held.clear()

            for batch in batches:
                out: list[tuple] = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))]
                for block, way, role, id_, v, code in zip(*(batch.column(c).to_pylist() for c in ("block", "way", "role", "id", "v", "code"))):
                    if (block, way) != at:
                        at, ids = (block, way), None
                        held.clear()
                    if not role:
                        held.append((id_, v, code))
                        continue
                    if ids is None:
                        close()
                    q = np.frombuffer(v, np.float64)
                    near = np.arange(len(ids)) if index is None else index.within(codes.of(q[None], query=True)[0])
                    near = near[ids[near] != id_]
                    score = (base[near] * q).sum(axis=1)
                    best = np.lexsort((ids[near], -score))[:k]
                    out.append((np.full(len(best), id_), ids[near][best], score[best]))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], ["query_id", "vec_id", "score"])

        return placed.repartition("block", "way").sortWithinPartitions("block", "way", "role").mapInArrow(work, "query_id long, vec_id long, score double")

    def best(found: DataFrame) -> DataFrame:
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

    first = staged(spark, best(search(queries.dropDuplicates(["id"]), False)), "neighbours")
    short = first.groupBy("query_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= k)
    left = staged(spark, queries.dropDuplicates(["id"]).join(short, F.col("id") == F.col("query_id"), "left_anti"), "short-queries")
    if left.isEmpty():
        return first
    return first.join(short, "query_id", "left_semi").unionByName(best(search(left, True)))
