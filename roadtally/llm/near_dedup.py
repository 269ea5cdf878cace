"""MinHash near-dedup with SetSketch registers."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadtally.llm.common import BASE, BYTE_CODES, Digests, mix, staged
from roadtally.llm.components import components

#: Members of a bucket's block, two of which are compared at once, and members of a pivot whose texts are compared in one task.
TILE = 512
CHUNK = 64


@dataclass(frozen=True)
class Sketch:
    """SetSketch: `bands` x `rows` registers floor(1 - log_base(least value)), values exponential with rate `rate`.

    With base near 1 two registers agree with a chance close to the Jaccard
    similarity J, so a pair at J = 0.75 misses all 40 bands of 5 with chance
    (1 - 0.75**5)**40 = 2e-5. Registers of a union are the maxima.
    """

    bands: int = 40
    rows: int = 5
    base: float = 1.001
    rate: float = 20.0
    top: int = (1 << 16) - 2
    shingle: int = 5
    percent: int = 75
    #: A pair is dropped unseen if its likelihood ratio against `percent` is that of so many standard deviations.
    sigmas: float = 6.0

    @property
    def size(self) -> int:
        return self.bands * self.rows


def _factors(size: int) -> tuple[np.ndarray, np.ndarray]:
    pick = np.random.default_rng(71)
    return pick.integers(0, 1 << 31, size, dtype=np.uint32) * np.uint32(2) + np.uint32(1), pick.integers(0, 1 << 32, size, dtype=np.uint32)


def shingles(words: list[bytes], k: int) -> set[tuple[bytes, ...]]:
    """Distinct shingles of `k` words; of fewer words, all of them as one; of none, none."""
    if not words:
        return set()
    return set(zip(*(words[i:] for i in range(k)))) if len(words) >= k else {tuple(words)}


def shingle_digests(words: list[bytes], k: int) -> np.ndarray:
    """64-bit digests of the distinct shingles."""
    if not words:
        return np.empty(0, np.uint64)
    raw = np.frombuffer(b" ".join(words), np.uint8)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    k = min(k, len(words))
    return np.unique(Digests(BYTE_CODES[raw]).of((ends - lengths)[: len(words) - k + 1], ends[k - 1 :]))


def registers(digests: np.ndarray, sketch: Sketch) -> np.ndarray:
    """SetSketch registers of a set: each is the truncated, exponentially spaced minimum of its own hash function."""
    factors, terms = _factors(sketch.size)
    x = (digests >> np.uint64(32)).astype(np.uint32)
    least = np.full(sketch.size, (1 << 32) - 1, np.uint32)
    for at in range(0, len(x), 512):
        np.minimum(least, (x[at : at + 512, None] * factors + terms).min(axis=0), out=least)
    exponential = -np.log1p(-(least + 0.5) / 2.0**32) / sketch.rate
    return np.clip(np.floor(1 - np.log(exponential) / np.log(sketch.base)), 0, sketch.top + 1).astype(np.uint16)


def band_keys(rows: np.ndarray, sketch: Sketch) -> np.ndarray:
    """A 64-bit key of each band of each row of registers, different between bands."""
    bands = rows.reshape(len(rows), sketch.bands, sketch.rows).astype(np.uint64)
    keys = np.arange(sketch.bands, dtype=np.uint64)[None] * np.uint64(BASE)
    for i in range(sketch.rows):
        keys = mix(keys + bands[:, :, i] + np.uint64(1))
    return keys


def likely(more: np.ndarray, fewer: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, sketch: Sketch) -> tuple[np.ndarray, np.ndarray]:
    """Joint estimate of the Jaccard similarity, and whether `percent` is still likely.

    `more` and `fewer` count registers of a above and below b's. Given the set
    sizes, a register is above with chance p(u - v J), below with p(v - u J),
    where u and v are the sizes' shares and p(x) = -log_base(1 - x (base - 1) / base).
    The estimate is the J of the largest likelihood.
    """
    def p(x: np.ndarray) -> np.ndarray:
        return np.maximum(-np.log1p(-np.clip(x, 0, 1) * (sketch.base - 1) / sketch.base) / np.log(sketch.base), 1e-12)

    u = (n_a / (n_a + n_b))[:, None]
    most = np.minimum(u / (1 - u), (1 - u) / u)
    grid = np.linspace(0, 1, 61)[None] * most

    def log_likelihood(j: np.ndarray) -> np.ndarray:
        above, below = p(u - (1 - u) * j), p(1 - u - u * j)
        same = np.maximum(1 - above - below, 1e-12)
        return more[:, None] * np.log(above) + fewer[:, None] * np.log(below) + (sketch.size - more - fewer)[:, None] * np.log(same)

    values = log_likelihood(grid)
    best = values.argmax(axis=1)
    estimate = grid[np.arange(len(best)), best]
    wanted = sketch.percent / 100
    at = log_likelihood(np.minimum(wanted, most))[:, 0]
    fits = 100 * np.minimum(n_a, n_b) >= sketch.percent * np.maximum(n_a, n_b)
    return estimate, fits & ((estimate >= wanted) | (2 * (values.max(axis=1) - at) <= sketch.sigmas**2))


def _stack(column: pa.Array, size: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, size)


def _long(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False)


class _NearDedup:
    def __init__(self, docs: DataFrame, sketch: Sketch, id_col: str, text_col: str):
        self.spark, self.sketch = docs.sparkSession, sketch
        self.docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))

    def profiles(self) -> DataFrame:
        sketch = self.sketch

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                sizes, kinds, regs = [], [], []
                for text in batch.column("text").to_pylist():
                    words = (text or "").encode().lower().split()
                    digests = shingle_digests(words, sketch.shingle)
                    sizes.append(len(digests))
                    kinds.append(hashlib.blake2b(b" ".join(words), digest_size=16).digest() if words else None)
                    regs.append(registers(digests, sketch).tobytes() if words else None)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), pa.array(sizes, pa.int64()), pa.array(kinds, pa.binary()), pa.array(regs, pa.binary())],
                    ["id", "n", "kind", "regs"])

        return staged(self.spark, self.docs.mapInArrow(work, "id long, n long, kind binary, regs binary"), "profiles")

    def buckets(self, firsts: DataFrame) -> DataFrame:
        """key, id, low, high, members of the buckets that several texts share."""
        sketch = self.sketch

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in (batch.slice(i, 2000) for i in range(0, len(batch), 2000)):
                    keys = band_keys(_stack(part.column("regs"), sketch.size), sketch).view(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys.ravel()), pa.array(np.repeat(_long(part.column("id")), sketch.bands))], ["key", "id"])

        rows = firsts.select("id", "regs").mapInArrow(work, "key long, id long")
        shared = rows.groupBy("key").agg(F.min("id").alias("low"), F.max("id").alias("high"), F.count(F.lit(1)).alias("members"))
        # a table of its own, so that Spark shuffles both sides of the join and can split a bucket of very many members
        shared = staged(self.spark, shared.where("low < high"), "shared-buckets")
        return staged(self.spark, rows.join(shared, "key"), "buckets")

    def estimated(self, pairs: DataFrame, firsts: DataFrame) -> DataFrame:
        """The pairs whose sketches leave the similarity likely."""
        sketch = self.sketch

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in (batch.slice(i, 1000) for i in range(0, len(batch), 1000)):
                    a, b = (_stack(part.column(c), sketch.size) for c in ("regs_a", "regs_b"))
                    _, keep = likely((a > b).sum(axis=1), (a < b).sum(axis=1), _long(part.column("n_a")), _long(part.column("n_b")), sketch)
                    at = pa.array(np.flatnonzero(keep))
                    yield pa.RecordBatch.from_arrays([part.column(c).take(at) for c in ("a", "b")], ["a", "b"])

        side = lambda s: firsts.select(F.col("id").alias(s), F.col("n").alias(f"n_{s}"), F.col("regs").alias(f"regs_{s}"))
        return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(work, "a long, b long")

    def confirmed(self, pairs: DataFrame, texts: DataFrame) -> DataFrame:
        """The pairs (a, b) whose full sets reach the similarity: b's texts come to a's, in chunks of a bounded number."""
        k, percent = self.sketch.shingle, self.sketch.percent
        pairs = staged(self.spark, pairs, "likely-pairs")
        large = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / CHUNK).alias("chunks")).where("chunks > 1")
        large = staged(self.spark, large, "large-pivots")
        chunk = F.pmod(F.xxhash64("b"), F.coalesce("chunks", F.lit(1).cast("long")))
        placed = pairs.join(large, "a", "left").select("a", "b", chunk.alias("chunk"))
        wanted = placed.select(F.col("b").alias("id"), "a", "chunk", F.lit(1).alias("role")).unionByName(
            placed.select(F.col("a").alias("id"), "a", "chunk", F.lit(0).alias("role")).distinct())

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            at, sets = None, []
            for batch in batches:
                found: list[tuple[int, int]] = []
                for id_, a, chunk, role, text in zip(*(batch.column(c).to_pylist() for c in ("id", "a", "chunk", "role", "text"))):
                    if at != (a, chunk):
                        at, sets = (a, chunk), []
                    own = shingles((text or "").encode().lower().split(), k)
                    if not role:
                        sets.append(own)
                    elif any(100 * (both := len(own & other)) >= percent * (len(own) + len(other) - both) and both for other in sets):
                        found.append((a, id_))
                columns = list(zip(*found)) or [(), ()]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b"])

        return (
            wanted.join(texts, "id").repartition("a", "chunk").sortWithinPartitions("a", "chunk", "role")
            .mapInArrow(work, "a long, b long")
        )

    def tiles(self, open_: DataFrame, firsts: DataFrame) -> DataFrame:
        """key, x, y, block, id, component: members of a bucket's blocks x and y that a member of another component may be linked with.

        A bucket is cut into blocks; two blocks meet in a task and are compared
        by their registers, so no task sees a whole bucket and no pairs leave
        it. A pair counts in the first band that it shares only.
        """
        sketch = self.sketch
        blocks = F.ceil(F.col("members") / TILE).cast("int")
        rows = open_.withColumn("block", F.pmod(F.xxhash64("id"), blocks).cast("int")).withColumn(
            "other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        rows = rows.select("key", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), "block", "id", "component")
        rows = rows.join(firsts.select("id", "n", "regs"), "id").select("key", "x", "y", "block", "id", "component", "n", "regs")

        def tile(key: int, x: int, y: int, members: list[tuple]) -> list[tuple]:
            blocks_, ids, comps, sizes = (np.array(c) for c in list(zip(*members))[:4])
            table = np.frombuffer(b"".join(m[4] for m in members), np.uint16).reshape(-1, sketch.size)
            band = int(np.flatnonzero(band_keys(table[:1], sketch)[0].view(np.int64) == key)[0])
            right, wanted = np.flatnonzero(blocks_ == y), np.zeros(len(ids), bool)
            for i in np.flatnonzero(blocks_ == x):
                j = right[(comps[right] != comps[i]) & ((ids[right] > ids[i]) if x == y else True)]
                j = j[100 * np.minimum(sizes[j], sizes[i]) >= sketch.percent * np.maximum(sizes[j], sizes[i])]
                shared = (table[j] == table[i]).reshape(len(j), sketch.bands, sketch.rows).all(axis=2)
                j = j[shared.argmax(axis=1) == band] if len(j) else j
                if len(j):
                    more, fewer = (table[i] > table[j]).sum(axis=1), (table[i] < table[j]).sum(axis=1)
                    j = j[likely(more, fewer, np.full(len(j), sizes[i]), sizes[j], sketch)[1]]
                    wanted[j] = True
                    wanted[i] |= len(j) > 0
            return [(key, x, y, *members[i][:3]) for i in np.flatnonzero(wanted)]

        return self._by_tile(rows, tile, ["key", "x", "y", "block", "id", "component"])

    def linked(self, members: DataFrame, texts: DataFrame) -> DataFrame:
        """Pairs (a, b) that join components: all members of different components of a tile are compared by their full sets.

        What a link joins is one component for the rest of the tile, so a tile
        gives fewer links than it has members.
        """
        k, percent = self.sketch.shingle, self.sketch.percent
        rows = members.join(texts, "id").select("key", "x", "y", "block", "id", "component", "text")

        def tile(_: int, x: int, y: int, members: list[tuple]) -> list[tuple]:
            words = [(m[3] or "").encode().lower().split() for m in members]
            sets = [shingle_digests(w, k) for w in words]
            _, codes = np.unique(np.concatenate(sets), return_inverse=True)
            sizes = np.array([len(s) for s in sets])
            starts = np.cumsum(sizes) - sizes
            blocks_, ids, comps = (np.array(c) for c in list(zip(*members))[:3])
            present, out = np.zeros(codes.max() + 1, np.int64), []
            for i in np.flatnonzero(blocks_ == x):
                j = np.flatnonzero((blocks_ == y) & (comps != comps[i]) & ((ids > ids[i]) if x == y else True)
                                   & (100 * np.minimum(sizes, sizes[i]) >= percent * np.maximum(sizes, sizes[i])))
                if not len(j):
                    continue
                own = codes[starts[i] : starts[i] + sizes[i]]
                present[own] = 1
                before = np.cumsum(sizes[j]) - sizes[j]
                at = np.repeat(starts[j] - before, sizes[j]) + np.arange(sizes[j].sum())
                both = np.add.reduceat(present[codes[at]], before)
                present[own] = 0
                for t in j[100 * both >= percent * (sizes[i] + sizes[j] - both)]:
                    if comps[t] != comps[i]:
                        a, b = shingles(words[i], k), shingles(words[t], k)
                        if 100 * len(a & b) >= percent * len(a | b):
                            out.append((int(ids[i]), int(ids[t])))
                            comps[comps == comps[t]] = comps[i]
            return out

        return self._by_tile(rows, tile, ["a", "b"])

    @staticmethod
    def _by_tile(rows: DataFrame, tile, names: list[str]) -> DataFrame:
        """What `tile(key, x, y, other columns of its rows)` gives for each tile; columns `names`, all long."""
        def pack(found: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*found)) or [()] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(map(int, c), pa.int64()) for c in columns], names)

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            at, members = None, []

            def settle() -> list[tuple]:
                return tile(*at, members) if len(members) > 1 else []

            for batch in batches:
                found = []
                for key, x, y, *row in zip(*(c.to_pylist() for c in batch.columns)):
                    if at != (key, x, y):
                        found += settle()
                        at, members = (key, x, y), []
                    members.append(tuple(row))
                yield pack(found)
            yield pack(settle())

        return rows.repartition("key", "x", "y").sortWithinPartitions("key", "x", "y").mapInArrow(work, ", ".join(f"{n} long" for n in names))

    def run(self) -> DataFrame:
        spark = self.spark
        rows = self.profiles()
        linkable = rows.where("id is not null and n > 0")
        kinds = staged(spark, linkable.groupBy("kind").agg(F.min("id").alias("first")), "kinds")
        placed = linkable.select("id", "kind").join(kinds, "kind")
        # ids that stand on several different texts tie these together
        tied = placed.groupBy("id").agg(F.min("first").alias("low"), F.max("first").alias("high")).where("low < high")
        ties = placed.join(tied.select("id"), "id").select(F.col("first").alias("a"), F.col("id").alias("b"))
        firsts = linkable.join(kinds.select("kind", F.col("first").alias("id")), ["kind", "id"], "left_semi").dropDuplicates(["kind"])
        firsts = staged(spark, firsts.select("id", "n", "regs"), "firsts")
        buckets = self.buckets(firsts)
        texts = staged(spark, self.docs.join(buckets.select("id").distinct(), "id", "left_semi").dropDuplicates(), "candidate-texts")
        links = staged(spark, ties, "links")

        def settle(new: DataFrame, seen: DataFrame) -> tuple[DataFrame, DataFrame]:
            """All links so far, and the components they make."""
            links = staged(spark, seen.unionByName(new), "links")
            return links, components(links)

        def torn(labels: DataFrame) -> DataFrame:
            """The buckets that still hold several components."""
            now = buckets.join(labels, "id", "left").withColumn("component", F.coalesce("component", "id"))
            several = now.groupBy("key").agg(F.min("component").alias("c0"), F.max("component").alias("c1")).where("c0 < c1")
            return staged(spark, now.join(staged(spark, several.select("key"), "torn-keys"), "key"), "open-buckets")

        star = buckets.where("id > low").select(F.col("low").alias("a"), F.col("id").alias("b")).distinct()
        links, labels = settle(self.confirmed(self.estimated(star, firsts), texts), links)
        open_ = torn(labels)
        ends = open_.where("id = high").select("key", F.col("component").alias("end"))
        star = open_.join(ends, "key").where("component <> end").select(F.col("high").alias("a"), F.col("id").alias("b")).distinct()
        links, labels = settle(self.confirmed(self.estimated(star, firsts), texts), links)
        members = staged(spark, self.tiles(torn(labels), firsts), "tile-members")
        links, labels = settle(self.linked(members, texts), links)
        known = placed.select("id", "kind", "first").distinct().join(labels.select(F.col("id").alias("first"), "component"), "first", "left")
        return rows.select("id", "n", "kind").join(
            known.select(F.col("id").alias("own"), F.col("kind").alias("own_kind"), F.coalesce("component", "first").alias("component")),
            (F.col("id") == F.col("own")) & (F.col("kind") == F.col("own_kind")), "left",
        ).select(
            F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id"),
            F.coalesce(F.col("id") == F.coalesce("component", "id"), F.lit(True)).alias("kept"),
        )


def near_duplicates(docs: DataFrame, sketch: Sketch = Sketch(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept: documents linked when 100 * intersection >= percent * union of their shingles.

    A-Z are lower-cased and words are runs of everything but ASCII white
    space; a document is the set of its shingles of five words. Equal word
    sequences are one text from the start. Registers of a SetSketch are
    banded; texts that share a band are compared: first with the smallest and
    the largest of the bucket, then, in buckets that still hold several
    components, with all texts of other components, in tiles of bounded size.
    What the joint likelihood of the registers leaves possible is confirmed on
    the full sets. Pairs within one component need no comparison.

    Null or empty texts: no shingles, linked with nothing. Rows that share a
    doc_id are one document: what one of them is linked with, all are. A row
    without doc_id is linked with nothing, has no component and is kept.
    Repeated rows come back repeated. Empty table: no rows.
    """
    return _NearDedup(docs, sketch, id_col, text_col).run()
