"""LM scoring: prediction by partial matching over bytes, beside a base over words."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadtally.llm.common import SPACES, staged

#: The symbol before and after each text; the others are bytes. Bits of a symbol in a gram, and how many symbols there are.
BOUNDARY, BITS, SYMBOLS = 256, 9, 257
#: Bytes of text whose grams are in work at once.
PIECE = 1 << 20


@dataclass(frozen=True)
class Settings:
    """Longest context in bytes (at most 6), and bytes of text that are scored together."""

    order: int = 4
    chunk: int = 16 << 20


def blocks(texts: list[bytes], order: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(texts, grams of each, grams): each byte and each text's end with the `order` symbols before it, PIECE bytes or so at a time."""
    parts: list[bytes] = []
    owners: list[int] = []
    sizes: list[int] = []
    edges: list[tuple[int, int]] = []  # symbols of the block that are boundaries: from, to
    total = 0

    def block() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        symbols = np.frombuffer(b"".join(parts), np.uint8).astype(np.int64)
        for lo, hi in edges:
            symbols[lo:hi] = BOUNDARY
        found = symbols[: len(symbols) - order].copy()
        for i in range(1, order + 1):
            found <<= BITS
            found |= symbols[i : len(symbols) - order + i]
        counts = np.array(sizes, np.int64)
        fine = np.ones(len(found) + order, bool)
        ends = np.cumsum(counts + order)
        for i in range(1, order + 1):
            fine[ends - i] = False
        return np.array(owners, np.int64), counts, found[fine[: len(found)]]

    for i, text in enumerate(texts):
        n = len(text) + 1
        padded = bytes(order) + text + b"\0"
        for lo in range(0, n, PIECE):
            hi = min(n, lo + PIECE)
            parts.append(padded[lo : hi + order])
            owners.append(i)
            sizes.append(hi - lo)
            if lo < order:
                edges.append((total, total + order - lo))
            total += hi - lo + order
            if hi == n:
                edges.append((total - 1, total))
            if total > PIECE:
                yield block()
                parts, owners, sizes, edges, total = [], [], [], [], 0
    if parts:
        yield block()


def word_pieces(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, PIECE bytes or so at a time."""
    at = 0
    while at < len(text):
        end = at + PIECE
        while end < len(text) and text[end] not in SPACES:
            end += 1
        yield text[at:end].split()
        at = end


class _Tally:
    """Counts of grams, those of held-out texts without a count."""

    def __init__(self) -> None:
        self.grams, self.counts = np.empty(0, np.int64), np.empty(0, np.int64)

    def add(self, found: np.ndarray, learned: bool) -> None:
        found, counts = np.unique(found, return_counts=True)
        both = np.concatenate([self.grams, found])
        counts = np.concatenate([self.counts, counts if learned else np.zeros_like(counts)])
        order = np.argsort(both, kind="stable")
        both = both[order]
        first = np.flatnonzero(np.concatenate(([True], both[1:] != both[:-1]))) if len(both) else order
        self.grams, self.counts = both[first], np.add.reduceat(counts[order], first) if len(both) else counts


def held_out(id_col: str) -> Column:
    """Whether crc32 of the id's text leaves 2 modulo 7; false for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 7 == 2, F.lit(False))


def _chunks(rows: DataFrame, size: int) -> DataFrame:
    """chunk, own_ids, held, sizes, texts: texts as bytes with A-Z lower-cased, dealt into chunks of about `size` bytes within their tasks.

    A row holds the texts of about PIECE bytes, compressed, since they are kept and shuffled.
    """
    own_type = rows.schema["own_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, used, held_bytes = TaskContext.get().partitionId() << 32, 0, 0
        block: list[tuple] = []

        def row(own: pa.DataType) -> pa.RecordBatch:
            ids, held, texts = zip(*block)
            return pa.RecordBatch.from_arrays([
                pa.array([chunk], pa.int64()), pa.array([list(ids)], pa.list_(own)), pa.array([list(held)], pa.list_(pa.bool_())),
                pa.array([[len(t) for t in texts]], pa.list_(pa.int64())), pa.array([zstandard.compress(b"".join(texts))], pa.binary()),
            ], ["chunk", "own_ids", "held", "sizes", "texts"])

        own = pa.null()
        for batch in batches:
            own = batch.column("own_id").type
            for id_, held, text in zip(*(batch.column(c).to_pylist() for c in ("own_id", "held", "text"))):
                raw = (text or "").encode().lower()
                full = used and used + len(raw) > size
                if block and (full or held_bytes > PIECE):
                    yield row(own)
                    block, held_bytes = [], 0
                if full:
                    chunk, used = chunk + 1, 0
                block.append((id_, held, raw))
                used, held_bytes = used + len(raw) + 1, held_bytes + len(raw)
        if block:
            yield row(own)

    return rows.mapInArrow(work, f"chunk long, own_ids array<{own_type}>, held array<boolean>, sizes array<long>, texts binary")


def _texts(packed: bytes, sizes: list[int]) -> list[bytes]:
    raw, at, out = zstandard.decompress(packed), 0, []
    for size in sizes:
        out.append(raw[at : at + size])
        at += size
    return out


def _needs(texts: DataFrame, order: int) -> DataFrame:
    """chunk, word, gram, n: each chunk's distinct words and grams, with their number in its learned texts."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, words, seen, tally = None, Counter(), set(), _Tally()

        def rows() -> Iterator[pa.RecordBatch]:
            nonlocal words, seen, tally
            names = list(words) + [w for w in seen if w not in words]
            counts = [words[w] for w in names]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(names), at, np.int64)), pa.array(names, pa.binary()), pa.nulls(len(names), pa.int64()), pa.array(counts, pa.int64())],
                ["chunk", "word", "gram", "n"])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(tally.grams), at, np.int64)), pa.nulls(len(tally.grams), pa.binary()), pa.array(tally.grams), pa.array(tally.counts)],
                ["chunk", "word", "gram", "n"])
            words, seen, tally = Counter(), set(), _Tally()

        for batch in batches:
            for number, held, sizes, packed in zip(*(batch.column(c).to_pylist() for c in ("chunk", "held", "sizes", "texts"))):
                if at is not None and number != at:
                    yield from rows()
                at = number
                texts = _texts(packed, sizes)
                for out in (False, True):
                    some = [text for text, h in zip(texts, held) if h == out]
                    for text in some:
                        for part in word_pieces(text):
                            seen.update(part) if out else words.update(part)
                    for _, _, grams in blocks(some, order):
                        tally.add(grams, not out)
        if at is not None:
            yield from rows()

    return texts.select("chunk", "held", "sizes", "texts").mapInArrow(work, "chunk long, word binary, gram long, n long")


def _mask(order: int) -> int:
    return (1 << BITS * (order + 1)) - 1


def symbol_scores(counted: DataFrame, order: int) -> DataFrame:
    """gram, score: log10 probability of each gram's last symbol after the others; `counted` has gram, c (0: never learned).

    A trie of contexts up to `order` symbols. A symbol counts in a context as
    often as it was new to the context one symbol longer (all its occurrences
    in the longest): this is what updating with exclusion leaves, whatever the
    order of the texts. In the longest context that was ever seen, a symbol has
    (2c - 1) / 2n and the escape d / 2n (n: counts, d: different symbols). After
    an escape the symbols of the longer context are excluded in the shorter
    one, and so on down to an even share of the symbols never seen.

    Contexts and symbols are rows. Only grams that were never learned look
    their shorter contexts up; contexts of at most one symbol are few by the
    alphabet alone and broadcast, the others are joined.
    """
    spark = counted.sparkSession
    known = counted.where("c > 0")
    trie: list[DataFrame] = [known]
    for o in range(order - 1, -1, -1):
        trie.insert(0, staged(spark, trie[0].groupBy(F.col("gram").bitwiseAND(F.lit(_mask(o))).alias("gram")).agg(F.count(F.lit(1)).alias("c")), f"trie-{o}"))
    context = F.shiftright("gram", BITS)
    nothing = F.lit(None).cast("long")
    entries = []
    for o, level in enumerate(trie):
        below = trie[o - 1].select(F.col("gram").alias("suffix"), F.col("c").alias("c_below")) if o else None
        sums = level if o == 0 else level.withColumn("suffix", F.col("gram").bitwiseAND(F.lit(_mask(o - 1)))).join(below, "suffix")
        sums = sums.groupBy(context.alias("key")).agg(
            F.sum("c").alias("n"), F.count(F.lit(1)).alias("d"), F.sum("c_below" if o else F.lit(0)).cast("long").alias("e"))
        entries.append(sums.select(F.lit(2 * o + 1).alias("kind"), "key", "n", "d", "e"))
        if o < order:
            entries.append(level.select(F.lit(2 * o).alias("kind"), F.col("gram").alias("key"), F.col("c").alias("n"), nothing.alias("d"), nothing.alias("e")))
    table = entries[0]
    for more in entries[1:]:
        table = table.unionByName(more)
    table = staged(spark, table, "trie")

    novel = counted.where("c = 0").select("gram")
    wanted = []
    for o in range(order + 1):
        gram = F.col("gram").bitwiseAND(F.lit(_mask(o)))
        wanted.append(F.struct(F.lit(2 * o + 1).alias("kind"), F.shiftright(gram, BITS).alias("key")))
        if o < order:
            wanted.append(F.struct(F.lit(2 * o).alias("kind"), gram.alias("key")))
    asked = novel.withColumn("want", F.explode(F.array(*wanted))).select("gram", "want.kind", "want.key")
    few = F.broadcast(table.where("kind < 4"))
    met = asked.where("kind < 4").join(few, ["kind", "key"]).unionByName(asked.where("kind >= 4").join(table.where("kind >= 4"), ["kind", "key"]))

    def of(kind: int, column: str) -> Column:
        return F.max(F.when(F.col("kind") == kind, F.col(column)))

    found = met.groupBy("gram").agg(
        *[of(2 * o, "n").alias(f"c{o}") for o in range(order)],
        *[of(2 * o + 1, c).alias(f"{c}{o}") for o in range(order + 1) for c in ("n", "d", "e")])
    score = -F.log10(F.lit(SYMBOLS) - F.coalesce("d0", F.lit(0)))
    for o in range(order + 1):
        n, d = F.col(f"n{o}"), F.col(f"d{o}")
        if o < order:
            n, d = n - F.coalesce(f"e{o + 1}", F.lit(0)), d - F.coalesce(f"d{o + 1}", F.lit(0))
        escaped = F.when(d > 0, F.log10(d / (2 * n)) + score).otherwise(score)
        coded = F.when(F.col(f"c{o}").isNotNull(), F.log10((2 * F.col(f"c{o}") - 1) / (2 * n))).otherwise(escaped) if o < order else escaped
        score = F.when(F.col(f"n{o}").isNull(), score).otherwise(coded)
    # a context has no more grams than there are symbols
    seen = known.withColumn("n", F.sum("c").over(Window.partitionBy(context))).select("gram", F.log10((2 * F.col("c") - 1) / (2 * F.col("n"))).alias("score"))
    return seen.unionByName(novel.join(found, "gram", "left").select("gram", score.alias("score")))


def lm_scores(docs: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of each document.

    Learned from the documents that are not held out; all are scored by what
    was learned of all of them. A-Z are lower-cased. `score` is the log10
    probability of the text's bytes and its end by partial matching (see
    `symbol_scores`), pretrained. `base_score` is the sum over its words and one
    end of log10((c + 1) / (N + V + 1)), c the token's count, N all and V
    different learned tokens.

    Nothing learned is collected or broadcast as a whole: texts are dealt into
    chunks of bounded size; a chunk asks for the words and grams that occur in
    it, these are counted over all chunks, scored once, and go back to the
    chunks that asked. What a task holds is bounded by its chunk.

    Null or empty text: its end alone. A null id is not held out. Repeated rows
    count again and come back repeated. Without anything learned every symbol
    has an even share and every token base 0. Empty table: no rows. Only the
    two named columns are read.
    """
    spark, order = docs.sparkSession, settings.order
    rows = docs.select(F.col(id_col).alias("own_id"), held_out(id_col).alias("held"), F.col(text_col).cast("string").alias("text"))
    texts = staged(spark, _chunks(rows, settings.chunk), "scored-texts", compression="uncompressed")
    needs = staged(spark, _needs(texts, order), "needed-grams", compression="zstd")
    needed_words, needed_grams = needs.where("word is not null").select("chunk", "word", "n"), needs.where("gram is not null").select("chunk", "gram", "n")
    words = staged(spark, needed_words.groupBy("word").agg(F.sum("n").alias("c")).where("c > 0"), "word-counts")
    grams = staged(spark, needed_grams.groupBy("gram").agg(F.sum("n").alias("c")), "gram-counts")
    scored = staged(spark, symbol_scores(grams, order), "gram-scores")
    ends = texts.agg(F.sum(F.size(F.filter("held", lambda h: ~h)))).first()[0] or 0
    known = words.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).first()
    total = (known["n"] or 0) + ends
    floor = math.log10(total + known["v"] + bool(ends) + 1)

    sent = needed_grams.join(scored, "gram").select("chunk", F.lit(None).cast("binary").alias("word"), "gram", F.col("score").alias("value")).unionByName(
        needed_words.join(words, "word").select("chunk", "word", F.lit(None).cast("long").alias("gram"), F.col("c").cast("double").alias("value")))
    own = docs.schema[id_col].dataType.simpleString()

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        is_word = right.column("word").is_valid()
        counts = right.filter(is_word)
        count_of = dict(zip(counts.column("word").to_pylist(), counts.column("value").to_pylist())).get
        grams_ = right.filter(right.column("gram").is_valid())
        keys, values = grams_.column("gram").to_numpy(), grams_.column("value").to_numpy()
        by = np.argsort(keys)
        keys, values = keys[by], values[by]
        out = []
        for packed, lengths, ids, held in zip(*(left.column(c).to_pylist() for c in ("texts", "sizes", "own_ids", "held"))):
            raw = _texts(packed, lengths)
            scores = np.zeros(len(raw))
            for owners, sizes, found in blocks(raw, order):
                np.add.at(scores, owners, np.add.reduceat(values[np.searchsorted(keys, found)], np.cumsum(sizes) - sizes))
            n_tokens, n_known, base = np.ones(len(raw), np.int64), np.full(len(raw), bool(ends), np.int64), np.full(len(raw), math.log10(ends + 1) - floor)
            for i, text in enumerate(raw):
                for part in word_pieces(text):
                    c = np.fromiter(map(count_of, part, repeat(0.0)), np.float64, len(part))
                    n_tokens[i] += len(c)
                    n_known[i] += np.count_nonzero(c)
                    base[i] += np.log10(c + 1).sum() - floor * len(c)
            out.append(pa.table({
                "doc_id": pa.array(ids, left.schema.field("own_ids").type.value_type), "held_out": pa.array(held, pa.bool_()), "n_tokens": n_tokens, "n_known": n_known,
                "train_tokens": np.full(len(raw), total, np.int64), "base_score": base, "score": scores,
            }))
        return pa.concat_tables(out)

    return texts.groupBy("chunk").cogroup(sent.groupBy("chunk")).applyInArrow(
        score, f"doc_id {own}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
