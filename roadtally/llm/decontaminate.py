"""Benchmark decontamination: a prefix-filtered set join on word shingles; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadtally.llm.common import staged

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words of text after A-Z are lower-cased.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Bytes of the benchmark's shingles up to which they are broadcast; beyond, they are joined by a shuffle.
BROADCAST_BYTES = 32 << 20


def words_of(text: Column) -> Column:
    """Array of a text's words; empty for null."""
    return F.coalesce(F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def _shingle(words: Column, at: Column, length: int) -> Column:
    """Digest of `length` words from the zero-based place `at`; single words are read in constant time, slices are not."""
    return F.xxhash64(*(F.get(words, at + j) for j in range(length)))


def _windows(benchmark: DataFrame, window: int, id_col: str, text_col: str) -> DataFrame:
    """wid, words, size, items: each distinct window of the items, and the ids of the items that hold it; none for items without id."""
    items = benchmark.select(F.col(id_col).cast("string").alias("item"), words_of(F.col(text_col)).alias("all"))
    items = items.where(F.size("all") > 0).withColumn("size", F.least(F.size("all"), F.lit(window)))
    each = items.select("item", "size", F.explode_outer(F.transform(
        F.sequence(F.lit(0), F.size("all") - F.col("size")), lambda i: F.slice("all", i + 1, F.col("size")))).alias("words"))
    return each.groupBy("words", "size").agg(F.collect_set("item").alias("items")).withColumn("wid", F.xxhash64("words", "size"))


def _sides(rows: DataFrame, lengths: list[int]) -> Column:
    """Array of (shingle length, place, digest) of a row's `words`, for each of the lengths."""
    def one(k: int) -> Column:
        places = F.when(F.size("words") >= k, F.sequence(F.lit(0), F.size("words") - k)).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda i: F.struct(F.lit(k).alias("k"), i.alias("place"), _shingle(F.col("words"), i, k).alias("digest")))

    return F.concat(*map(one, lengths))


def contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = 10, shingle: int = 5, id_col: str = "doc_id", text_col: str = "text",
    item_id_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, items, contaminated: where windows of benchmark items occur in documents.

    A window is `window` consecutive words of an item, or all words of a
    shorter one. As sets of shingles of `shingle` words (all words of a
    shorter window) windows are joined with documents by prefix filtering:
    shingles are ordered by how often they occur in all documents, and since
    containment must be whole, the rarest one of a window is prefix enough. Its
    place bounds where the window can start, the document's length where it
    can end, and what is left is verified word by word.

    The benchmark's shingles are broadcast while they are below
    BROADCAST_BYTES and joined by a shuffle above. Documents' shingles are
    never all shuffled in the first case; candidates meet their document again
    by its id and the digest of its text.

    Null or empty text: no words. Items without words take no part. Windows of
    items without id are hits, but the item is neither counted nor listed.
    Repeated rows come back repeated; rows of one doc_id are judged by their
    own texts. Without items nothing is hit. Empty table: no rows.
    """
    spark = docs.sparkSession
    windows = staged(spark, _windows(benchmark, window, item_id_col, item_text_col), "windows")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("rx"), F.col(text_col).alias("text"))
    known = windows.select("wid", "size", F.explode(F.transform(
        F.sequence(F.lit(0), F.col("size") - F.least("size", F.lit(shingle))), lambda i: F.struct(
            i.alias("offset"), F.xxhash64(F.slice("words", i + 1, F.least("size", F.lit(shingle)))).alias("digest")))).alias("s")).select(
        "wid", "size", F.least("size", F.lit(shingle)).alias("k"), "s.*")
    lengths = sorted(r["k"] for r in known.select("k").distinct().collect())
    if lengths:
        asked = known.select("k", "digest").distinct()
        # a row of the broadcast table takes some 40 bytes
        if 40 * asked.count() <= BROADCAST_BYTES:
            asked = F.broadcast(asked)
        met = rows.where(F.length("text") > 0).select("doc_id", "rx", words_of(F.col("text")).alias("words"))
        met = met.select("doc_id", "rx", F.size("words").alias("n"), _sides(met, lengths).alias("all"))
        # the outer form, as the plain one makes Spark test the array's size below the projection that splits the text
        met = met.select("doc_id", "rx", "n", F.inline_outer("all")).join(asked, ["k", "digest"])
        met = staged(spark, met, "shingles-met")
        # rarity over all documents; a shingle that never occurs rules its window out
        counts = met.groupBy("k", "digest").agg(F.count(F.lit(1)).alias("times"))
        rarity = known.join(counts, ["k", "digest"], "left")
        prefix = rarity.groupBy("wid", "size", "k").agg(
            F.min(F.struct(F.coalesce("times", F.lit(0)).alias("times"), "offset", "digest")).alias("rarest")).where("rarest.times > 0")
        prefix = prefix.join(windows.select("wid", "words", "items"), "wid").select(
            "k", "size", F.col("rarest.digest").alias("digest"), F.col("rarest.offset").alias("offset"), "words", "items")
        prefix = staged(spark, prefix, "prefixes")
        found = met.join(prefix, ["k", "digest"]).withColumn("start", F.col("place") - F.col("offset"))
        found = found.where((F.col("start") >= 0) & (F.col("start") + F.col("size") <= F.col("n")))
        candidates = found.groupBy(F.col("doc_id").alias("own_id"), F.col("rx").alias("own_rx")).agg(
            F.collect_set(F.struct("start", "size", F.col("words").alias("run"), "items")).alias("maybe"))
    else:
        candidates = rows.limit(0).select(F.col("doc_id").alias("own_id"), F.col("rx").alias("own_rx"), F.lit(None).cast(
            "array<struct<start:int,size:int,run:array<string>,items:array<string>>>").alias("maybe"))
    judged = rows.join(candidates, F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("rx") == F.col("own_rx")), "left").select(
        "doc_id", words_of(F.col("text")).alias("words"), F.coalesce("maybe", F.array().cast(candidates.schema["maybe"].dataType)).alias("maybe"))
    judged = judged.withColumn("true", F.filter("maybe", lambda c: F.forall(
        F.sequence(F.lit(0), c["size"] - 1), lambda j: F.get("words", c["start"] + j) == F.get(c["run"], j))))
    hit = F.size(F.array_distinct(F.flatten(F.transform("true", lambda c: F.sequence(c["start"], c["start"] + c["size"] - 1)))))
    items = F.array_sort(F.array_distinct(F.flatten(F.transform("true", lambda c: c["items"]))))
    judged = judged.select("doc_id", F.size("words").cast("long").alias("n_words"), hit.cast("long").alias("n_hit"), items.alias("items"))
    # written, as a caller's filter would be pushed below and split the text anew for each word it looks at
    judged = staged(spark, judged, "judged")
    return judged.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        "items", (F.col("n_hit") > 0).alias("contaminated"))
