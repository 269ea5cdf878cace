"""Spelling variants: words one edit apart, by asymmetric q-chunks, and the frequent form that each leads to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadtally.llm.common import staged

#: Letters, in Java's notation: ASCII and U+00C0 to U+00FF.
RUN = r"[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Pairs that a chunk may give for each of its words; the words of a chunk that would give more are cut into finer chunks.
PAIRS_A_WORD = 32
#: A form is so many times as frequent as the word that it stands for.
TIMES = 10


def word_counts(
    docs: DataFrame, min_chars: int = 7, min_count: int = 2, every: int | None = None, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """word, n: the words of all texts with at least `min_chars` code points and `min_count` occurrences.

    A word is a maximal run of letters with A-Z lower-cased. With `every`, an
    occurrence whose crc32 of `<id>:<run>` it divides loses the code point at
    that crc32 modulo the run's length, a reproducible slip of the pen.
    Counts combine before the shuffle.
    """
    run = F.explode(F.regexp_extract_all(F.col(text_col).cast("string"), F.lit(RUN), F.lit(0))).alias("run")
    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), run)
    rows = rows.where(F.length("run") >= min_chars).withColumn("run", F.translate("run", UPPER, LOWER))
    word = F.col("run")
    if every:
        hash_ = F.crc32(F.concat(F.col("id"), F.lit(":"), word).cast("binary"))
        rows = rows.withColumn("hash", hash_)
        at = (F.col("hash") % F.length("run")).cast("int")
        cut = F.concat(word.substr(F.lit(1), at), word.substr(at + 2, F.length("run")))
        word = F.when(F.col("hash") % every == 0, cut).otherwise(word)
    counted = rows.select(word.alias("word")).where(F.length("word") >= min_chars).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= min_count)


def _key(shift: Column) -> Column:
    """What stands outside [lo, hi) of a word, hashed with the place; the longer word's own stretch is `shift` wider."""
    head, tail = F.col("word").substr(F.lit(1), F.col("lo")), F.col("word").substr(F.col("hi") + shift + 1, F.length("word"))
    return F.xxhash64("size", "lo", "hi", head, tail)


def _halves(rows: DataFrame) -> DataFrame:
    """Each row twice: the edit lies in the first or in the second half of [lo, hi), the other half joins the chunk."""
    middle = ((F.col("lo") + F.col("hi")) / 2).cast("int")
    ranges = F.array(F.struct(F.col("lo").alias("lo"), middle.alias("hi")), F.struct(middle.alias("lo"), F.col("hi").alias("hi")))
    rows = rows.withColumn("range", F.explode(ranges)).select("word", "n", "shift", "size", F.col("range.lo").alias("lo"), F.col("range.hi").alias("hi"))
    return rows.withColumn("key", _key(F.greatest("shift", F.lit(0))))


def near_pairs(words: DataFrame) -> DataFrame:
    """a, a_n, b, b_n: all pairs of `words` (word, n) that differ by exactly one inserted, deleted or replaced code point, once each.

    Asymmetric q-chunks: the shorter word (either, if they are equally long) is
    cut into two disjoint chunks, of which one edit leaves one whole. The other
    word gives its positional grams: of the chunks' lengths for words of its own
    length and of one less, at the chunk's place, shifted by the difference of
    the lengths; one edit moves a chunk by no other shift. Grams that could meet
    no chunk are not made. Words that share a chunk are compared in full.

    A chunk that very many words share would give pairs by the square of their
    number. Its words are cut again: the half that holds the edit is halved and
    the other quarter joins the chunk, and so on, until a chunk gives at most
    PAIRS_A_WORD pairs a word or all but one code point is part of it; then it
    has no more words than there are letters to fill the gap. Nothing is
    capped, and no chunk's words meet all others of a large group.
    """
    spark = words.sparkSession
    size = F.length("word")
    sides = F.array(F.lit(-1), F.lit(0), F.lit(1))  # the word that is cut; the one that gives grams, equally long or one longer
    rows = words.select("word", "n", F.explode(sides).alias("shift")).withColumn("size", size - F.greatest("shift", F.lit(0)))
    rows = rows.withColumn("lo", F.lit(0)).withColumn("hi", F.col("size")).where("size > 1")
    found = None
    level = 0
    while level == 0 or not rows.isEmpty():
        placed = staged(spark, _halves(rows), f"chunks-{level}")
        cuts, grams = F.sum(F.when(F.col("shift") < 0, 1).otherwise(0)), F.sum(F.when(F.col("shift") >= 0, 1).otherwise(0))
        met = placed.groupBy("key").agg(cuts.alias("cuts"), grams.alias("grams"), F.max(F.col("hi") - F.col("lo")).alias("open"))
        # a word is its own gram, so that one gram alone is no pair
        met = met.where("cuts > 0 and grams > 1")
        few = (F.col("cuts") * F.col("grams") <= PAIRS_A_WORD * (F.col("cuts") + F.col("grams"))) | (F.col("open") <= 1)
        shared = staged(spark, met.select("key", few.alias("few")), f"shared-chunks-{level}")
        placed = staged(spark, placed.join(shared, "key"), f"met-{level}")
        x = placed.where("few and shift < 0").select("key", F.col("word").alias("a"), F.col("n").alias("a_n"))
        y = placed.where("few and shift >= 0").select("key", F.col("word").alias("b"), F.col("n").alias("b_n"), "shift")
        once = (F.col("shift") == 1) | (F.col("a") < F.col("b"))
        pairs = x.join(y, "key").where(once & (F.levenshtein("a", "b", 1) == 1)).select("a", "a_n", "b", "b_n")
        pairs = staged(spark, pairs.distinct(), f"pairs-{level}")
        found = pairs if found is None else found.unionByName(pairs)
        rows = placed.where("not few").drop("key", "few")
        level += 1
    return found.distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """word, root of each row of `forms` (word, form, form_n): forms followed to the last, by doubling steps.

    Each form is TIMES as frequent as its word, so a chain has at most as many
    steps as the largest count has digits.
    """
    spark = forms.sparkSession
    most = forms.agg(F.max("form_n")).first()[0] or 1
    steps = len(str(most)) if TIMES >= 10 else most.bit_length()
    ends = forms.select("word", F.col("form").alias("root"))
    for _ in range((steps - 1).bit_length()):
        ends = staged(spark, ends, "roots")
        ahead = ends.select(F.col("word").alias("root"), F.col("root").alias("next"))
        ends = ends.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
    return ends


def group_variants(words: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n of each row of `words` (word, n; words once each): see `spelling_variants`."""
    spark = words.sparkSession
    pairs = staged(spark, near_pairs(words), "near-words")
    links = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("a_n").alias("near_n")))
    # UTF-8 sorts like code points
    best = links.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near").alias("near"))).alias("best"))
    rows = words.join(best, "word", "left").withColumn("fits", F.coalesce(-F.col("best.minus") >= TIMES * F.col("n"), F.lit(False)))
    rows = staged(spark, rows.select(
        "word", F.when(F.col("fits"), F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(F.col("fits"), -F.col("best.minus")).alias("form_n")), "forms")
    roots = _roots(rows.where("form is not null"))
    return rows.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(
    docs: DataFrame, min_chars: int = 7, min_count: int = 2, every: int | None = None, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """word, form, root, n, n_near, form_n of each word of the texts: what it is a rarer spelling of.

    Words are counted as `word_counts` says. Two are near if one edit of a code
    point makes one the other. A word's form is its most frequent near word
    (ties: the smallest), if that is at least TIMES as frequent as the word,
    else null; its root is the end of the chain of forms, itself without one.

    Null or empty texts have no words; a null id counts as empty text where ids
    are hashed; repeated rows count again; an empty table gives no rows. Only
    the two named columns are read.
    """
    return group_variants(staged(docs.sparkSession, word_counts(docs, min_chars, min_count, every, id_col, text_col), "words"))
