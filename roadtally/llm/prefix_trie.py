"""Trie of conversation prefixes: what conversations share from their first turn on, rolled up in bands of depth."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadtally.llm.common import staged
from roadtally.operators.windows import dense_row_number

#: Depths of a band: a node meets its ancestors within its band only.
BAND = 16
#: Turns of a conversation whose prefixes one task makes.
STRETCH = 4096
#: Rows that one task puts in order, at most.
ORDERED = 1_000_000
#: Characters of a piece of a list of ids.
PIECE = 1 << 16
KEY = ["depth", "a", "b"]
NO_END = hashlib.sha256(b"").hexdigest()


def ordered_turns(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv, pos, a, b, size: each conversation's turns numbered from 1, two digests of role and text, code points of the text.

    Order: turn, null first; ties by role and by the text's MD5. Null role or
    text is empty. Rows without conversation id belong to none and are left
    out. The order is cut into ranges of at most ORDERED rows, so that a very
    long conversation is numbered by many tasks; texts do not shuffle.
    """
    spark = conversations.sparkSession
    role, text = F.coalesce(F.col(role_col).cast("string"), F.lit("")), F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = conversations.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"), role.alias("role"), F.md5(text.cast("binary")).alias("tie"),
        F.xxhash64(F.lit(1), role, text).alias("a"), F.xxhash64(F.lit(2), role, text).alias("b"), F.length(text).cast("long").alias("size"),
        F.monotonically_increasing_id().alias("row"))
    ways = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = max(1, min(ORDERED, -(-conversations.count() // ways)))
    numbered = dense_row_number(rows, ["conv", "turn", "role", "tie", "row"], "at", ordered).select("conv", "at", "a", "b", "size")
    numbered = staged(spark, numbered, "numbered-turns")
    firsts = numbered.groupBy("conv").agg(F.min("at").alias("first"))
    return numbered.join(firsts, "conv").select("conv", (F.col("at") - F.col("first") + 1).alias("pos"), "a", "b", "size")


def shared_heads(turns: DataFrame, every: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """Turns (conv, pos, a, b, size) rebuilt, and all conversations (conv).

    Conversation c begins with the first h turns of c - c % every (all if fewer,
    none if absent), h = crc32 of its decimal id modulo `most`; its own turns
    after its first h follow.
    """
    spark = turns.sparkSession
    turns = staged(spark, turns, "turns")
    convs = turns.groupBy("conv").agg(F.max("pos").alias("n"))
    base = F.col("conv") - F.col("conv") % every
    is_base = F.col("conv") % every == 0
    have = convs.where(is_base).select(F.col("conv").alias("base"), "n")
    plans = convs.select("conv", base.alias("base"), (F.crc32(F.col("conv").cast("string").cast("binary")) % most).alias("h")).join(have, "base", "left")
    plans = staged(spark, plans.select("conv", "base", "h", F.least("h", F.coalesce("n", F.lit(0))).alias("got")), "heads")
    heads = turns.where(is_base & (F.col("pos") < most)).withColumnRenamed("conv", "base")
    lent = plans.join(heads, "base").where("pos <= got").select("conv", "pos", "a", "b", "size")
    own = turns.join(plans, "conv").where("pos > h").select("conv", (F.col("pos") - F.col("h") + F.col("got")).alias("pos"), "a", "b", "size")
    return lent.unionByName(own), plans.select("conv")


def _prefixes(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """conv, depth, a, b, up_a, up_b, size: a row for each prefix of each conversation, the empty one included.

    A prefix's digest is the exclusive or of its turns' digests, each mixed with
    its place; so stretches of a long conversation are digested apart.
    """
    spark = turns.sparkSession
    turns = turns.select("conv", "pos", *[F.xxhash64("pos", c).alias(c) for c in ("a", "b")], "size", F.floor((F.col("pos") - 1) / STRETCH).alias("stretch"))
    turns = staged(spark, turns, "rebuilt-turns")
    before = Window.partitionBy("conv").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    sums = turns.groupBy("conv", "stretch").agg(F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))
    starts = sums.select("conv", "stretch", *[F.coalesce(F.bit_xor(c).over(before), F.lit(0)).alias(f"from_{c}") for c in ("a", "b")]).where("stretch > 0")
    within = Window.partitionBy("conv", "stretch").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = turns.select("conv", "stretch", "pos", "size", "a", "b", *[F.bit_xor(c).over(within).alias(f"to_{c}") for c in ("a", "b")])
    rows = rows.join(starts, ["conv", "stretch"], "left")
    to = {c: F.col(f"to_{c}").bitwiseXOR(F.coalesce(f"from_{c}", F.lit(0))) for c in ("a", "b")}
    rows = rows.select(
        "conv", F.col("pos").alias("depth"), to["a"].alias("a"), to["b"].alias("b"),
        to["a"].bitwiseXOR(F.col("a")).alias("up_a"), to["b"].bitwiseXOR(F.col("b")).alias("up_b"), "size")
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    tops = convs.select("conv", zero.alias("depth"), zero.alias("a"), zero.alias("b"), none.alias("up_a"), none.alias("up_b"), zero.alias("size"))
    return rows.unionByName(tops)


def _band(span: int) -> Column:
    return F.floor(F.col("depth") / span).alias("band")


def _rolled(values: DataFrame, prefixes: DataFrame, deepest: int, stride: int = 1) -> DataFrame:
    """depth, a, b, leaves, saved: each node's sums over its subtree.

    `values`: depth, a, b, conv (one that passes through the node), leaves,
    saved, of nodes whose depth `stride` divides. Depths are cut into bands of
    BAND steps. A node adds its values to itself and its ancestors within its
    band. A band's top nodes are the tree of the next round, with the sums of
    their bands as values and BAND times the stride; their completed sums are
    then added to all ancestors of the band above. So the rounds grow with the
    logarithm of the depth and no node is copied more than BAND times a round.
    """
    spark, span = values.sparkSession, stride * BAND
    path = prefixes.where(F.col("depth") % stride == 0).groupBy("conv", _band(span)).agg(F.sort_array(F.collect_list(F.struct(*KEY))).alias("path"))
    path = staged(spark, path, f"paths-{stride}")
    placed = staged(spark, values.withColumn("band", _band(span)).join(path, ["conv", "band"]), f"placed-{stride}")
    up = F.explode(F.filter("path", lambda p: p["depth"] <= F.col("depth"))).alias("up")
    added = placed.select(up, "leaves", "saved").select("up.*", "leaves", "saved")
    sums = [F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")]
    if deepest >= span:
        tops = placed.select(F.element_at("path", 1).alias("top"), "leaves", "saved").select("top.*", "leaves", "saved").groupBy(*KEY).agg(*sums)
        through = values.where(F.col("depth") % span == 0).select(*KEY, "conv")
        done = _rolled(staged(spark, tops.join(through, KEY), f"tops-{stride}"), prefixes, deepest, span)
        below = done.where("depth > 0").join(through, KEY).withColumn("band", _band(span) - 1).join(path, ["conv", "band"])
        added = added.unionByName(below.select(F.explode("path").alias("up"), "leaves", "saved").select("up.*", "leaves", "saved"))
    return staged(spark, added.groupBy(*KEY).agg(*sums), f"rolled-{stride}")


def _ends(prefixes: DataFrame) -> DataFrame:
    """depth, a, b, ends_sha256 of nodes where conversations end: SHA-256 of their ids, ascending, joined by commas.

    Ids are put in order by ranges of node and id and joined to pieces there, so
    that the task that digests a node reads few, long rows and holds one.
    """
    spark = prefixes.sparkSession
    last = prefixes.groupBy("conv").agg(F.max_by(F.struct(*KEY), "depth").alias("end")).select("end.*", "conv")
    last = staged(spark, last, "ends")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, ids, size = None, [], 0

        def piece() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [*(pa.array([k], pa.int64()) for k in at), pa.array([ids[0]], pa.int64()), pa.array([",".join(map(str, ids))])], [*KEY, "first", "ids"])

        for batch in batches:
            found = []
            for *key, conv in zip(*(batch.column(c).to_pylist() for c in (*KEY, "conv"))):
                if ids and (key != at or size > PIECE):
                    found.append(piece())
                    ids, size = [], 0
                at = key
                ids.append(conv)
                size += len(str(conv)) + 1
            yield from found
        if ids:
            yield piece()

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, digest = None, None
        for batch in batches:
            found: list[list] = []
            for *key, ids in zip(*(batch.column(c).to_pylist() for c in (*KEY, "ids"))):
                if key != at:
                    if at is not None:
                        found.append([*at, digest.hexdigest()])
                    at, digest = key, hashlib.sha256(ids.encode())
                else:
                    digest.update(f",{ids}".encode())
            yield rows(found)
        yield rows([[*at, digest.hexdigest()]] if at is not None else [])

    def rows(found: list[list]) -> pa.RecordBatch:
        columns = list(zip(*found)) or [()] * 4
        return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.string())], [*KEY, "ends_sha256"])

    order = [*KEY, "conv"]
    joined = last.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(pieces, "depth long, a long, b long, first long, ids string")
    return joined.repartition(*KEY).sortWithinPartitions(*KEY, "first").mapInArrow(digests, "depth long, a long, b long, ends_sha256 string")


def prefix_trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of each node of the trie.

    `turns`: conv, pos (1, 2, ... without gaps), a, b (digests of a turn), size;
    `convs`: every conv once, also those without turns. A node is a distinct
    sequence of first turns; its members are the conversations that begin with
    it, and conv_id is the smallest of them. Saved are, summed over the
    subtree, the code points of a node's last turn for each member but one.

    A node is known by its depth and 128 bits of its turns' digests. Members
    are counted with partial sums, so a first turn that very many
    conversations share is no large group; ancestors are met along the bands
    of one member's path. No conversations: no nodes, not even a root.
    """
    spark = turns.sparkSession
    prefixes = staged(spark, _prefixes(turns, convs), "prefixes")
    nodes = prefixes.groupBy(*KEY).agg(
        F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n_convs"), F.min("size").alias("size"), F.min("up_a").alias("up_a"), F.min("up_b").alias("up_b"))
    nodes = staged(spark, nodes, "nodes")
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("up_a").alias("a"), F.col("up_b").alias("b")).agg(
        F.count(F.lit(1)).alias("n_children"))
    nodes = staged(spark, nodes.join(children, KEY, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("long")), "nodes-and-children")
    values = nodes.select(
        *KEY, "conv", (F.col("n_children") == 0).cast("long").alias("leaves"), ((F.col("n_convs") - 1) * F.col("size")).alias("saved"))
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    sums = _rolled(values, prefixes, deepest)
    # tables of their own, so that the side with the hot parent is shuffled too and can be split
    parents = staged(spark, nodes.where("n_children > 0").select(
        (F.col("depth") + 1).alias("depth"), F.col("a").alias("up_a"), F.col("b").alias("up_b"), F.col("conv").alias("parent_conv_id")), "parents")
    return (
        nodes.join(parents, ["depth", "up_a", "up_b"], "left").join(sums, KEY).join(_ends(prefixes), KEY, "left")
        .select(
            F.col("conv").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", F.col("leaves").alias("n_leaves"),
            F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(NO_END)).alias("ends_sha256"))
    )


def conversation_trie(
    conversations: DataFrame, every: int = 100, most: int = 6, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
) -> DataFrame:
    """The trie (see `prefix_trie`) of all conversations, rebuilt by `shared_heads`.

    Null role or text is empty; rows without conversation id are left out;
    equal rows are turns of their own; turns of equal number are ordered by
    role and by their text's MD5. Empty table: no rows. Other columns are not read.
    """
    return prefix_trie(*shared_heads(ordered_turns(conversations, conv_col, turn_col, role_col, text_col), every, most))
