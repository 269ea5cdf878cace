"""The trie of conversation prefixes against plain Python."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import types as T

from roadtally.llm import prefix_trie as p
from roadtally.llm.prefix_trie import conversation_trie

SCHEMA = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()),
    T.StructField("text", T.StringType()), T.StructField("depth", T.StringType()), T.StructField("a", T.LongType()), T.StructField("conv", T.LongType()),
])


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1, 2) for r in rows], SCHEMA)


def plain(rows):
    turns = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            text = text or ""
            turns[c].append((t is not None, t or 0, role or "", hashlib.md5(text.encode()).hexdigest(), text))
    turns = {c: [(r, x) for _, _, r, _, x in sorted(own)] for c, own in turns.items()}
    rebuilt = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        rebuilt[c] = turns.get(base, [])[:h] + own[h:]
    members = defaultdict(list)
    for c, seq in rebuilt.items():
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[k] for k in children[node]) or 1
        saved[node] = sum(saved[k] for k in children[node]) + ((len(members[node]) - 1) * len(node[-1][1]) if node else 0)
    out = []
    for node, own in members.items():
        ends = sorted(c for c in own if len(rebuilt[c]) == len(node))
        out.append((
            min(own), len(node), min(members[node[:-1]]) if node else None, len(own), len(children[node]), leaves[node], saved[node],
            hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=str)


def talks():
    pick = random.Random(1)
    openings = [f"opening {i} é😀" for i in range(3)]
    rows = []
    for c in [*range(0, 40), *range(95, 130), *range(300, 330), -7, -100, -130]:
        n = pick.choice([0, 1, 2, 4, 7, 9]) + 1
        rows += [(c, t, pick.choice(["user", "assistant"]), pick.choice(openings)) for t in range(n)]
    # deep ones that part late, copies of one conversation, ties and nulls, equal rows
    for c in (1001, 1002, 1005):
        rows += [(c, t, "user", f"turn {t}" if t < 60 else f"turn {t} of {c % 2}") for t in range(75)]
    rows += [(2000 + k, t, "user", f"copy {t}") for k in range(60) for t in range(8)]
    rows += [(3001, None, None, "null turn"), (3001, 5, "b", None), (3001, 5, "a", "x"), (3001, 5, "a", "w"), (3001, 5, "a", "w"), (None, 1, "user", "no id"), (3002, 1, "user", "")]
    pick.shuffle(rows)
    return rows


@pytest.mark.parametrize("band, stretch, ordered, piece", [(16, 4096, 1_000_000, 1 << 16), (3, 4, 50, 10)])
def test_against_plain(spark, monkeypatch, band, stretch, ordered, piece):
    for name, value in (("BAND", band), ("STRETCH", stretch), ("ORDERED", ordered), ("PIECE", piece)):
        monkeypatch.setattr(p, name, value)
    rows = talks()
    got = conversation_trie(frame(spark, rows))
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    want = plain(rows)
    assert sorted((tuple(r) for r in got.collect()), key=str) == want
    assert max(w[1] for w in want) >= 70 and max(w[3] for w in want) > 100


def test_very_many_equal_conversations_and_one_very_long(spark):
    rows = spark.range(20_000).selectExpr("id * 100 + 7 as conv_id", "0L as turn", "'user' as role", "'hello' as text").unionByName(
        spark.range(20_000).selectExpr("5L as conv_id", "cast(null as long) as turn", "'user' as role", "'again' as text"))
    got = {(r["conv_id"], r["depth"]): r for r in conversation_trie(rows).collect()}
    h = zlib.crc32(b"5") % 6
    assert len([k for k in got if k[0] == 5]) in (20_000 - h, 20_001 - h)
    root = min(k for k in got if k[1] == 0)
    assert got[root]["n_convs"] == 20_001
    top = [r for r in got.values() if r["depth"] == 1 and r["n_convs"] > 2]
    assert sum(r["n_convs"] for r in top) == sum(zlib.crc32(str(i * 100 + 7).encode()) % 6 == 0 for i in range(20_000))
    ends = [i * 100 + 7 for i in range(20_000) if zlib.crc32(str(i * 100 + 7).encode()) % 6 == 0]
    assert top[0]["ends_sha256"] == hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()


def test_empty_table(spark):
    assert conversation_trie(frame(spark, [])).count() == 0
    assert conversation_trie(frame(spark, [(None, 1, "user", "x")])).count() == 0
