"""Where long stretches of documents repeat: the frame of suffix-array and substring dedup.

A document is a sequence of units (bytes, or words). A window is `window`
consecutive units; it is repeated if the same units also start anywhere else.
Every window has an anchor, chosen by its content alone: the least digest of
`gram` units among all that lie in it (winnowing). Equal windows have equal
anchors at equal offsets, so only documents' anchors have to meet:

1. one pass over the texts finds all anchors; a filter of anchors seen twice
   (`seen_twice`) is built without shuffling them;
2. a second pass emits the suspected anchors, each with the stretch that its
   windows cover;
3. anchors with equal stretches settle each other by a distributed count, so
   thousands of copies of one text never meet in a task;
4. where stretches of one anchor differ, one of each kind meets the others and
   a `Matcher` finds their common windows: the two operators differ here. An
   anchor with more than HOT kinds is settled by counting digests of its
   windows instead, a distributed aggregate that needs no key in one task.

The result is exact up to collisions of 64-bit digests among windows that share an anchor.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadtally.llm.common import BASE, Digests, mix, sliding_min, staged
from roadtally.llm.seen_twice import size_for, test, twice_filter

#: Kinds of stretches of one anchor that meet in a task.
HOT = 2048
#: Units of a text that are handled at once; longer texts are cut with an overlap that loses no window.
SEGMENT = 1 << 22
PLACE = np.uint64((1 << 24) - 1)
ROW = "akey long, kind long, id long, rx long, pos long, lo long, hi long, body binary"


@dataclass(frozen=True)
class Units:
    """How a text becomes units: `codes` of all units, `cut` the bytes of a stretch, `parse` its codes again."""

    window: int
    gram: int
    codes: Callable[[bytes], np.ndarray]
    cutter: Callable[[bytes], Callable[[int, int], bytes]]
    parse: Callable[[bytes], np.ndarray]
    #: Bytes of text per unit, for the size of the filter only.
    unit_bytes: float


@dataclass
class Stretch:
    """An anchor's stretch in a group: code at `at` starts the anchor; its windows start at 0..len - window."""

    body: bytes
    codes: np.ndarray
    at: int
    last: int


#: For each stretch of a group, the flags of its window starts 0..last that another stretch shares.
Matcher = Callable[[list[Stretch], Units], list[np.ndarray]]


def anchors(codes: np.ndarray, units: Units) -> tuple[np.ndarray, ...]:
    """Anchor digest, anchor place, first and last window start of each anchor of a sequence; digest of the stretch."""
    n, k = len(codes), units.gram
    none = np.empty(0, np.int64)
    if n < units.window:
        return none.view(np.uint64), none, none, none, none.view(np.uint64)
    out = []
    for base in range(0, n - units.window + 1, SEGMENT):
        part = codes[base : base + SEGMENT + units.window - 1]
        digests = Digests(part)
        starts = np.arange(len(part) - k + 1)
        grams = digests.of(starts, starts + k)
        least = sliding_min((grams & ~PLACE) | starts.astype(np.uint64), units.window - k + 1)
        first = np.flatnonzero(np.concatenate(([True], np.diff(least & PLACE) != 0)))
        last = np.append(first[1:], len(least)) - 1
        pos = (least[first] & PLACE).astype(np.int64)
        shape = mix((pos - first).astype(np.uint64) * np.uint64(BASE) + (last - first).astype(np.uint64))
        kinds = digests.of(first, last + units.window) ^ shape
        out.append((grams[pos], pos + base, first + base, last + base, kinds))
    return tuple(np.concatenate(column) for column in zip(*out))


def repeated_windows(rows: DataFrame, units: Units, match: Matcher) -> DataFrame:
    """id, rx, spans: for each row of `keyed` documents with repeated windows, the runs [lo, hi] of their starts."""
    spark = rows.sparkSession
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    bits = size_for(total / units.unit_bytes * 2 / (units.window - units.gram + 2))

    def of_batch(batch: pa.RecordBatch) -> np.ndarray:
        found = [anchors(units.codes(t.encode()), units)[0] for t in batch.column("text").to_pylist() if t]
        return np.concatenate([np.empty(0, np.uint64), *found])

    twice = twice_filter(spark, rows.select("text"), of_batch, bits)

    def suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[] for _ in range(8)]
            for id_, rx, text in zip(*(batch.column(c).to_pylist() for c in ("id", "rx", "text"))):
                if not text:
                    continue
                raw = text.encode()
                akey, pos, lo, hi, kind = anchors(units.codes(raw), units)
                some = np.flatnonzero(test(twice.value, akey, bits)) if len(akey) else akey
                if not len(some):
                    continue
                cut = units.cutter(raw)
                for column, values in zip(columns, (
                    akey[some].view(np.int64).tolist(), kind[some].view(np.int64).tolist(), [id_] * len(some), [rx] * len(some),
                    pos[some].tolist(), lo[some].tolist(), hi[some].tolist(), [cut(lo[i], hi[i] + units.window) for i in some],
                )):
                    column += values
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns[:7]] + [pa.array(columns[7], pa.binary())],
                ["akey", "kind", "id", "rx", "pos", "lo", "hi", "body"],
            )

    found = staged(spark, rows.select("id", "rx", "text").mapInArrow(suspects, ROW), "anchors")
    me = F.struct("id", "rx", "pos")
    kinds = found.groupBy("akey", "kind").agg(F.count(F.lit(1)).alias("n"), F.min(me).alias("one"))
    mixed = (
        kinds.groupBy("akey").agg(F.count(F.lit(1)).alias("kinds"), F.min("n").alias("least"))
        .where("kinds > 1 and least = 1").select("akey", "kinds")
    )
    # a table of its own, like every small side here: both sides of its join are then shuffled and a hot anchor can be split
    known = staged(spark, kinds.join(mixed, "akey", "left").where("n > 1 or kinds is not null"), "known-anchors")
    met = found.join(known, ["akey", "kind"])
    settled = met.where("n > 1").select("id", "rx", "lo", "hi")
    open_ = met.where((F.col("kinds") > 1) & ((F.col("n") == 1) | (F.col("one") == me))).select(
        "akey", "id", "rx", "pos", "lo", "hi", "body", "kinds", "n")
    open_ = staged(spark, open_, "open-anchors")
    pairs = (
        open_.where(F.col("kinds") <= HOT).repartition("akey").sortWithinPartitions("akey")
        .mapInArrow(_in_groups(units, match), "id long, rx long, lo long, hi long")
    )
    runs = settled.unionByName(pairs).unionByName(_by_digests(open_.where(F.col("kinds") > HOT), units))
    # equal rows have equal runs: each once, before they are collected
    return runs.distinct().groupBy("id", "rx").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))


def _runs(flags: np.ndarray, lo: int) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
    return [(lo + int(a), lo + int(b) - 1) for a, b in zip(edges[::2], edges[1::2])]


def _in_groups(units: Units, match: Matcher):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[tuple] = []
        out: list[tuple] = []

        def settle() -> None:
            if len(group) > 1:
                parsed = [Stretch(r[5], units.parse(r[5]), r[2] - r[3], r[4] - r[3]) for r in group]
                for (_, (id_, rx), _, lo, _, _, n), flags in zip(group, match(parsed, units)):
                    if n == 1:
                        out.extend((id_, rx, a, b) for a, b in _runs(flags, lo))
            group.clear()

        for batch in batches:
            for akey, id_, rx, pos, lo, hi, body, _, n in zip(*(c.to_pylist() for c in batch.columns)):
                if group and group[0][0] != akey:
                    settle()
                group.append((akey, (id_, rx), pos, lo, hi, body, n))
            yield _spans(out)
            out.clear()
        settle()
        yield _spans(out)

    return work


def _spans(out: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*out)) or [()] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["id", "rx", "lo", "hi"])


def _by_digests(hot: DataFrame, units: Units) -> DataFrame:
    """Repeated windows of anchors with very many kinds: a count of window digests, combined before the shuffle."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list[np.ndarray]] = [[np.empty(0, np.int64)] for _ in range(6)]
            for akey, id_, rx, _, lo, hi, body, _, n in zip(*(c.to_pylist() for c in batch.columns)):
                starts = np.arange(hi - lo + 1)
                digest = Digests(units.parse(body)).of(starts, starts + units.window).view(np.int64)
                for column, values in zip(columns, (akey, digest, id_, rx, starts + lo, n)):
                    column.append(np.broadcast_to(np.asarray(values, np.int64), len(starts)))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in columns], ["akey", "wkey", "id", "rx", "lo", "n"])

    rows = hot.mapInArrow(windows, "akey long, wkey long, id long, rx long, lo long, n long")
    twice = rows.groupBy("akey", "wkey").agg(F.count(F.lit(1)).alias("times")).where("times > 1").select("akey", "wkey")
    twice = staged(hot.sparkSession, twice, "repeated-windows")
    return rows.where("n = 1").join(twice, ["akey", "wkey"], "left_semi").select("id", "rx", "lo", F.col("lo").alias("hi"))


def covered(spans: list[dict] | None, length: int, window: int) -> np.ndarray:
    """Flags of the units that repeated windows cover."""
    steps = np.zeros(length + 1, np.int32)
    if spans:
        lo = np.fromiter((s["lo"] for s in spans), np.int64, len(spans))
        hi = np.fromiter((s["hi"] for s in spans), np.int64, len(spans))
        np.add.at(steps, lo, 1)
        np.add.at(steps, np.minimum(hi + window, length), -1)
    return np.cumsum(steps[:-1]) > 0


def matched_by_extents(stretches: list[Stretch], units: Units, right: np.ndarray, left: np.ndarray) -> list[np.ndarray]:
    """Flags of shared windows from the pairs' common units right of (and with) the anchor's start and left of it.

    Stretches i and j share the windows that start o units before the anchor
    for window - right[i, j] <= o <= left[i, j].
    """
    out = []
    for i, s in enumerate(stretches):
        flags = np.zeros(s.last + 1, dtype=bool)
        for r, l in {(int(r), int(l)) for j, (r, l) in enumerate(zip(right[i], left[i])) if j != i}:
            a, b = s.at - l, s.at - (units.window - r)
            if a <= b and b >= 0:
                flags[max(a, 0) : b + 1] = True
        out.append(flags)
    return out


def matched_by_windows(stretches: list[Stretch], units: Units) -> list[np.ndarray]:
    """The same for a large group, in time that is linear in it: window digests at equal offsets are counted."""
    keys, owner = [], []
    for i, s in enumerate(stretches):
        starts = np.arange(s.last + 1)
        keys.append(Digests(s.codes).of(starts, starts + units.window))
        owner.append(np.full(len(starts), i))
    _, at, counts = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
    hit = counts[at] > 1
    cuts = np.cumsum([len(k) for k in keys])[:-1]
    return np.split(hit, cuts)
