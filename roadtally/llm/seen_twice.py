"""Two Bloom filters over 64-bit keys of a whole table: those seen once and those seen twice.

Every task keeps two filters of its own rows: a key that it meets goes to
"once", a key that it meets again to "twice". Tasks send the set bits only, by
segment of the filter; a segment's bit is set in the merged "twice" filter if
one task had it there or two tasks had it in "once". So the keys themselves
never shuffle. A key that occurs twice always tests positive; others do so
rarely, and whoever uses the filter confirms exactly.

The merged filter is broadcast. Its size is 16 bits per expected key, between
2**20 and MAX_BITS bits, so the broadcast is at most 256 MB however large the
table is. Above that the filter only lets more keys through to the exact
confirmation, which is a distributed aggregate; results are the same.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

MAX_BITS = 1 << 31
SEGMENT = 1 << 20
PROBES = 4


def size_for(keys: float) -> int:
    """Bits of the filter for so many expected keys."""
    return int(min(MAX_BITS, max(SEGMENT, 1 << int(np.ceil(np.log2(max(2.0, 16 * keys)))))))


def places(keys: np.ndarray, bits: int) -> np.ndarray:
    """PROBES bit numbers of each key, by double hashing."""
    a, b = keys, (keys >> np.uint64(17)) * np.uint64(0xC2B2AE3D27D4EB4F) | np.uint64(1)
    steps = np.arange(PROBES, dtype=np.uint64)[:, None]
    return (((a + steps * b) * np.uint64(0x9FB21C651E98DF25)) >> np.uint64(64 - bits.bit_length() + 1)).astype(np.int64)


def test(table: np.ndarray, keys: np.ndarray, bits: int) -> np.ndarray:
    """Whether each key is in the filter (its bytes in `table`)."""
    found = np.ones(len(keys), dtype=bool)
    for at in places(keys, bits):
        found &= (table[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
    return found


def twice_filter(spark: SparkSession, docs: DataFrame, keys_of: Callable[[pa.RecordBatch], np.ndarray], bits: int):
    """Broadcast bytes of the "twice" filter of the keys that `keys_of` makes of each batch of `docs`.

    A key counts as often as it is returned; callers return a key once for
    each of its places (or documents).
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.empty(0, np.uint64), np.empty(0, np.uint64)
        held: list[np.ndarray] = []

        def settle() -> None:
            nonlocal once, twice
            found, counts = np.unique(np.concatenate([*held, once, once[:0]]), return_counts=True)
            twice, once = np.union1d(twice, found[counts > 1]), found
            held.clear()

        for batch in batches:
            held.append(keys_of(batch))
            if sum(map(len, held)) > 1 << 20:
                settle()
        settle()
        for again, some in ((False, once), (True, twice)):
            at = np.unique(places(some, bits))
            cuts = np.flatnonzero(np.diff(at // SEGMENT)) + 1
            for part in np.split(at, cuts) if len(at) else []:
                yield pa.RecordBatch.from_pydict({
                    "segment": pa.array([int(part[0] // SEGMENT)], pa.int64()), "again": [again],
                    "bits": pa.array([(part % SEGMENT).astype(np.uint32).tobytes()], pa.binary()),
                })

    def merge(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_segment, times = None, np.zeros(SEGMENT, np.uint8)

        def closed() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({
                "segment": pa.array([open_segment], pa.int64()), "bits": pa.array([np.packbits(times > 1, bitorder="little").tobytes()], pa.binary()),
            })

        for batch in rows:
            for segment, again, packed in zip(*(batch.column(c).to_pylist() for c in ("segment", "again", "bits"))):
                if segment != open_segment:
                    if open_segment is not None:
                        yield closed()
                    open_segment, times = segment, np.zeros(SEGMENT, np.uint8)
                at = np.frombuffer(packed, np.uint32)
                times[at] = np.minimum(times[at] + (2 if again else 1), 2)
        if open_segment is not None:
            yield closed()

    merged = (
        docs.mapInArrow(pieces, "segment long, again boolean, bits binary")
        .repartition("segment").sortWithinPartitions("segment")
        .mapInArrow(merge, "segment long, bits binary")
    )
    table = np.zeros(bits // 8, np.uint8)
    for row in merged.toLocalIterator():
        at = row["segment"] * SEGMENT // 8
        table[at : at + SEGMENT // 8] = np.frombuffer(row["bits"], np.uint8)
    return spark.sparkContext.broadcast(table)
