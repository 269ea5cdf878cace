"""Line dedup: repeated lines stay in one document only."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadtally.llm.common import SPACES, keyed, staged
from roadtally.llm.seen_twice import size_for, test, twice_filter

_STRIP = SPACES.decode()


def line_keys(text: str | None, min_chars: int) -> list[bytes | None]:
    """Key of each line of a text: stripped, A-Z lower-cased, as UTF-8; None for a line that is too short."""
    stripped = [line.strip(_STRIP) for line in (text or "").split("\n")]
    return [line.encode().lower() if len(line) >= min_chars else None for line in stripped]


def _hash(keys: list[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(k) for k in keys), np.uint64, len(keys))


def dedup_lines(docs: DataFrame, min_chars: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256, kept: each repeated line stays in its first document only.

    A text is split at \\n; a line's key is the line without ASCII white space
    at its ends, A-Z lower-cased. Keys of `min_chars` code points or more that
    at least two documents hold lose all their lines except in the smallest
    doc_id that holds them. Two Bloom filters (keys seen once, keys seen
    twice) pick the suspected repeats; these alone shuffle, with their full
    text, for the exact confirmation and the choice of the first document.
    Lines that are no repeats never leave their task.

    Null or empty text: one empty line. Rows of one doc_id are one document
    when documents are counted, and each gives a row. A row without doc_id
    keeps all lines and counts for none. Empty table: no rows. Only the two
    named columns are read.
    """
    spark = docs.sparkSession
    rows = keyed(docs, id_col, text_col)
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    bits = size_for(chars / 40)

    def of_batch(batch: pa.RecordBatch) -> np.ndarray:
        texts, ids = batch.column("text").to_pylist(), batch.column("own_id").to_pylist()
        return _hash([k for text, own in zip(texts, ids) if own is not None for k in {*line_keys(text, min_chars)} if k is not None])

    twice = twice_filter(spark, rows.select("own_id", "text"), of_batch, bits)

    def suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, rxs, keys = [], [], []
            for own, rx, text in zip(*(batch.column(c).to_pylist() for c in ("own_id", "rx", "text"))):
                found = [k for k in {*line_keys(text, min_chars)} if k is not None and own is not None]
                if found:
                    hit = np.flatnonzero(test(twice.value, _hash(found), bits))
                    ids += [own] * len(hit)
                    rxs += [rx] * len(hit)
                    keys += [found[i] for i in hit]
            yield pa.RecordBatch.from_pydict({"id": pa.array(ids, pa.int64()), "rx": pa.array(rxs, pa.int64()), "key": pa.array(keys, pa.binary())})

    maybe = staged(spark, rows.select(F.col("own_id").cast("long"), "rx", "text").mapInArrow(suspects, "id long, rx long, key binary"), "suspected-lines")
    repeated = maybe.groupBy("key").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last").select("key", "first")
    # as a table of its own it is shuffled like the other side, so that a line of very many documents can be split in the join
    repeated = staged(spark, repeated, "repeated-lines")
    lost = maybe.join(repeated, "key").where("id > first").groupBy("id", "rx").agg(F.collect_set("key").alias("lost"))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {"n_lines": [], "n_dropped": [], "kept_sha256": [], "kept": []}
            for text, gone in zip(batch.column("text").to_pylist(), batch.column("lost").to_pylist()):
                lines, left = (text or "").split("\n"), None
                if gone:
                    dead = set(gone)
                    left = [line for line, key in zip(lines, line_keys(text, min_chars)) if key is None or key not in dead]
                kept = (text or "") if left is None else "\n".join(left)
                out["n_lines"].append(len(lines))
                out["n_dropped"].append(0 if left is None else len(lines) - len(left))
                out["kept_sha256"].append(hashlib.sha256(kept.encode()).hexdigest())
                out["kept"].append(kept)
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("own_id"), **out})

    own = docs.schema[id_col].dataType.simpleString()
    return (
        rows.select("own_id", "id", "rx", "text").join(lost, ["id", "rx"], "left").select("own_id", "text", "lost")
        .mapInArrow(keep, f"doc_id {own}, n_lines long, n_dropped long, kept_sha256 string, kept string")
    )
