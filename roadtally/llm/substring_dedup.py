"""Substring dedup: words of repeated passages are removed."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from roadtally.llm.common import keyed, word_bounds, word_codes
from roadtally.llm.repeats import Stretch, Units, covered, matched_by_extents, matched_by_windows, repeated_windows

#: Stretches of one seed that are extended pair by pair.
PAIRS = 48


def _codes(raw: bytes) -> np.ndarray:
    return word_codes(np.frombuffer(raw, np.uint8))


def _cutter(raw: bytes):
    starts, ends = word_bounds(np.frombuffer(raw, np.uint8))
    return lambda lo, hi: raw[starts[lo] : ends[hi - 1]]


def word_units(window: int, gram: int) -> Units:
    return Units(window, gram, _codes, _cutter, _codes, 6.0)


def extend(stretches: list[Stretch], units: Units) -> list[np.ndarray]:
    """Seeds extended both ways, word by word, against each other; larger groups by digests of their windows."""
    if len(stretches) > PAIRS:
        return matched_by_windows(stretches, units)
    ahead, behind = units.window, units.window - units.gram
    right = np.zeros((len(stretches), ahead), np.uint64)
    left = np.zeros((len(stretches), behind), np.uint64)
    for i, s in enumerate(stretches):
        after, before = s.codes[s.at :][:ahead], s.codes[: s.at][::-1][:behind]
        # what stands beyond a stretch's end is unlike anything else
        right[i], left[i] = i + 1, i + 1
        right[i, : len(after)], left[i, : len(before)] = after, before
    r = np.logical_and.accumulate(right[:, None] == right[None], axis=2).sum(axis=2)
    l = np.logical_and.accumulate(left[:, None] == left[None], axis=2).sum(axis=2)
    return matched_by_extents(stretches, units, r, l)


def dedup_substrings(docs: DataFrame, window: int = 35, gram: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, kept: words that a repeated run of `window` words covers are removed.

    Words are runs of everything but ASCII white space, unchanged. Documents
    are joined on winnowed anchors (digests of `gram` words), matches are
    extended to both sides of the anchor, and matches of `window` words or
    more count: each word that such a run covers goes, everywhere, the run
    itself being judged on the input. Kept words are joined by one space.

    Null or empty texts and texts of fewer than `window` words lose nothing.
    Every row is a document of its own: a repeated row repeats all its
    windows. A null doc_id stays null. Empty table: no rows.
    """
    units = word_units(window, gram)
    rows = keyed(docs, id_col, text_col)
    spans = repeated_windows(rows, units, extend)

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {"n_words": [], "n_removed": [], "kept_sha256": [], "kept": []}
            for text, found in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
                words = (text or "").encode().split()
                gone = covered(found, len(words), window)
                kept = b" ".join(words if not found else [words[i] for i in np.flatnonzero(~gone)])
                out["n_words"].append(len(words))
                out["n_removed"].append(int(gone.sum()))
                out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
                out["kept"].append(kept.decode())
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("own_id"), **out})

    own = docs.schema[id_col].dataType.simpleString()
    return rows.join(spans, ["id", "rx"], "left").select("own_id", "text", "spans").mapInArrow(
        remove, f"doc_id {own}, n_words long, n_removed long, kept_sha256 string, kept string")
