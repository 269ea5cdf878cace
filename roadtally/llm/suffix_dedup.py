"""Suffix-array dedup: bytes of long repeated strings are removed."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from roadtally.llm.common import BYTE_CODES, keyed
from roadtally.llm.repeats import Stretch, Units, covered, matched_by_extents, matched_by_windows, repeated_windows

#: Bytes that multikey quicksort looks at; suffixes that agree on all of them are ordered by a blind trie.
SHALLOW = 64
#: Stretches of one anchor whose pairs are read off the two suffix arrays; larger groups count digests of their windows.
PAIRS = 256


def common_prefix(a: bytes, b: bytes) -> int:
    """Length of the longest common prefix, by halving."""
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


def multikey(suffixes: list[bytes], depth: int) -> list[list[int]]:
    """Groups of suffixes that agree on `depth` bytes, in order: a stable sort by one column of 8-byte symbols after the other, all groups a step."""
    padded = b"".join(s[:depth].ljust(depth, b"\0") for s in suffixes)
    symbols = np.frombuffer(padded, ">u8").reshape(len(suffixes), depth // 8)
    order, group = np.arange(len(suffixes)), np.zeros(len(suffixes), np.int64)
    for column in range(symbols.shape[1]):
        if group[-1] == len(order) - 1:
            break
        symbol = symbols[order, column]
        by = np.lexsort((symbol, group))
        order, group, symbol = order[by], group[by], symbol[by]
        group = np.cumsum(np.concatenate(([False], (np.diff(group) != 0) | (symbol[1:] != symbol[:-1]))))
    return [g.tolist() for g in np.split(order, np.flatnonzero(np.diff(group)) + 1)]


def blind_trie(suffixes: list[bytes], members: list[int]) -> list[tuple[int, int]]:
    """(suffix, common prefix with the one before) in order.

    A trie that holds branching depths only: a suffix goes down blindly by the
    bytes at these depths to some leaf, is compared with that leaf once, and
    branches off where they differ. A suffix's end comes before any byte.
    """
    def symbol(i: int, depth: int) -> int:
        return suffixes[i][depth] if depth < len(suffixes[i]) else -1

    root: list = [members[0]]  # a leaf: suffixes that are equal; an inner node: (depth, children by symbol)
    for i in members[1:]:
        node, path = root, []
        while isinstance(node, tuple):
            path.append(node)
            node = node[1].get(symbol(i, node[0])) or next(iter(node[1].values()))
        depth = common_prefix(suffixes[i], suffixes[node[0]])
        if depth == len(suffixes[i]) == len(suffixes[node[0]]):
            node.append(i)
            continue
        above = [n for n in path if n[0] < depth]
        below = path[len(above)] if len(above) < len(path) else node
        if isinstance(below, tuple) and below[0] == depth:
            below[1][symbol(i, depth)] = [i]
            continue
        fork = (depth, {symbol(node[0], depth): below, symbol(i, depth): [i]})
        if above:
            above[-1][1][symbol(i, above[-1][0])] = fork
        else:
            root = fork

    out: list[tuple[int, int]] = []
    todo: list[tuple] = [(root, 0)]
    while todo:
        node, before = todo.pop()
        if isinstance(node, tuple):
            children = [node[1][s] for s in sorted(node[1])]
            todo += [(c, node[0]) for c in children[:0:-1]] + [(children[0], before)]
        else:
            out += [(i, len(suffixes[i]) if n else before) for n, i in enumerate(node)]
    return out


def suffix_array(suffixes: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes and each one's common prefix with the one before it, by deep-shallow sorting."""
    order: list[int] = []
    lcp: list[int] = []
    for group in multikey(suffixes, SHALLOW):
        ordered = blind_trie(suffixes, group)
        first = ordered[0][0]
        lcp.append(common_prefix(suffixes[order[-1]], suffixes[first]) if order else 0)
        lcp += [depth for _, depth in ordered[1:]]
        order += [i for i, _ in ordered]
    return np.array(order), np.array(lcp)


def extents(suffixes: list[bytes]) -> np.ndarray:
    """Common prefix of each two suffixes: the least of the array's values between them."""
    n = len(suffixes)
    if n == 2:
        both = common_prefix(*suffixes)
        return np.full((2, 2), both)
    order, lcp = suffix_array(suffixes)
    ranked = np.zeros((n, n), np.int64)
    for i in range(n - 1):
        ranked[i, i + 1 :] = np.minimum.accumulate(lcp[i + 1 :])
    ranked = np.maximum(ranked, ranked.T)
    out = np.empty_like(ranked)
    out[np.ix_(order, order)] = ranked
    return out


def by_suffix_arrays(stretches: list[Stretch], units: Units) -> list[np.ndarray]:
    """Shared windows from the suffix array of what follows the anchor and the one of what precedes it, reversed."""
    if len(stretches) > PAIRS:
        return matched_by_windows(stretches, units)
    right = extents([s.body[s.at :] for s in stretches])
    left = extents([s.body[: s.at][::-1] for s in stretches])
    return matched_by_extents(stretches, units, right, left)


def _codes(raw: bytes) -> np.ndarray:
    return BYTE_CODES[np.frombuffer(raw, np.uint8)]


def _cutter(raw: bytes):
    return lambda lo, hi: raw[lo:hi]


def dedup_suffixes(docs: DataFrame, window: int = 400, gram: int = 32, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept: bytes that a repeated string of `window` bytes covers go.

    Texts are UTF-8 bytes and strings never cross documents. The suffixes that
    are sorted start at anchors (see `repeats`): suffixes of one anchor meet
    in a task, and deep-shallow sorting of what follows and what precedes the
    anchor gives the strings they share. `kept` is binary, since a cut can
    fall inside a character.

    Null or empty texts and texts of fewer than `window` bytes lose nothing.
    Every row is a document of its own: a repeated row repeats all its
    strings. A null doc_id stays null. Empty table: no rows.
    """
    units = Units(window, gram, _codes, _cutter, _codes, 1.0)
    rows = keyed(docs, id_col, text_col)
    spans = repeated_windows(rows, units, by_suffix_arrays)

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {"n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": [], "kept": []}
            for text, found in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
                raw = (text or "").encode()
                gone = covered(found, len(raw), window)
                kept = np.frombuffer(raw, np.uint8)[~gone].tobytes() if found else raw
                out["n_bytes"].append(len(raw))
                out["n_removed"].append(int(gone.sum()))
                out["n_spans"].append(int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum()))
                out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
                out["kept"].append(kept)
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("own_id"), **out}, schema=pa.schema([
                ("doc_id", batch.column("own_id").type), *((n, pa.int64()) for n in ("n_bytes", "n_removed", "n_spans")),
                ("kept_sha256", pa.string()), ("kept", pa.binary())]))

    own = docs.schema[id_col].dataType.simpleString()
    return rows.join(spans, ["id", "rx"], "left").select("own_id", "text", "spans").mapInArrow(
        remove, f"doc_id {own}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
