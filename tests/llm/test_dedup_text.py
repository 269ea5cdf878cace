"""Line, suffix-array and substring dedup against plain Python."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest

from roadtally.llm import repeats
from roadtally.llm.line_dedup import dedup_lines
from roadtally.llm.repeats import Stretch
from roadtally.llm.seen_twice import size_for
from roadtally.llm.substring_dedup import dedup_substrings, extend, word_units
from roadtally.llm.suffix_dedup import dedup_suffixes, suffix_array

from tests.llm.fixtures import odd_rows, sorted_rows, table, words

STRIP = " \t\n\r\x0b\x0c"


def sha(x) -> str:
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def plain_lines(rows):
    def key(line):
        line = line.strip(STRIP)
        return line.encode().lower() if len(line) >= 10 else None

    holders = {}
    for d, t, *_ in rows:
        for line in (t or "").split("\n"):
            if d is not None and key(line) is not None:
                holders.setdefault(key(line), set()).add(d)
    out = []
    for d, t, *_ in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if d is None or key(x) is None or len(holders[key(x)]) < 2 or min(holders[key(x)]) == d]
        out.append((d, len(lines), len(lines) - len(kept), sha("\n".join(kept))))
    return sorted(out, key=str)


def removed(units, seen, window):
    gone = np.zeros(len(units), bool)
    for i in range(len(units) - window + 1):
        if seen[tuple(units[i : i + window])] > 1:
            gone[i : i + window] = True
    return gone


def plain_substrings(rows, window):
    split = [(d, re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode())) for d, t, *_ in rows]
    seen = Counter(tuple(w[i : i + window]) for _, w in split for i in range(len(w) - window + 1))
    out = []
    for d, w in split:
        gone = removed(w, seen, window)
        out.append((d, len(w), int(gone.sum()), sha(b" ".join(x for x, g in zip(w, gone) if not g))))
    return sorted(out, key=str)


def plain_suffixes(rows, window):
    raws = [(d, (t or "").encode()) for d, t, *_ in rows]
    seen = Counter(r[i : i + window] for _, r in raws for i in range(len(r) - window + 1))
    out = []
    for d, r in raws:
        gone = np.zeros(len(r) + 1, bool)
        for i in range(len(r) - window + 1):
            if seen[r[i : i + window]] > 1:
                gone[i : i + window] = True
        runs = sum(1 for i in range(len(r)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((d, len(r), int(gone.sum()), runs, sha(bytes(b for b, g in zip(r, gone) if not g))))
    return sorted(out, key=str)


def test_lines(spark):
    rows = odd_rows()
    assert sorted_rows(dedup_lines(table(spark)).drop("kept")) == plain_lines(rows)


@pytest.mark.parametrize("hot", [2048, 3])
def test_substrings(spark, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT", hot)
    assert sorted_rows(dedup_substrings(table(spark), window=12, gram=4).drop("kept")) == plain_substrings(odd_rows(), 12)


@pytest.mark.parametrize("hot", [2048, 3])
def test_suffixes(spark, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT", hot)
    rows = [r for r in odd_rows() if len(r[1] or "") < 20000]
    assert sorted_rows(dedup_suffixes(table(spark, rows), window=80, gram=12).drop("kept")) == plain_suffixes(rows, 80)


def test_planted_passages_go_by_bytes_not_words(spark):
    """Passages of over 50 words in two documents each: those of 400 bytes go, shorter ones and clean documents stay."""
    short, edge, long = (" ".join(words(n, seed)) for n, seed in ((60, 21), (90, 22), (120, 23)))
    assert len(short) < 399 and len(edge) > 400 and len(long) > 400
    rows = [
        (1, f"{' '.join(words(40, 31))} {short} {' '.join(words(40, 32))}"), (2, f"x{short}y"),
        (3, f"a{edge[:399]}b"), (4, f"c{edge[:399]}d"), (5, f"e{edge[10:410]}f"), (6, f"g{edge[10:410]}h"),
        (7, f"{' '.join(words(50, 33))} {long} {' '.join(words(50, 34))}"), (8, f"i{long}j"), (9, f"k{long[:450]}l{long[:450]}m"),
        (10, " ".join(words(300, 35))), (11, " ".join(words(300, 36))),
    ]
    got = {r["doc_id"]: r for r in dedup_suffixes(table(spark, [(*r, "en", "a") for r in rows])).collect()}
    assert {d: r["n_removed"] for d, r in got.items() if d not in (3, 4, 5, 6, 7)} == {
        1: 0, 2: 0, 8: len(long), 9: 900, 10: 0, 11: 0}
    assert all(r["n_bytes"] == len(dict(rows)[d]) for d, r in got.items())
    assert sorted((tuple(r)[:5] for r in got.values()), key=str) == plain_suffixes(rows, 400)


def test_long_texts_are_cut_without_loss(spark, monkeypatch):
    monkeypatch.setattr(repeats, "SEGMENT", 50)
    assert sorted_rows(dedup_substrings(table(spark), window=12, gram=4).drop("kept")) == plain_substrings(odd_rows(), 12)


def test_empty_tables(spark):
    none = table(spark, [])
    assert dedup_lines(none).count() == dedup_substrings(none).count() == dedup_suffixes(none).count() == 0


def test_large_and_small_groups_agree():
    rng = np.random.default_rng(3)
    units = word_units(12, 4)
    core = [f"c{i}" for i in range(4)]
    stretches = []
    for i in range(60):
        body = " ".join([f"l{x}" for x in rng.integers(0, 2, 8)] + core + [f"r{x}" for x in rng.integers(0, 2, 8)]).encode()
        stretches.append(Stretch(body, units.parse(body), 8, 8))
    few = [extend(stretches[:40], units), repeats.matched_by_windows(stretches[:40], units)]
    assert all((a == b).all() for a, b in zip(*few))


def test_suffix_array_is_sorted():
    rng = np.random.default_rng(4)
    heads = [bytes(rng.integers(97, 99, n).tolist()) for n in (0, 3, 70, 200)]
    some = [heads[rng.integers(4)] + bytes(rng.integers(97, 100, rng.integers(0, 90)).tolist()) for _ in range(300)]
    order, lcp = suffix_array(some)
    got = [some[i] for i in order]
    assert got == sorted(some)
    for a, b, depth in zip(got, got[1:], lcp[1:]):
        assert a[:depth] == b[:depth] and (len(a) == depth or len(b) == depth or a[depth] != b[depth])


def test_filter_size_is_bounded():
    assert size_for(0) == 1 << 20 and size_for(1e15) == 1 << 31
