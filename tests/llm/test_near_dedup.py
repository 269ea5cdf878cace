"""Near-dedup against all pairs on small tables."""

import random
import re

import numpy as np

from roadtally.llm import near_dedup
from roadtally.llm.components import components
from roadtally.llm.near_dedup import Sketch, likely, near_duplicates, registers, shingle_digests

from tests.llm.fixtures import odd_rows, sorted_rows, table, words


def plain(rows, percent=75):
    sets = []
    for d, t, *_ in rows:
        w = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())
        sets.append((d, {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} if w else set()))
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for i, (d, a) in enumerate(sets):
        for e, b in sets[:i]:
            if d is not None and e is not None and a and b and 100 * len(a & b) >= percent * len(a | b):
                lo, hi = sorted((find(d), find(e)))
                up[hi] = lo
    # a row without shingles is linked with nothing
    return sorted(((d, len(s), d if d is None or not s else find(d), d is None or not s or find(d) == d) for d, s in sets), key=str)


def test_odd_cases(spark):
    assert sorted_rows(near_duplicates(table(spark))) == plain(odd_rows())


def test_empty_table(spark):
    assert near_duplicates(table(spark, [])).count() == 0


def chained_rows():
    """Chains in which neighbours are linked and ends are not, and a cloud around a centre that is no row."""
    rows, text = [], words(300, 9)
    for i in range(12):
        text = list(text)
        for j in range(8):
            text[(i * 8 + j) * 3 % 300] = f"c{i}x{j}"
        rows.append((i * 7 % 12, " ".join(text), "en", "a"))
    centre = words(200, 10)
    pick = random.Random(4)
    for i in range(60):
        near = list(centre)
        for j in pick.sample(range(200), 4):
            near[j] = f"k{i}x{j}"
        rows.append((100 + i, " ".join(near), "en", "a"))
    return rows


def test_chains_and_clouds(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "TILE", 8)
    monkeypatch.setattr(near_dedup, "CHUNK", 4)
    rows = chained_rows()
    assert sorted_rows(near_duplicates(table(spark, rows))) == plain(rows)


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 90), (90, 95), (200, 200)]
    got = dict(sorted_rows(components(spark.createDataFrame(edges, "a long, b long"))))
    assert got == {**{i: 0 for i in range(41)}, 90: 90, 95: 90, 100: 90}


def test_registers_merge_and_estimate():
    sketch = Sketch(bands=80)
    a, b = words(3000, 1, 10**6), words(3000, 2, 10**6)
    x, y = a[:2500] + b[:500], a[:2500] + b[500:1000]
    dx, dy = (shingle_digests([w.encode() for w in t], 5) for t in (x, y))
    rx, ry = registers(dx, sketch), registers(dy, sketch)
    assert (np.maximum(rx, ry) == registers(np.union1d(dx, dy), sketch)).all()
    true = len(np.intersect1d(dx, dy)) / len(np.union1d(dx, dy))
    got, keep = likely(*(np.array([v]) for v in ((rx > ry).sum(), (rx < ry).sum(), len(dx), len(dy))), sketch)
    assert abs(got[0] - true) < 0.08 and keep[0]
    far = shingle_digests([w.encode() for w in a[:800] + b], 5)
    rf = registers(far, sketch)
    assert not likely(*(np.array([v]) for v in ((rx > rf).sum(), (rx < rf).sum(), len(dx), len(far))), sketch)[1][0]
