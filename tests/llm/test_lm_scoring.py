"""LM scores against a trie that is updated symbol by symbol."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from roadtally.llm import lm_scoring
from roadtally.llm.lm_scoring import Settings, blocks, lm_scores, symbol_scores

from tests.llm.fixtures import odd_rows, table, words

END = 256


class Trie:
    """Partial matching in its textbook form: update exclusion, escape method D, symbol exclusion."""

    def __init__(self, order):
        self.order, self.seen = order, [defaultdict(Counter) for _ in range(order + 1)]

    def contexts(self, history):
        padded = [END] * self.order + history
        return [tuple(padded[len(padded) - o :]) for o in range(self.order + 1)]

    def update(self, text):
        symbols = [*text, END]
        for i, s in enumerate(symbols):
            for o, c in reversed(list(enumerate(self.contexts(symbols[:i][-self.order :] if self.order else [])))):
                new = s not in self.seen[o][c]
                self.seen[o][c][s] += 1
                if not new:
                    break

    def probability(self, history, s):
        excluded, p = set(), 1.0
        for o, c in reversed(list(enumerate(self.contexts(history)))):
            here = {k: n for k, n in self.seen[o][c].items() if k not in excluded}
            if not here:
                continue
            n = sum(here.values())
            if s in here:
                return p * (2 * here[s] - 1) / (2 * n)
            p *= len(here) / (2 * n)
            excluded |= set(here)
        return p / (257 - len(excluded))

    def score(self, text):
        symbols = [*text, END]
        return sum(math.log10(self.probability(symbols[max(0, i - self.order) : i], s)) for i, s in enumerate(symbols))


def plain(rows, order, full=lambda d: True):
    held = [d is not None and zlib.crc32(str(d).encode()) % 7 == 2 for d, *_ in rows]
    raw = [(t or "").encode().lower() for _, t, *_ in rows]
    trie, counts = Trie(order), Counter()
    for text, out in zip(raw, held):
        if not out:
            trie.update(text)
            counts.update([*re.findall(rb"[^\x20\x09-\x0D]+", text), "end"])
    n, v = sum(counts.values()), len(counts)
    out = []
    for (d, *_), text, h in zip(rows, raw, held):
        tokens = [*re.findall(rb"[^\x20\x09-\x0D]+", text), "end"]
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens)
        out.append((d, h, len(tokens), sum(counts[w] > 0 for w in tokens), n, base, trie.score(text)))
    return sorted(out, key=lambda r: (str(r[0]), r[5], r[6]))


def compare(got, want):
    got = sorted((tuple(r) for r in got.collect()), key=lambda r: (str(r[0]), r[5], r[6]))
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5:] for g in got], [w[5:] for w in want], rtol=1e-9, atol=1e-9)


@pytest.mark.parametrize("order, chunk, piece", [(4, 16 << 20, 1 << 20), (2, 3000, 700)])
def test_against_a_trie(spark, monkeypatch, order, chunk, piece):
    monkeypatch.setattr(lm_scoring, "PIECE", piece)
    rows = [r for r in odd_rows() if not r[1] or len(r[1]) < 10_000] + [(300 + i, " ".join(words(30, i, 90)) + " ÉÈ\0\x01", "en", "a") for i in range(40)]
    rows += [(340, "zq " * 900, "en", "a"), (341, "no such w\x7f word", "en", "a")]
    assert any(zlib.crc32(str(r[0]).encode()) % 7 == 2 for r in rows)
    compare(lm_scores(table(spark, rows).repartition(3), Settings(order, chunk)), plain(rows, order))


def test_pieces_hold_every_gram_once(monkeypatch):
    texts = [b"", b"a", b"abcdefghij" * 3, b"\0\0", b"xyz"]
    for piece in (1, 3, 7, 1000):
        monkeypatch.setattr(lm_scoring, "PIECE", piece)
        for order in (1, 3, 6):
            want, got = [], [[] for _ in texts]
            for t in texts:
                s = [END] * order + [*t, END]
                want.append([sum(x << 9 * (order - j) for j, x in enumerate(s[i : i + order + 1])) for i in range(len(t) + 1)])
            for owners, sizes, grams in blocks(texts, order):
                for o, part in zip(owners, np.split(grams, np.cumsum(sizes)[:-1])):
                    got[o] += part.tolist()
            assert got == want


def test_probabilities_add_up_to_one(spark):
    trie = Trie(2)
    for t in (b"abracadabra", b"abc", b"cab"):
        trie.update(t)
    grams = {}
    for t in (b"abracadabra", b"abc", b"cab"):
        s = [END] * 2 + [*t, END]
        for i in range(len(s) - 2):
            g = (s[i] << 18) | (s[i + 1] << 9) | s[i + 2]
            grams[g] = grams.get(g, 0) + 1
    contexts = [(97, 98), (120, 121), (END, END), (120, 97)]
    for a, b in contexts:
        for s in range(257):
            grams.setdefault((a << 18) | (b << 9) | s, 0)
    found = {r["gram"]: r["score"] for r in symbol_scores(spark.createDataFrame(list(grams.items()), "gram long, c long"), 2).collect()}
    for a, b in contexts:
        p = [10 ** found[(a << 18) | (b << 9) | s] for s in range(257)]
        assert abs(sum(p) - 1) < 1e-9
        assert np.allclose(p, [trie.probability([a, b], s) for s in range(257)])


def test_nothing_to_learn_from(spark):
    held = [i for i in range(60) if zlib.crc32(str(i).encode()) % 7 == 2]
    got = lm_scores(table(spark, [(held[0], "ab", "en", "a"), (held[1], None, "en", "a")])).orderBy("n_tokens").collect()
    assert [(r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in got] == [(1, 0, 0, 0.0), (2, 0, 0, 0.0)]
    assert np.allclose([r["score"] for r in got], [-math.log10(257), -3 * math.log10(257)])
    assert lm_scores(table(spark, [])).count() == 0
