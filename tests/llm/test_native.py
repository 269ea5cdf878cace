"""Mixing, decontamination and secret scans against plain Python."""

import hashlib
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import pytest

from roadtally.llm import decontaminate, mixing
from roadtally.llm.decontaminate import contamination
from roadtally.llm.mixing import Curriculum, mix, mixed_counts
from roadtally.llm.secret_scan import scan

from tests.llm.fixtures import odd_rows, sorted_rows, table, words


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# ---------------------------------------------------------------- mixing

def plain_mix(rows):
    size = [len(re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode())) for _, t, *_ in rows]
    sources = sorted({r[3] for r in rows}, key=lambda s: (s is None, (s or "").encode()))
    total = {s: sum(n for n, r in zip(size, rows) if r[3] == s) for s in sources}
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sources)}
    target, open_, left = {}, set(sources), Fraction(3, 2) * sum(size)
    while open_:
        w = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / w > 2 * total[s]}
        if not over:
            target |= {s: left * weight[s] / w for s in open_}
            break
        target |= {s: Fraction(2 * total[s]) for s in over}
        left -= sum(target[s] for s in over)
        open_ -= over
    taken, start = {}, defaultdict(int)
    for i in sorted(range(len(rows)), key=lambda i: (hashlib.md5(str(rows[i][0]).encode()).hexdigest() if rows[i][0] is not None else "", rows[i][0] is None, rows[i][0] or 0)):
        s = rows[i][3]
        g = int(target[s])
        taken[i] = sum(max(0, min(size[i], g - e * total[s] - start[s])) for e in range(2))
        start[s] += size[i]
    return [(r[0], size[i], total[r[3]], float(target[r[3]]), taken[i]) for i, r in enumerate(rows)]


@pytest.mark.parametrize("piece", [20_000, 3])
def test_mixing(spark, monkeypatch, piece):
    monkeypatch.setattr(mixing, "PIECE", piece)
    rows = odd_rows()
    got, want = sorted_rows(mixed_counts(table(spark)).drop("position")), sorted(plain_mix(rows), key=str)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert all(abs(g[3] - w[3]) < 1e-6 * max(1, w[3]) for g, w in zip(got, want))
    assert Counter((g[0], g[4]) for g in got) == Counter((w[0], w[4]) for w in want)
    assert got == sorted_rows(mixed_counts(table(spark)).drop("position"))


@pytest.mark.parametrize("equal", [True, False])
def test_mix_rows(spark, equal):
    rows = odd_rows() if equal else list(dict.fromkeys(odd_rows()))
    out = [r for r in mix(table(spark, rows)).collect()]
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))
    per_source = Counter()
    for r in out:
        per_source[r["source"]] += count(r["text"])
    want = defaultdict(int)
    for (d, *_, taken), r in zip(plain_mix(rows), rows):
        want[r[3]] += taken
    assert dict(per_source) == {s: n for s, n in want.items() if n}
    assert out[0].asDict().keys() == table(spark).first().asDict().keys()


def test_curriculum_orders_positions(spark):
    rows = [(i, "a b c", "en", s) for i, s in enumerate("xyz" * 300)]
    got = mixed_counts(table(spark, rows), Curriculum(weights=(1, 1, 1), factor=1.0, tilts=(-0.9, 0.0, 0.9)))
    parts = defaultdict(list)
    for r, s in ((r, "xyz"[r["doc_id"] % 3]) for r in got.collect()):
        parts[s].append(r["position"])
    mean = {s: sum(p) / len(p) for s, p in parts.items()}
    assert mean["x"] < 0.4 < mean["y"] < 0.6 < mean["z"] and all(0 <= p <= 1 for ps in parts.values() for p in ps)


# ---------------------------------------------------------------- decontamination

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def tokens(text):
    return WORDS.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain_contamination(rows, items):
    windows = defaultdict(set)
    for item, text in items:
        w = tokens(text)
        size = min(10, len(w))
        for i in range(len(w) - size + 1) if w else ():
            # windows of an item without id count as hits, but name no item
            windows[tuple(w[i : i + size])] |= {str(item)} - {"None"}
    out = []
    for d, text, *_ in rows:
        w = tokens(text)
        hit, who = set(), set()
        for size in {len(k) for k in windows}:
            for i in range(len(w) - size + 1):
                if tuple(w[i : i + size]) in windows:
                    hit |= set(range(i, i + size))
                    who |= windows[tuple(w[i : i + size])]
        out.append((d, len(w), len(hit), len(who), sha(",".join(sorted(who))), bool(hit)))
    return sorted(out, key=str)


@pytest.mark.parametrize("bound", [32 << 20, 0])
def test_decontamination(spark, monkeypatch, bound):
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", bound)
    item = words(40, 77)
    items = [(1, " ".join(item)), (2, "Short, ITEM here!"), (3, " ".join(item[5:20])), (4, None), (5, ""), (None, "a b c"), (10, "été x"), (11, "w1")]
    rows = odd_rows() + [
        (300, " ".join(words(50, 6) + item[3:17] + words(50, 7)).upper(), "en", "a"), (301, "x, short; item - here y short item HERE", "en", "a"),
        (302, " ".join(item[:9]), "en", "a"), (303, "été x ÉTÉ x", "en", "a"), (None, " ".join(item), "en", None), (304, " ".join(item * 30), "en", "a"), (304, "nothing", "en", "a"),
    ]
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, n long")
    got = contamination(table(spark, rows), bench).drop("items")
    assert sorted_rows(got) == plain_contamination(rows, items)


def test_decontamination_without_items_or_documents(spark):
    bench = spark.createDataFrame([], "item_id long, text string")
    got = contamination(table(spark), bench)
    assert got.count() == len(odd_rows()) and got.where("contaminated").count() == 0
    assert contamination(table(spark, []), spark.createDataFrame([(1, "a b")], "item_id long, text string")).count() == 0


# ---------------------------------------------------------------- secrets

BASE = {
    "assign": re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A),
    "access": re.compile(r"AKIA[A-Z0-9]+"), "hex": re.compile(r"[0-9a-f]+"),
}


def plain_base(text):
    out = []
    for at, (kind, pattern) in enumerate(BASE.items()):
        for m in pattern.finditer(text or ""):
            if len(m[2] if kind == "assign" else m[0]) >= {"assign": 6, "access": 20, "hex": 24}[kind]:
                out.append((m.start(), at, f"{kind}:{m.start()}:{m.end()}"))
    return [x[2] for x in sorted(out)]


def test_secrets(spark):
    pick = random.Random(8)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    keys = ["".join(pick.choice(alphabet) for _ in range(48)) for _ in range(40)]
    texts = [
        "Token: abc123 password='hunter2hunter' API_KEY = \"x.y/z=+\" token:12345", "token=token:abcdef secret = = password:=abcdefg", "😀😀 secret: 'abcdefgh' é AKIA" + "B" * 16,
        "AKIAAKIA" + "9" * 12 + " AKIAshort", "deadbeef" * 3 + "g" + "deadbeef" * 2, "toKen=abcdefK ſecret=abcdefgh", "a" * 30 + " " + "ab" * 15, "password" + " " * 60 + "= abcdefgh", "=" * 50,
    ] + [f"before {k} after" for k in keys] + ["the internationalizationalisations of antidisestablishmentarianisms " * 3] * 30
    rows = odd_rows() + [(1000 + i, t, "en", "a") for i, t in enumerate(texts)]
    got = scan(table(spark, rows))
    want = Counter()
    for d, t, *_ in rows:
        base = plain_base(t)
        kinds = Counter(x.split(":")[0] for x in base)
        want[d, kinds["assign"], kinds["access"], kinds["hex"], sha(",".join(base))] += 1
    found = got.collect()
    assert Counter((r["doc_id"], r["n_assign"], r["n_access"], r["n_hex"], r["base_sha256"]) for r in found) == want
    spans = {r["doc_id"]: r["spans"].split(",") if r["spans"] else [] for r in found}
    for i, t in enumerate(texts):
        own = spans[1000 + i]
        assert set(plain_base(t)) <= set(own) and own == sorted(own, key=lambda s: (int(s.split(":")[1]), ("assign", "access", "hex", "random").index(s.split(":")[0])))
    at = 1000 + len(texts) - 30
    assert sum(spans[i] == [f"random:7:{7 + 48}"] for i in range(at - 40, at)) >= 36
    assert all(not spans[i] for i in range(at, at + 30))
    assert scan(table(spark, [])).count() == 0
