"""Spelling variants against plain Python."""

import random
import re
import zlib
from collections import Counter

import pytest

from roadtally.llm import spelling_variants as s
from roadtally.llm.spelling_variants import group_variants, near_pairs, spelling_variants

from tests.llm.fixtures import odd_rows, table


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) > len(b):
        a, b = b, a
    i = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a[i:] == b[i + 1 :] if len(a) < len(b) else a[i + 1 :] == b[i + 1 :]


def plain_words(rows, every, min_chars=7):
    n = Counter()
    for d, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if every and h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= min_chars and k >= 2}


def plain_groups(words):
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 10 * words[w] else None
    out = []
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out, key=str)


def texts():
    pick = random.Random(3)
    stems = ["prefixed" + "".join(pick.choice("abé") for _ in range(k)) for k in range(5) for _ in range(12)]
    stems += ["".join(pick.choice("xy") for _ in range(8)) for _ in range(60)] + ["Ünvérsal", "ünversal", "×÷letters", "Ærodrome", "ÆRODROME"]
    rows = []
    for i, w in enumerate(stems):
        rows.append((i, " ".join([w] * (2 * 10 ** (i % 3))) + f" {w[:-1]} {w[:-1]}'s, {w}x {w}x.", "en", "a"))
    # a chain: each form ten times as frequent as the one before
    chain = [("chainedword", 4000), ("chainedwordz", 400), ("chainedwordzz", 40), ("chainedwordzzz", 4)]
    return rows + [(900 + i, " ".join([w] * n), "en", "a") for i, (w, n) in enumerate(chain)] + [(950, "q" * 5000 + " " + "q" * 5000 + " " + ("q" * 5001 + " ") * 30, "en", None)]


@pytest.mark.parametrize("pairs", [s.PAIRS_A_WORD, 0])
def test_against_all_pairs(spark, monkeypatch, pairs):
    monkeypatch.setattr(s, "PAIRS_A_WORD", pairs)
    # with a bound of none every chunk is cut down to single letters; not those of the longest words, for time
    rows = odd_rows() + [r for r in texts() if pairs or len(r[1]) < 100_000]
    words = plain_words(rows, 5)
    want = plain_groups(words)
    got = spelling_variants(table(spark, rows), every=5)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    found = sorted((tuple(r) for r in got.collect()), key=str)
    assert found == want
    assert sum(w[4] for w in want) > 300 and len({w[2] for w in want}) < len(want)


def test_chain_leads_to_the_last_form(spark):
    words = spark.createDataFrame([("chainedword" + "z" * i, 4 * 10 ** (7 - i)) for i in range(8)], "word string, n long")
    got = {r["word"]: r for r in group_variants(words).collect()}
    assert {r["root"] for r in got.values()} == {"chainedword"} and got["chainedword"]["form"] is None
    assert got["chainedwordzzz"]["form"] == "chainedwordzz"


def test_a_hot_chunk_gives_no_square_of_pairs(spark, monkeypatch):
    """3,000 words share the first half: nothing like 3,000 x 3,000 pairs is compared."""
    pick = random.Random(4)
    words = sorted({"sharedhalf" + "".join(pick.choice("abcdefghij") for _ in range(10)) for _ in range(3000)})
    words += [words[0] + "k", words[1][:-1] + "k"]
    frame = spark.createDataFrame([(w, 2) for w in words], "word string, n long")
    compared = []
    real = s.F.levenshtein
    monkeypatch.setattr(s.F, "levenshtein", lambda a, b, k: compared.append(1) or real(a, b, k))
    got = {(r["a"], r["b"]) for r in near_pairs(frame).collect()}
    assert got == {(a, b) for i, a in enumerate(words[-2:]) for b in ()} | {(words[0], words[-2]), tuple(sorted((words[1], words[-1])))}
    assert len(compared) >= 2  # the shared half was cut again


def test_odd_tables(spark):
    assert spelling_variants(table(spark, [])).count() == 0
    assert spelling_variants(table(spark, [(1, None, "en", "a"), (2, "", "en", "a"), (3, "short words", "en", "a")])).count() == 0
    got = spelling_variants(table(spark, [(1, "repeated", "en", "a")] * 3)).collect()
    assert [tuple(r) for r in got] == [("repeated", None, "repeated", 3, 0, None)]
