"""Random keys of usual lengths among many ordinary long tokens."""

import random
import string

import pytest

from roadtally.llm.secret_scan import scan

from tests.llm.fixtures import table

SYLLABLES = ("con ter ation pre ment ing er able stra tor mi ne pro ver lo ca de ri sub re po si le gra fer ous al ti ve un der land ma ga "
             "ra do fi cu lar sen qui te ber ge wer zu hau kel").split()
BASE62 = string.ascii_letters + string.digits


def name(pick, size, sign=""):
    """Camel case with a number, or words between signs."""
    out = ""
    while len(out) < size:
        word = "".join(pick.choice(SYLLABLES) for _ in range(pick.randrange(1, 4)))
        out += f"{word}{sign}" if sign else word.capitalize()
    return out[: size - 2] + str(pick.randrange(10, 100))


def made(sizes, share, n=2000, sign="", alphabet=BASE62, seed=3):
    """(text, size, is key) of n tokens of each size."""
    pick = random.Random(seed)
    out = []
    for size in sizes:
        for i in range(n):
            key = i < n * share
            token = "".join(pick.choice(alphabet) for _ in range(size)) if key else name(pick, size, sign)
            out.append((f"see {token} here", size, key))
    return out


def measured(spark, tokens):
    """Share of the keys found by size, and how many ordinary tokens were."""
    found = {r["doc_id"] for r in scan(table(spark, [(i, t, "en", "a") for i, (t, *_) in enumerate(tokens)])).where("n_random > 0").collect()}
    sizes = sorted({s for _, s, _ in tokens})
    keys = {s: [i for i, (_, size, key) in enumerate(tokens) if key and size == s] for s in sizes}
    return {s: sum(i in found for i in keys[s]) / len(keys[s]) for s in sizes}, sum(not tokens[i][2] for i in found)


@pytest.mark.parametrize(("sign", "alphabet"), [("", BASE62), ("/", BASE62 + "+/")])
def test_few_keys_among_many_names(spark, sign, alphabet):
    shares, wrong = measured(spark, made((20, 32, 40), 0.01, sign=sign, alphabet=alphabet))
    assert min(shares.values()) >= 0.9 and wrong <= 2


def test_keys_alone(spark):
    shares, _ = measured(spark, made((20, 32, 40), 1.0, n=1000))
    assert min(shares.values()) >= 0.95
