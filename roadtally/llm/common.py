"""What the operators of this folder share: written intermediates, row keys, digests of unit sequences."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadtally.session import scratch_dir

SPACES = b" \t\n\r\x0b\x0c"
#: Java and RE2 form of a word of everything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
U64 = np.uint64
#: Fixed odd multiplier of the polynomial digests, and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
BASE_INV = pow(BASE, -1, 1 << 64)
BYTE_CODES = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) | U64(1)

_powers: dict[str, np.ndarray] = {}


def staged(spark: SparkSession, df: DataFrame, purpose: str, **options: str) -> DataFrame:
    """`df` written below the shared checkpoint folder and read again: it survives lost executors and is computed once."""
    path = scratch_dir(spark, purpose)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns `id`, `rx`, `text`: a row is told from others by its id and the digest of its text; a null id is the smallest long."""
    return docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("id"), F.xxhash64(text_col).alias("rx"),
        F.col(text_col).alias("text"), F.col(id_col).alias("own_id"),
    )


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _power(base: int, name: str, n: int) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        steps = np.full(max(n, 1 << 14) + 1, base, dtype=np.uint64)
        steps[0] = 1
        have = _powers[name] = np.cumprod(steps, dtype=np.uint64)
    return have[:n]


class Digests:
    """Digests of any stretch [start, end) of a sequence of 64-bit codes, each in constant time."""

    def __init__(self, codes: np.ndarray):
        self.sums = np.zeros(len(codes) + 1, dtype=np.uint64)
        np.cumsum(codes * _power(BASE, "up", len(codes)), dtype=np.uint64, out=self.sums[1:])
        self.down = _power(BASE_INV, "down", len(codes) + 1)

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.down[starts] + (ends - starts).astype(np.uint64) * U64(BASE))


def word_bounds(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of a text's bytes."""
    blank = np.ones(len(raw) + 2, dtype=bool)
    blank[1:-1] = (raw == 32) | ((raw >= 9) & (raw <= 13))
    return np.flatnonzero(blank[:-2] & ~blank[1:-1]), np.flatnonzero(~blank[1:-1] & blank[2:]) + 1


def word_codes(raw: np.ndarray) -> np.ndarray:
    """A 64-bit code of each word of a text's bytes."""
    starts, ends = word_bounds(raw)
    return Digests(BYTE_CODES[raw]).of(starts, ends)


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each run of `w` neighbours, by forward and backward minima of blocks of `w`."""
    n = len(x) - w + 1
    padded = np.full(-(-len(x) // w) * w, np.iinfo(x.dtype).max, dtype=x.dtype)
    padded[: len(x)] = x
    blocks = padded.reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[w - 1 : w - 1 + n])
