"""Round trips of the token files."""

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from roadtally.llm import token_output as t
from roadtally.llm.token_output import Code, Encoder, code_lengths, token_output

from tests.llm.fixtures import odd_rows, table

PATH = public_tokenizers.path("byte_bpe_50k.json")
JSON = open(PATH, encoding="utf-8").read()


def expected(rows):
    tok = Tokenizer.from_file(PATH)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    out, at = [], 0
    for d, text, *_ in order:
        ids = [*tok.encode(text or "", add_special_tokens=False).ids, 0]
        out.append((d, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out, at


@pytest.mark.parametrize("shard, segment", [(16 << 20, 1 << 20), (3000, 500)])
def test_round_trip(spark, monkeypatch, shard, segment):
    monkeypatch.setattr(t, "SHARD", shard)
    monkeypatch.setattr(t, "SEGMENT", segment)
    rows = odd_rows()
    want, total = expected(rows)
    got = sorted(token_output(table(spark), JSON).drop("ids").collect(), key=lambda r: r["start"])
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == Counter(want)
    assert [r["doc_id"] for r in got] == [w[0] for w in want]
    assert [r["start"] for r in got] == np.cumsum([0, *(r["n_tokens"] for r in got)])[:-1].tolist()
    assert got[-1]["start"] + got[-1]["n_tokens"] == total


def test_empty_table(spark):
    assert token_output(table(spark, []), JSON).count() == 0


def test_cuts_change_no_id():
    tok, own = Tokenizer.from_file(PATH), Encoder(JSON)
    texts = ["", " ", "  ", "a", " a", "a ", "a  b", "a \n b\n\n c", "\n x", "don't 'tis we 're", "x <|endoftext|> y<|endoftext|>", "tab\t b", "   a  b",
             "a\0b \0 c", "日本 語 😀 é", " \r\n  q", "a\x1c b \x1fc", "a\x85 b", "12 34,5 . . ..", "a b c" * 500]
    ids, counts = own.encode(texts)
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [tok.encode(x, add_special_tokens=False).ids for x in texts]
    again, _ = own.encode(texts)
    assert (ids == again).all()


def test_borders_change_no_id(monkeypatch):
    tok, own = Tokenizer.from_file(PATH), Encoder(JSON)
    rng = np.random.default_rng(5)
    alphabet = [*"abzAZ", "é", "ß", "×", "ł", "я", "日", "e\u0301", "µ", "²", *"019", *"'.,-_<|>%", "'s", "'ll", "\n", "\t", "\r\n", " ", " ", "  ", "\xa0", "\x85", "\x1c", "\0", "\7", "\x7f", "😀"]
    texts = ["".join(rng.choice(alphabet, n)) for n in rng.integers(0, 60, 3000)]
    texts += ["x<|endoftext|>y, z.", t.MARKS, t.MARKS[1:] + " a, b", "a." + t.MARKS[2:] + "b c.", "don't, I'll. we're; 'sun's", "end. ", " . "]
    want = [tok.encode(x, add_special_tokens=False).ids for x in texts]
    for piece in (t.PIECE, 500):
        monkeypatch.setattr(t, "PIECE", piece)
        ids, counts = own.encode(texts)
        assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == want
        own.forget()


def test_a_word_goes_to_the_tokenizer_once():
    class Counting:
        sent = 0

        def encode_batch_fast(self, texts, **options):
            self.sent += sum(map(len, texts))
            return tokenizer.encode_batch_fast(texts, **options)

    own = Encoder(JSON)
    tokenizer, own.tokenizer = own.tokenizer, Counting()
    words = [f" {a}{b}{c}ward" for a in "abcdefgh" for b in "aeiou" for c in "klmnprst"]
    for end in ("", ",", ".", ";", ":", "!", "?", ".\n-"):
        own.encode(["".join(w + end for w in words)])
    assert own.tokenizer.sent < 2 * sum(map(len, words))


def test_memory_is_bounded(monkeypatch):
    monkeypatch.setattr(t, "REMEMBERED", 1 << 20)
    monkeypatch.setattr(t, "PIECE", 5000)
    tok, own = Tokenizer.from_file(PATH), Encoder(JSON)
    texts = [" ".join(f"w{i}x{j * j} common word" for j in range(700)) for i in range(40)] + ["x" * 30_000, " " * 20_000 + "end", "q" * 200 + " tail"]
    for text in texts:
        ids, counts = own.encode([text, "common word"])
        assert ids[: counts[0]].tolist() == tok.encode(text, add_special_tokens=False).ids
        assert own.held() <= t.REMEMBERED
    assert " common" in own.place and len(own.ids) * 4 + len(own.ends) * 16 < 1 << 21


def test_rows_of_one_id_fill_several_files(spark, monkeypatch):
    monkeypatch.setattr(t, "SHARD", 2000)
    rows = [(None if i % 3 else i, f"text number {i} of many", "en", "a") for i in range(3000)]
    path = t.write_ids(table(spark, rows), JSON)
    sizes = [r["n"] for r in spark.read.parquet(f"{path}/segments").groupBy("part").agg({"counts": "count"}).withColumnRenamed("count(counts)", "n").collect()]
    assert len(sizes) > 6
    got = t.read_ids(spark, path).orderBy("start").collect()
    assert [r["doc_id"] for r in got] == [None] * 2000 + list(range(0, 3000, 3))
    assert [r["start"] for r in got] == np.cumsum([0, *(r["n_tokens"] for r in got)])[:-1].tolist()


def test_more_ids_than_the_shortest_limit_holds():
    counts = np.ones((1 << t.LIMIT) + 5, np.int64)
    lengths = code_lengths(counts)
    assert lengths.min() > 0 and lengths.max() == t.LIMIT + 1
    code, ids = Code(lengths), np.array([0, 5, len(counts) - 1], np.uint32)
    raw, _, offsets = code.encode(ids, np.array([3]))
    assert (code.decode(raw, offsets, np.array([3])) == ids).all()


def test_code_is_a_prefix_code_within_the_limit():
    rng = np.random.default_rng(0)
    for counts in (np.array([0, 5]), np.array([1, 1, 1]), 2 ** np.arange(40), rng.integers(0, 1000, 5000), np.zeros(3, int)):
        lengths = code_lengths(counts)
        used = counts > 0
        assert (lengths[used] >= 1).all() and (lengths <= t.LIMIT).all() and (lengths[~used] == 0).all()
        if used.sum() > 1:
            assert np.isclose((0.5 ** lengths[used].astype(float)).sum(), 1)
        code = Code(lengths)
        ids = rng.choice(np.flatnonzero(used), 3000) if used.any() else np.empty(0, int)
        n = np.array([0, 1, len(ids) - 1]) if len(ids) else np.array([0])
        raw, size, offsets = code.encode(ids.astype(np.uint32), n)
        blocks = -(-n // t.BLOCK)
        lens = np.concatenate([[*[t.BLOCK] * (b - 1), k - (b - 1) * t.BLOCK] if b else [] for b, k in zip(blocks, n)]).astype(np.int64)
        base = np.repeat((np.cumsum(size) - size) * 8, blocks)
        assert (code.decode(raw, offsets + base, lens) == ids).all()


def test_lengths_are_optimal_without_the_limit():
    counts = np.array([45, 13, 12, 16, 9, 5])
    assert (code_lengths(counts) * counts).sum() == 224
