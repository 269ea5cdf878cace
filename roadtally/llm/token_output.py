"""Token-ID output: documents as ids, in files of canonical length-limited Huffman codes."""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadtally.llm.common import keyed, staged
from roadtally.session import scratch_dir

#: Longest code in bits, unless so many ids are in use that they need more; the decoding table has 2**bits entries.
LIMIT = 18
#: Ids of a block, whose bit offset is kept, and ids of a row of the file.
BLOCK, SEGMENT = 512, 1 << 20
#: Ids of a file of the output.
SHARD = 16 << 20
#: Bytes that a worker may spend on words whose ids it remembers, and what a word takes besides its bytes and ids.
REMEMBERED, ENTRY = 16 << 20, 24
#: Longest word that is remembered, and characters of text that are encoded at once.
LONG, PIECE = 48, 4 << 20
#: Characters of which two that a text does not hold mark its cuts and borders; a text that holds nearly all is encoded whole.
MARKS = "\0\1\2\3\4\5\6\7\x08"
_SPLIT, _CUT = re.compile(r" (?=\s|\Z)"), re.compile(r" (?=\S)")
#: Behind a letter and before what is none.
_BORDER = re.compile(r"(?<=[A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF])(?=[\t-@\[-`{-~])")


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Places of all elements of ranges of an array, one range after the other."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(int(ends[-1]) if len(ends) else 0)


class Encoder:
    """Ids of texts by a tokenizer of the tokenizers library whose pre-tokenizer is the byte-level one.

    That pre-tokenizer always starts a piece at a space before a visible
    character, so a text may be cut there, and ends one between a letter and
    an ASCII character that is none, so the different cuts of a text are
    divided there into words (unless an added token is among them). Ids of
    words are remembered, since most come again. Everything else of the
    tokenizer is the library's: new words go to it, joined to long texts, and
    their ids are told apart by the bytes they stand for. What is remembered
    stays within REMEMBERED bytes: above that, long words go and the half of
    the others that came most often stays, also for a worker's next tasks.
    """

    _made: dict[str, "Encoder"] = {}

    def __init__(self, tokenizer_json: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.id_bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, id_ in vocabulary.items():
            self.id_bytes[id_] = len(token)
        before = self.tokenizer.pre_tokenizer
        self.borders = isinstance(before, ByteLevel) and before.use_regex
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.forget()

    @classmethod
    def of(cls, tokenizer_json: str) -> "Encoder":
        """The worker's encoder of this tokenizer; of another one, nothing is kept."""
        if tokenizer_json not in cls._made:
            cls._made = {tokenizer_json: cls(tokenizer_json)}
        return cls._made[tokenizer_json]

    def forget(self) -> None:
        self.words = pa.array([], pa.large_string())
        self.ids, self.ends, self.times = np.empty(1 << 16, np.uint32), np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
        self.used = 0

    @property
    def place(self) -> dict[str, int]:
        """Each remembered word's place."""
        return {w: i for i, w in enumerate(self.words.to_pylist())}

    def held(self) -> int:
        """Bytes of what is remembered, about."""
        return ENTRY * len(self.words) + (pc.sum(pc.binary_length(self.words)).as_py() or 0) + 4 * self.used

    def trim(self, bound: int) -> None:
        """Keep the most frequent short words, within `bound` bytes."""
        n = len(self.words)
        sizes = np.diff(self.ends[: n + 1])
        bytes_ = ENTRY + pc.binary_length(self.words).to_numpy() + 4 * sizes
        order = np.argsort(-self.times[:n], kind="stable")
        order = order[bytes_[order] <= ENTRY + 5 * LONG]
        order = np.sort(order[np.cumsum(bytes_[order]) <= bound])
        words, ids, sizes, times = self.words.take(pa.array(order)), self.ids[_ranges(self.ends[order], sizes[order])], sizes[order], self.times[order]
        self.forget()
        self._add(words, ids, sizes)
        self.times[: len(order)] = times // 2

    def _add(self, words: pa.Array, ids: np.ndarray, lengths: np.ndarray) -> None:
        n = len(self.words)
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.empty_like(self.ids)])
        while n + len(words) + 1 > len(self.ends):
            self.ends, self.times = np.concatenate([self.ends, np.zeros_like(self.ends)]), np.concatenate([self.times, np.zeros_like(self.times)])
        self.ids[self.used : self.used + len(ids)] = ids
        self.ends[n + 1 : n + 1 + len(words)] = self.used + np.cumsum(lengths)
        self.used += len(ids)
        self.words = pa.concat_arrays([self.words, words])

    def learn(self, words: pa.Array) -> np.ndarray:
        """Remember words that are not remembered yet; their places."""
        joint = pc.match_substring_regex(words, r"^ [^\pZ\pC]").to_numpy(zero_copy_only=False)
        order = np.argsort(~joint, kind="stable")
        words, n = words.take(pa.array(order)), int(joint.sum())
        want, found = np.cumsum(pc.binary_length(words).to_numpy()), []
        starts = np.append(np.arange(0, n, 1000), n)
        parts = pa.LargeListArray.from_arrays(pa.array(starts), words[:n])
        for lo, hi, text in zip(starts, starts[1:], pc.binary_join(parts, pa.scalar("", pa.large_string())).to_pylist()):
            ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
            ends, at = np.cumsum(self.id_bytes[ids]) + (want[lo - 1] if lo else 0), want[lo:hi]
            cut = np.searchsorted(ends, at)
            if not len(ends) or ends[-1] != at[-1] or (ends[cut] != at).any():
                found.append(self.apart(words[lo:hi]))
            else:
                found.append((ids, np.diff(cut + 1, prepend=0)))
        found.append(self.apart(words[n:]))
        places = np.empty(len(words), np.int64)
        places[order] = len(self.words) + np.arange(len(words))
        self._add(words, *map(np.concatenate, zip(*found)))
        return places

    def apart(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words that are encoded each for itself, and the number of each."""
        found = [e.ids for at in range(0, len(words), 4000) for e in self.tokenizer.encode_batch_fast(words[at : at + 4000].to_pylist(), add_special_tokens=False)]
        return np.array([i for ids in found for i in ids], np.uint32), np.array([len(ids) for ids in found], np.int64)

    @staticmethod
    def pieces(text: str) -> Iterator[str]:
        """The text in pieces of about PIECE characters, cut at spaces before visible characters."""
        at = 0
        while len(text) - at > PIECE:
            end = text.find(" ", at + PIECE)
            while end >= 0 and (end + 1 == len(text) or text[end + 1].isspace()):
                end = text.find(" ", end + 1)
            if end < 0:
                break
            yield text[at:end]
            at = end
        yield text[at:]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and the number of each text; PIECE characters are in work at once."""
        found, counts = [np.empty(0, np.uint32)], np.zeros(len(texts), np.int64)
        held: list[tuple[int, str]] = []
        size = 0

        def settle() -> None:
            ids, n = self._encode([p for _, p in held])
            found.append(ids)
            np.add.at(counts, [i for i, _ in held], n)
            held.clear()

        for i, text in enumerate(texts):
            for piece in self.pieces(text):
                held.append((i, piece))
                size += len(piece)
                if size > PIECE:
                    settle()
                    size = 0
        settle()
        return np.concatenate(found), counts

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if not texts:
            return np.empty(0, np.uint32), np.empty(0, np.int64)
        marks = [m for m in MARKS if not any(m in t for t in texts)]
        if len(marks) < 2:
            whole = [np.array(self.tokenizer.encode_batch_fast([t], add_special_tokens=False)[0].ids, np.uint32) for t in texts]
            return np.concatenate(whole), np.array([len(x) for x in whole], np.int64)
        cut, border = marks[:2]
        marked = [_CUT.sub(cut + " ", t) if _SPLIT.search(t) else t.replace(" ", cut + " ") for t in texts]
        cuts = pc.split_pattern(pa.array(marked, pa.large_string()), cut)
        coded = cuts.flatten().dictionary_encode()
        each = coded.indices.to_numpy()
        text = pc.binary_join(pa.ListArray.from_arrays([0, len(coded.dictionary)], coded.dictionary), pa.scalar(cut, pa.large_string()))[0].as_py()
        if self.borders and not any(t in text for t in self.added):
            text = _BORDER.sub(border, text)
        parts = pc.split_pattern(pc.split_pattern(pa.array([text], pa.large_string()), cut).flatten(), border)
        n_parts = parts.value_lengths().to_numpy().astype(np.int64)
        coded = parts.flatten().dictionary_encode()
        words, word = coded.dictionary, coded.indices.to_numpy()
        at = pc.fill_null(pc.index_in(words, self.words), -1).to_numpy().astype(np.int64)
        new = np.flatnonzero(at < 0)
        if len(new):
            at[new] = self.learn(words.take(pa.array(new)))
        times = np.repeat(np.bincount(each, minlength=len(n_parts)), n_parts)
        self.times[at] += np.bincount(word, times, len(words)).astype(np.int64)
        # ids of the different cuts, then of all
        at = at[word]
        starts, lengths = self.ends[at], self.ends[at + 1] - self.ends[at]
        ids = self.ids[_ranges(starts, lengths)]
        lengths = np.add.reduceat(lengths, np.cumsum(n_parts) - n_parts)
        starts = np.cumsum(lengths) - lengths
        lengths = lengths[each]
        ids = ids[_ranges(starts[each], lengths)]
        sums = np.concatenate(([0], np.cumsum(lengths)))
        if self.held() > REMEMBERED:
            self.trim(REMEMBERED // 2)
        return ids, np.diff(sums[np.cumsum(cuts.value_lengths().to_numpy(), dtype=np.int64)], prepend=0)


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Bits of each id's code (0 for ids that never occur): optimal under the limit, by package-merge."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    limit = max(limit, len(used).bit_length())
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.float64)
    # each row: what a package is made of, a leaf (its rank) or the next pair of the row below
    rows, values = [], leaves
    for _ in range(limit - 1):
        pairs = values[: len(values) // 2 * 2].reshape(-1, 2).sum(axis=1)
        merged = np.concatenate([leaves, pairs])
        by = np.argsort(merged, kind="stable")
        rows.append(by < len(leaves))
        values = merged[by]
    take = 2 * len(leaves) - 2
    ranks = np.zeros(len(leaves), np.int64)
    for is_leaf in reversed(rows):
        n = int(is_leaf[:take].sum())
        ranks[:n] += 1
        take = 2 * (take - n)
    ranks[:take] += 1
    lengths[order] = ranks
    return lengths


@dataclass
class Code:
    """A canonical code from its lengths alone; codes are stored with their first bit lowest. A code has at most 25 bits."""

    lengths: np.ndarray

    def __post_init__(self) -> None:
        used = np.flatnonzero(self.lengths)
        self.bits = limit = max(1, int(self.lengths.max(initial=0)))
        order = used[np.lexsort((used, self.lengths[used]))]
        bits = self.lengths[order].astype(np.int64)
        first = np.concatenate(([0], np.cumsum(1 << (limit - bits))[:-1])) if len(order) else bits
        words = (first >> (limit - bits)).astype(np.uint64)
        flipped = np.zeros(len(order), np.uint64)
        for i in range(limit):
            up = i < bits
            flipped[up] |= ((words[up] >> (bits[up] - 1 - i).astype(np.uint64)) & np.uint64(1)) << np.uint64(i)
        self.words = np.zeros(len(self.lengths), np.uint64)
        self.words[order] = flipped
        self.table = np.zeros(1 << limit, np.uint32)
        for n in np.unique(bits):
            some = bits == n
            at = flipped[some].astype(np.int64)[:, None] + (np.arange(1 << (limit - int(n)), dtype=np.int64) << int(n))[None]
            self.table[at] = (order[some].astype(np.uint32) << np.uint32(5) | np.uint32(n))[:, None]

    def encode(self, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bytes of all documents, each beginning at a byte; bytes of each document; bit offset of each block in its document."""
        bits = self.lengths[ids].astype(np.int64)
        ends = np.cumsum(counts)
        sums = np.concatenate(([0], np.cumsum(bits)))
        per_doc = np.diff(sums[ends], prepend=0)
        size = (per_doc + 7) // 8
        start = (np.cumsum(size) - size) * 8
        at = sums[:-1] + np.repeat(start - (sums[ends] - per_doc), counts)
        out = np.zeros(int(size.sum()) // 8 + 2, np.uint64)
        if len(ids):
            word, shift = at >> 6, (at & 63).astype(np.uint64)
            codes = self.words[ids]
            new = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            out[word[new]] = np.bitwise_or.reduceat(codes << shift, new)
            over = np.flatnonzero((at & 63) + bits > 64)
            out[word[over] + 1] |= codes[over] >> (np.uint64(64) - shift[over])
        blocks = -(-counts // BLOCK)
        first = np.repeat(ends - counts, blocks) + BLOCK * (np.arange(blocks.sum()) - np.repeat(np.cumsum(blocks) - blocks, blocks))
        offsets = at[first] - np.repeat(start, blocks) if len(first) else np.empty(0, np.int64)
        return out.view(np.uint8)[: int(size.sum())], size, offsets

    def decode(self, raw: np.ndarray, offsets: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Ids of blocks that begin at bit `offsets` and hold `lengths` ids, all blocks a step."""
        padded = np.concatenate([raw, np.zeros(8, np.uint8)]).astype(np.uint32)
        window = padded[:-3] | padded[1:-2] << np.uint32(8) | padded[2:-1] << np.uint32(16) | padded[3:] << np.uint32(24)
        order = np.argsort(-lengths, kind="stable")
        at, size = offsets[order].copy(), lengths[order]
        begin = (np.cumsum(lengths) - lengths)[order]
        out = np.empty(int(lengths.sum()), np.uint32)
        mask = np.uint32((1 << self.bits) - 1)
        for step in range(int(size[0]) if len(size) else 0):
            live = int(np.searchsorted(-size, -step, side="left"))
            p = at[:live]
            entry = self.table[(window[p >> 3] >> (p & 7).astype(np.uint32)) & mask]
            out[begin[:live] + step] = entry >> np.uint32(5)
            p += entry & np.uint32(31)
        return out


SEGMENT_SCHEMA = "part int, seq long, before long, docs binary, nulls binary, counts binary, sizes binary, offsets binary, payload binary"


def _lists(batch: pa.RecordBatch, *names: str) -> Iterator[tuple]:
    return zip(*(batch.column(n).to_pylist() for n in names))


def write_ids(docs: DataFrame, tokenizer_json: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> str:
    """Encode all texts, append `end_id` to each, write them in ascending id order; the folder written.

    One pass encodes, keeps the ids and counts them in one more row of each
    task; the code comes from the global counts (one number per id of the
    vocabulary reaches the driver). A second pass writes the code: documents
    go to files of about SHARD ids by ranges of their id, those of one id by
    ranges of their text's digest where one id alone fills files. A file's rows are segments of whole
    documents in order: the number of ids of the file before it, the documents'
    ids, counts and bytes, the coded bits, and the bit offset of each block of BLOCK ids, from which it can be decoded alone.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(tokenizer_json)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, total = Encoder.of(shared.value), np.zeros(1, np.int64)
        for batch in batches:
            for part in (batch.slice(i, 1000) for i in range(0, len(batch), 1000)):
                ids, counts = encoder.encode([t or "" for t in part.column("text").to_pylist()])
                ends = np.cumsum(counts)
                ids = np.insert(ids, ends, end_id).astype(np.uint32)
                counts, ends = counts + 1, ends + np.arange(1, len(counts) + 1)
                found = np.bincount(ids)
                if len(found) > len(total):
                    total = np.concatenate([total, np.zeros(len(found) - len(total), np.int64)])
                total[: len(found)] += found
                yield pa.RecordBatch.from_arrays(
                    [part.column("own_id"), part.column("id"), part.column("rx"), pa.array(counts, pa.int64()),
                     pa.array([_packed(x) for x in np.split(ids, ends[:-1])], pa.binary()), pa.nulls(len(part), seen)], names)
        at = np.flatnonzero(total)
        pairs = pa.StructArray.from_arrays([pa.array(at, pa.int64()), pa.array(total[at])], ["token", "n"])
        yield pa.RecordBatch.from_arrays(
            [pa.array([x], pa.int64()) for x in (None, 0, 0, 0)] + [pa.array([None], pa.binary()), pa.ListArray.from_arrays([0, len(at)], pairs)], names)

    names, seen = ["own_id", "id", "rx", "n", "ids", "seen"], pa.list_(pa.struct([("token", pa.int64()), ("n", pa.int64())]))
    rows = keyed(docs, id_col, text_col).select(F.col("own_id").cast("long"), "id", "rx", "text")
    rows = rows.mapInArrow(encode, "own_id long, id long, rx long, n long, ids binary, seen array<struct<token: long, n: long>>")
    rows = staged(spark, rows, "token-ids", compression="zstd")
    counted = rows.where("n = 0").select(F.inline("seen")).groupBy("token").agg(F.sum("n").alias("n")).collect()
    # a document has its end id at least
    rows = rows.where("n > 0").drop("seen")
    counts = np.zeros(max([r["token"] for r in counted], default=0) + 1, np.int64)
    for r in counted:
        counts[r["token"]] = r["n"]
    code = Code(code_lengths(counts))
    lengths = spark.sparkContext.broadcast(code.lengths)
    parts = max(1, int(-(-counts.sum() // SHARD)))
    cuts = rows.agg(F.percentile_approx("id", [i / parts for i in range(1, parts)], 100 * parts)).first()[0] if parts > 1 else []
    cuts = np.sort(np.array(cuts or [], np.int64))

    def part_of(id_: np.ndarray, rx: np.ndarray) -> np.ndarray:
        first, last = np.searchsorted(cuts, id_, side="left"), np.searchsorted(cuts, id_, side="right")
        share = np.minimum((rx.astype(np.float64) + 2.0**63) / 2.0**64, 1 - 2.0**-53)
        return (first + (share * (last - first)).astype(np.int64)).astype(np.int32)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Code(lengths.value)
        for batch in batches:
            for part in (batch.slice(i, 200) for i in range(0, len(batch), 200)):
                docs_ids = [_unpacked(b) for b in part.column("ids").to_pylist()]
                n = np.fromiter(map(len, docs_ids), np.int64, len(docs_ids))
                raw, size, offsets = own.encode(np.concatenate(docs_ids), n)
                blocks = np.cumsum(-(-n // BLOCK))[:-1]
                yield pa.RecordBatch.from_arrays(
                    [part.column("own_id"), part.column("id"), part.column("rx"), part.column("n"),
                     pa.array(part_of(part.column("id").to_numpy(), part.column("rx").to_numpy())),
                     pa.array([x.tobytes() for x in np.split(raw, np.cumsum(size)[:-1])], pa.binary()),
                     pa.array([x.astype(np.int64).tobytes() for x in np.split(offsets, blocks)], pa.binary())],
                    ["own_id", "id", "rx", "n", "part", "payload", "offsets"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        total, seq, before, at = 0, 0, 0, None

        def segment() -> pa.RecordBatch:
            own, n, payload, offsets = zip(*held)
            sizes = np.array([len(p) for p in payload], np.int64)
            base = (np.cumsum(sizes) - sizes) * 8
            marks = [np.frombuffer(o, np.int64) + b for o, b in zip(offsets, base)]
            row = [np.array([o or 0 for o in own], np.int64), np.array([o is None for o in own], np.uint8), np.array(n, np.int64), sizes, np.concatenate(marks)]
            return pa.RecordBatch.from_arrays(
                [pa.array([at], pa.int32()), pa.array([seq], pa.int64()), pa.array([before], pa.int64()), *(pa.array([x.tobytes()], pa.binary()) for x in row), pa.array([b"".join(payload)], pa.binary())],
                [f.split()[0] for f in SEGMENT_SCHEMA.split(", ")])

        for batch in batches:
            for part, *row in _lists(batch, "part", "own_id", "n", "payload", "offsets"):
                if held and (part != at or total + row[1] > SEGMENT):
                    yield segment()
                    held, total, seq, before = [], 0, seq + 1 if part == at else 0, before + total if part == at else 0
                at, total = part, total + row[1]
                held.append(tuple(row))
        if held:
            yield segment()

    path = scratch_dir(spark, "token-files")
    coded = rows.mapInArrow(write, "own_id long, id long, rx long, n long, part int, payload binary, offsets binary")
    coded = coded.repartitionById(parts, "part").sortWithinPartitions("part", "id", "rx")
    # the payload is coded already
    coded.mapInArrow(pack, SEGMENT_SCHEMA).write.option("compression", "uncompressed").parquet(f"{path}/segments")
    spark.createDataFrame([(code.bits, code.lengths.tobytes())], "bits int, lengths binary").write.parquet(f"{path}/code")
    return path


def _packed(ids: np.ndarray) -> bytes:
    """Ids as 2 bytes each where all fit, else 4; the first byte says which."""
    return b"\2" + ids.astype("<u2").tobytes() if not len(ids) or ids.max() < 1 << 16 else b"\4" + ids.astype("<u4").tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, "<u2" if raw[0] == 2 else "<u4", offset=1).astype(np.uint32)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32, ids of each document of a written folder, from the files alone."""
    raw = spark.read.parquet(f"{path}/code").first()["lengths"]
    lengths = spark.sparkContext.broadcast(np.frombuffer(raw, np.uint8))
    segments = spark.read.parquet(f"{path}/segments")

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            totals = [int(np.frombuffer(c, np.int64).sum()) for c in batch.column("counts").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("part"), pa.array(totals, pa.int64())], ["part", "n"])

    # one number for each file of SHARD ids
    found = segments.select("part", "counts").mapInArrow(sizes, "part int, n long").groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect()
    parts, totals = np.array([r["part"] for r in found], np.int64), np.array([r["n"] for r in found], np.int64)
    starts = spark.sparkContext.broadcast((parts, np.cumsum(totals) - totals))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Code(lengths.value)
        parts, begin = starts.value
        for batch in batches:
            for part, before, docs, nulls, counts, offsets, payload in _lists(batch, "part", "before", "docs", "nulls", "counts", "offsets", "payload"):
                n, marks = np.frombuffer(counts, np.int64), np.frombuffer(offsets, np.int64)
                blocks = -(-n // BLOCK)
                size = np.full(int(blocks.sum()), BLOCK, np.int64)
                size[np.cumsum(blocks) - 1] = n - (blocks - 1) * BLOCK
                ids = code.decode(np.frombuffer(payload, np.uint8), marks, size)
                ends = np.cumsum(n)
                apart = [x.astype("<u4").tobytes() for x in np.split(ids, ends[:-1])]
                for lo in range(0, len(n), 2000):
                    some = slice(lo, lo + 2000)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.frombuffer(docs, np.int64)[some], pa.int64(), mask=np.frombuffer(nulls, np.uint8)[some].astype(bool)),
                        pa.array((ends - n + before + begin[np.searchsorted(parts, part)])[some]), pa.array(n[some]),
                        pa.array([zlib.crc32(x) for x in apart[some]], pa.int64()), pa.array(apart[some], pa.binary()),
                    ], ["doc_id", "start", "n_tokens", "ids_crc32", "ids"])

    return segments.mapInArrow(decode, "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary")


def token_output(docs: DataFrame, tokenizer_json: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write all documents as ids and read them back: doc_id, start, n_tokens, ids_crc32, ids (little-endian, 4 bytes each).

    Null or empty text: the end id alone. Documents are in ascending id order,
    a null id first, rows of one id by the digest of their text; repeated rows
    come back repeated. Empty table: files without segments, no rows.
    """
    return read_ids(docs.sparkSession, write_ids(docs, tokenizer_json, end_id, id_col, text_col))
