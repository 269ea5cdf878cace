"""Language ID with a byte convolutional network."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UNKNOWN = "und"


@dataclass(frozen=True)
class Settings:
    """The network, and the bound on what it is fitted on: the `classes` most frequent languages, `rows` documents each, `windows` windows a document."""

    window: int = 256
    embed: int = 8
    filters: int = 16
    widths: tuple[int, ...] = (2, 3, 4)
    classes: int = 200
    rows: int = 600
    windows: int = 4
    epochs: int = 10
    batch: int = 64
    rate: float = 4e-3
    seed: int = 5


def cut(raw: bytes, size: int) -> np.ndarray:
    """A text's bytes in windows of `size`, one after the other, the last filled with zeros."""
    n = max(1, -(-len(raw) // size))
    out = np.zeros(n * size, np.uint8)
    out[: len(raw)] = np.frombuffer(raw, np.uint8)
    return out.reshape(n, size)


class ByteCnn:
    """Embedded bytes, filters of several widths, their maxima over the window, softmax."""

    def __init__(self, settings: Settings, classes: list[str]):
        self.s, self.classes = settings, classes
        rng = np.random.default_rng(settings.seed)
        wide, n = max(settings.widths), settings.filters * len(settings.widths)
        self.embed = rng.normal(0, 0.5, (256, settings.embed)).astype(np.float32)
        # narrower filters are wide ones whose last weights stay zero, so one product serves all
        self.mask = np.concatenate([np.repeat(np.arange(wide * settings.embed)[:, None] < w * settings.embed, settings.filters, axis=1) for w in settings.widths], axis=1)
        self.filter = (rng.normal(0, 0.2, (wide * settings.embed, n)) * self.mask).astype(np.float32)
        self.bias = np.zeros(n, np.float32)
        self.out = rng.normal(0, 0.1, (n, len(classes))).astype(np.float32)
        self.out_bias = np.zeros(len(classes), np.float32)

    def _columns(self, x: np.ndarray) -> np.ndarray:
        wide = max(self.s.widths)
        e = self.embed[np.pad(x, ((0, 0), (0, wide - 1)))]
        view = np.lib.stride_tricks.sliding_window_view(e, wide, axis=1)  # windows, places, embed, wide
        return np.ascontiguousarray(view.transpose(0, 1, 3, 2)).reshape(len(x), x.shape[1], -1)

    def features(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        columns = self._columns(x)
        scores = (columns.reshape(-1, columns.shape[2]) @ self.filter).reshape(len(x), x.shape[1], -1)
        return columns, scores, np.maximum(scores.max(axis=1) + self.bias, 0)

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        out = []
        for part in np.array_split(x, max(1, -(-len(x) // 32))):
            z = self.features(part)[2] @ self.out + self.out_bias
            z = np.exp(z - z.max(axis=1, keepdims=True))
            out.append(z / z.sum(axis=1, keepdims=True))
        return np.concatenate(out)

    def fit(self, x: np.ndarray, y: np.ndarray) -> "ByteCnn":
        """Adam on the cross entropy; the maxima pass the gradient to the place that won."""
        rng, s = np.random.default_rng(self.s.seed), self.s
        names = ("embed", "filter", "bias", "out", "out_bias")
        first = {n: np.zeros_like(getattr(self, n)) for n in names}
        second = {n: np.zeros_like(getattr(self, n)) for n in names}
        step, wide = 0, max(s.widths)
        for epoch in range(s.epochs):
            for some in np.array_split(rng.permutation(len(x)), max(1, len(x) // s.batch)):
                bx, by = x[some], y[some]
                columns, scores, feature = self.features(bx)
                z = feature @ self.out + self.out_bias
                p = np.exp(z - z.max(axis=1, keepdims=True))
                p /= p.sum(axis=1, keepdims=True)
                p[np.arange(len(by)), by] -= 1
                p /= len(by)
                d = (p @ self.out.T) * (feature > 0)
                won = scores.argmax(axis=1)
                rows = columns[np.arange(len(bx))[:, None], won]  # windows, filters, wide * embed
                back = (d[:, :, None] * self.filter.T[None]).reshape(len(bx), -1, wide, s.embed)
                places = np.pad(bx, ((0, 0), (0, wide - 1)))[np.arange(len(bx))[:, None, None], won[:, :, None] + np.arange(wide)]
                embed = np.zeros_like(self.embed)
                np.add.at(embed, places, back)
                grads = {"embed": embed, "filter": np.einsum("nf,nfk->kf", d, rows) * self.mask, "bias": d.sum(axis=0), "out": feature.T @ p, "out_bias": p.sum(axis=0)}
                step += 1
                rate = s.rate * (1 - epoch / s.epochs) + s.rate / 20
                for n in names:
                    g = grads[n]
                    first[n] = 0.9 * first[n] + 0.1 * g
                    second[n] = 0.999 * second[n] + 0.001 * g * g
                    move = first[n] / (1 - 0.9**step) / (np.sqrt(second[n] / (1 - 0.999**step)) + 1e-8)
                    setattr(self, n, (getattr(self, n) - rate * move).astype(np.float32))
        return self


def held_out(id_col: str) -> Column:
    """Whether crc32 of the id's text leaves 2 modulo 4; false for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> ByteCnn | None:
    """A network from at most `rows` documents of each of the `classes` most frequent languages that are not held out; None without any.

    A document's place is a hash of its id and text. Languages are counted
    first, so that only documents below a threshold that about twice `rows`
    pass are put in order; of these the first `rows` are taken, as rows and
    not by their id, so that ids that repeat change nothing. The windows lie
    evenly over the whole text.
    """
    lang, text = F.col(lang_col).cast("string"), F.col(text_col)
    known = docs.where(lang.isNotNull() & text.isNotNull() & (text != "") & F.col(id_col).isNotNull() & ~held_out(id_col))
    counted = known.groupBy(lang.alias("lang")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(settings.classes).collect()
    if not counted:
        return None
    share = F.create_map(*[F.lit(x) for r in counted for x in (r["lang"], min(1.0, 2 * settings.rows / r["n"] + 1e-4))])
    near = known.select(lang.alias("lang"), text.alias("text"), F.xxhash64(F.col(id_col).cast("string"), text).alias("place"))
    near = near.where((F.col("place") / 2.0**64 + 0.5) <= share[F.col("lang")])
    order = Window.partitionBy("lang").orderBy("place", "text")
    rows = near.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= settings.rows).select("lang", "text")

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, parts = [], []
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                all_ = cut(text.encode(), settings.window)
                for i in np.unique(np.linspace(0, len(all_) - 1, settings.windows).round().astype(int)):
                    langs.append(lang)
                    parts.append(all_[i].tobytes())
            yield pa.RecordBatch.from_pydict({"lang": pa.array(langs, pa.string()), "bytes": pa.array(parts, pa.binary())})

    found = sorted((r["lang"], bytes(r["bytes"])) for r in rows.mapInArrow(windows, "lang string, bytes binary").collect())
    classes = sorted({lang for lang, _ in found})
    x = np.frombuffer(b"".join(b for _, b in found), np.uint8).reshape(-1, settings.window)
    return ByteCnn(settings, classes).fit(x, np.array([classes.index(lang) for lang, _ in found]))


def labels(network: ByteCnn | None, texts: list[str | None]) -> list[tuple[str, float]]:
    """Language and score of each text."""
    out = []
    for text in texts:
        if network is None or not text or not any(map(str.isalpha, text)):
            out.append((UNKNOWN, 0.0))
            continue
        raw, size = text.encode(), network.s.window
        bytes_, mean = 0.0, np.zeros(len(network.classes))
        for at in range(0, len(raw), size << 12):
            part = raw[at : at + (size << 12)]
            x = cut(part, size)
            weight = np.full(len(x), size, np.float64)
            weight[-1] = len(part) - size * (len(x) - 1)
            mean += weight @ network.probabilities(x)
            bytes_ += weight.sum()
        best = int(mean.argmax())
        out.append((network.classes[best], float(min(1.0, mean[best] / bytes_))))
    return out


def predict(docs: DataFrame, network: ByteCnn | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred, score; only the text is an input of the prediction."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores = list(zip(*labels(network, batch.column("text").to_pylist()))) or ((), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                ["doc_id", "held_out", "lang_pred", "score"])

    own = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text")).mapInArrow(
        work, f"doc_id {own}, held_out boolean, lang_pred string, score double")


def keep_known(docs: DataFrame, network: ByteCnn | None, least_score: float, text_col: str = "text") -> DataFrame:
    """The rows of `docs` whose text has a language of at least `least_score`, with all columns, in the pass that predicts."""
    place = docs.columns.index(text_col)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = labels(network, batch.column(place).to_pylist())
            yield batch.filter(pa.array([lang != UNKNOWN and score >= least_score for lang, score in found], pa.bool_()))

    return docs.mapInArrow(work, docs.schema)


def identify(docs: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document by a network trained on those that are not held out.

    The network sees windows of `window` bytes; a text's score is the mean of
    its windows' probabilities over the whole text, by their bytes. Null text
    or a text without a letter: `und`, score 0; so is everything if there is
    nothing to learn from. Only learned languages are predicted. Rows without
    id or language are predicted but not learned from; repeated rows come back
    repeated; an empty table gives no rows.
    """
    return predict(docs, train(docs, settings, id_col, text_col, lang_col), id_col, text_col)
