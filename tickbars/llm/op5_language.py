"""Language ID by a byte convolutional network, trained here in numpy.

A text is cut into windows of `WIDTH` bytes (the last one filled up with zero). Filters over 2, 3 and 4 bytes run along
each window, the greatest response of each is kept, and a softmax layer gives the languages' odds. A text's odds are the
mean of its windows', by their bytes; every window of every text counts.

Training reads only text and lang of documents that aren't held out (crc32 of doc_id mod 5 is not 0), at most `SAMPLE` of
each language, least by hash, and of each `SAMPLE_CHARS` characters from a place chosen by hash.

Edge cases: a null text, or one without a letter, is `und` with score 0; so is everything if there is nothing to learn
from; a null doc_id counts as held out; repeated rows are predicted each alike; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickbars.llm.samples import least_by_hash, slice_by_hash
from tickbars.llm.texts import text_chunks

WIDTH = 256
SPANS = (2, 3, 4)
FILTERS = 8
SAMPLE = 300
SAMPLE_CHARS = 4 * WIDTH
EPOCHS = 12
UNKNOWN = "und"
CHUNK = 1 << 18

_LETTER = regex.compile(r"\p{L}")


def windows_of(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(windows, row, bytes) of the rows of a chunk."""
    size = np.diff(bounds)
    count = -(-size // WIDTH)
    row = np.repeat(np.arange(len(size)), count)
    at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    begin = bounds[:-1][row] + at * WIDTH
    length = np.minimum(WIDTH, bounds[1:][row] - begin)
    grid = begin[:, None] + np.arange(WIDTH)
    cells = np.append(data, np.uint8(0))[np.minimum(grid, len(data))]
    cells[np.arange(WIDTH) >= length[:, None]] = 0
    return cells, row, length


class ByteNet:
    """tables: for each span and each place in it, (256, filters); bias: (spans, filters); out: (features + 1, languages)."""

    def __init__(self, languages: list[str], tables: list[np.ndarray], bias: np.ndarray, out: np.ndarray):
        self.languages, self.tables, self.bias, self.out = languages, tables, bias, out

    def features(self, cells: np.ndarray, where: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
        """Pooled responses (windows, features), and the places they come from."""
        pooled, places = [], []
        for tables, bias in zip(self.tables, self.bias):
            wide = WIDTH - len(tables) + 1
            found = tables[0][cells[:, :wide]]
            for k in range(1, len(tables)):
                found += tables[k][cells[:, k : k + wide]]
            if where:
                place = found.argmax(1)
                places.append(place)
                best = np.take_along_axis(found, place[:, None], 1)[:, 0]
            else:
                best = found.max(1)
            pooled.append(np.maximum(best + bias, 0))
        return np.concatenate(pooled, 1), np.stack(places, 1) if where else None

    def odds(self, features: np.ndarray) -> np.ndarray:
        scores = features @ self.out[:-1] + self.out[-1]
        scores = np.exp(scores - scores.max(1, keepdims=True))
        return scores / scores.sum(1, keepdims=True)

    @classmethod
    def train(cls, cells: np.ndarray, labels: np.ndarray, languages: list[str], epochs: int = EPOCHS, rate: float = 0.01, batch: int = 128) -> ByteNet:
        """Adam on the cross entropy; only the pooled places pass a gradient back."""
        random = np.random.default_rng(7)
        tables = [random.normal(0, 0.3, (span, 256, FILTERS)).astype(np.float32) for span in SPANS]
        net = cls(languages, tables, np.zeros((len(SPANS), FILTERS), np.float32), random.normal(0, 0.1, (len(SPANS) * FILTERS + 1, len(languages))).astype(np.float32))
        parts = [*net.tables, net.bias, net.out]
        slow, fast = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts]
        share = 1.0 / np.maximum(np.bincount(labels, minlength=len(languages)), 1)
        step = 0
        for _ in range(epochs):
            order = random.permutation(len(cells))
            for first in range(0, len(order), batch):
                mine = order[first : first + batch]
                x, y = cells[mine], labels[mine]
                features, places = net.features(x, where=True)
                weight = share[y] / share[y].sum()
                gap = (net.odds(features) - np.eye(len(languages), dtype=np.float32)[y]) * weight[:, None].astype(np.float32)
                slopes = [np.zeros_like(p) for p in parts]
                slopes[-1][:-1], slopes[-1][-1] = features.T @ gap, gap.sum(0)
                back = (gap @ net.out[:-1].T) * (features > 0)
                each = np.arange(len(x))[:, None]
                for s, span in enumerate(SPANS):
                    part = back[:, s * FILTERS : (s + 1) * FILTERS]
                    slopes[-2][s] = part.sum(0)
                    for k in range(span):
                        np.add.at(slopes[s][k], (x[each, places[:, s] + k], np.arange(FILTERS)[None, :]), part)
                step += 1
                for p, g, a, b in zip(parts, slopes, slow, fast):
                    a += 0.1 * (g - a)
                    b += 0.01 * (g * g - b)
                    p -= (rate * a / (1 - 0.9**step) / (np.sqrt(b / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
        return net

    def predict(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(language index, score) of each row of a chunk; rows aren't all empty."""
        rows = len(bounds) - 1
        total = np.zeros((rows, len(self.languages)))
        cells, row, length = windows_of(data, bounds)
        for first in range(0, len(cells), 1024):
            odds = self.odds(self.features(cells[first : first + 1024])[0])
            np.add.at(total, row[first : first + 1024], odds * length[first : first + 1024, None])
        total /= np.maximum(np.diff(bounds), 1)[:, None]
        return total.argmax(1), np.clip(total.max(1), 0, 1)


def held_out(doc_id) -> F.Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def trained_net(docs: DataFrame, sample: int = SAMPLE) -> ByteNet | None:
    """Fit on a bounded sample of labelled rows that aren't held out, their ids broadcast; None without any."""
    learnable = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    picked = least_by_hash(learnable.select("doc_id", "lang"), "lang", sample)
    texts = learnable.select("doc_id", slice_by_hash("text", "doc_id", SAMPLE_CHARS).alias("text"))
    rows = sorted((r["lang"], r["doc_id"], r["text"]) for r in texts.join(F.broadcast(picked.distinct()), "doc_id").distinct().collect())
    languages = sorted({r[0] for r in rows if _LETTER.search(r[2])})
    cells, labels = [], []
    for lang, _, text in rows:
        if lang in languages and _LETTER.search(text):
            data = np.frombuffer(text.encode(), np.uint8)
            found = windows_of(data, np.array([0, len(data)]))[0]
            cells.append(found)
            labels += [languages.index(lang)] * len(found)
    if not cells:
        return None
    return ByteNet.train(np.concatenate(cells), np.array(labels), languages)


def predicted(docs: DataFrame, net: ByteNet | None) -> DataFrame:
    """doc_id, held_out, lang_pred, score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, bounds in text_chunks(batch.column(2), CHUNK):
                texts = batch.column(2).slice(first, last - first)
                known = np.array([bool(t.is_valid and _LETTER.search(t.as_py())) for t in texts]) & (net is not None)
                which, score = np.zeros(last - first, np.int64), np.zeros(last - first)
                if known.any():
                    which, score = net.predict(data, bounds)
                names = [net.languages[k] if ok else UNKNOWN for k, ok in zip(which.tolist(), known.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first), batch.column(1).slice(first, last - first), pa.array(names), pa.array(np.where(known, score, 0.0))],
                    ["doc_id", "held_out", "lang_pred", "score"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    return predicted(docs, trained_net(docs))
