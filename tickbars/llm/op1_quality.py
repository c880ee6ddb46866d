"""Quality rules: a linear-chain conditional random field labels a text's lines, and the share of content decides.

The lines that have a word are a sequence; Viterbi decoding marks each as content or boilerplate from its features
(length, symbols, capitals, digits, repeats) and its neighbours' labels. A document stays if at least `CONTENT_SHARE` of
its words stand in content lines and the base rule holds: 10 words or more, and not over a fifth of them in 5-word
windows that the text repeats.

The field is trained here, by gradient ascent on the exact likelihood: every line of a labelled document takes the
document's quality label, and documents of both labels are also joined in pairs, so that a sequence can change from one to the other.
Training reads at most `SAMPLE` documents of each label, those least by hash, of each `SAMPLE_CHARS` characters from a place chosen
by hash, and 4 * `SAMPLE` rows at most where ids repeat. Without labels of both kinds all lines count as content.

Edge cases: a null or empty text, or one without words, has no lines and fails the base rule; repeated rows are judged
each alike; a doc_id that `labels` repeats counts with its least label; extra columns are carried, whatever their
names (but `_quality*`).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickbars.llm.samples import least_by_hash, slice_by_hash
from tickbars.llm.texts import BYTE_LETTERS, Prefix, mix, text_chunks, word_letters, word_spans

CONTENT_SHARE = 0.5
LEAST_WORDS = 10
MOST_REPEATED = 20
WINDOW = 5
SAMPLE = 300
SAMPLE_CHARS = 10_000
STEPS = 120

_U = np.uint64
_LINE_END = 10
_CONTINUES = np.zeros(256, bool)
_CONTINUES[0x80:0xC0] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_STOP = np.zeros(256, bool)
_STOP[list(b".!?:;")] = True

#: Upper bounds of the steps into which a line's measures are cut.
_CUTS = {
    "words": (1, 2, 4, 8, 16, 32),
    "word_length": (2.5, 4, 6, 8, 12),
    "symbols": (0, 0.01, 0.04, 0.1),
    "capitals": (0, 0.05, 0.2, 0.5),
    "digits": (0, 0.05, 0.2),
    "repeats": (0, 0.2, 0.6),
}
_FLAGS = ("copy of an earlier line", "ends a sentence", "first", "last")
N_FEATURES = sum(len(c) + 1 for c in _CUTS.values()) + len(_FLAGS)


def _sums(mask: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(mask)))
    return total[bounds[1:]] - total[bounds[:-1]]


class Lines:
    """Base measures of each row, and its lines that have a word with their features."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray):
        rows = len(bounds) - 1
        starts, ends, offsets = word_spans(data, bounds)
        self.n_words = np.diff(offsets)
        inside = np.zeros(len(data) + 1, np.int8)
        inside[starts] = 1
        inside[ends] -= 1
        points = np.cumsum(inside[:-1], dtype=np.int8).astype(bool) & ~_CONTINUES[data]
        self.word_chars = _sums(points, bounds)
        self.n_symbols = _sums(_SYMBOL[data], bounds)
        repeated = self._repeated(word_letters(data, starts, ends), offsets)
        self.n_repeat_words = _sums(repeated, offsets)

        # A line starts with its row and after each line end.
        begins = np.unique(np.concatenate((bounds[:-1], np.flatnonzero(data == _LINE_END) + 1)))
        begins = begins[begins < len(data)]
        upto = np.append(begins[1:], len(data))
        row = np.searchsorted(bounds, begins, "right") - 1
        words = np.append(np.searchsorted(starts, begins), len(starts))
        count = np.diff(words)
        used = count > 0
        begins, upto, row, first_word, count = begins[used], upto[used], row[used], words[:-1][used], count[used]
        closed = data[upto - 1] == _LINE_END if len(upto) else np.zeros(0, bool)
        names = mix(Prefix(BYTE_LETTERS[data]).span(begins, upto - closed) + row.astype(np.uint64) * _U(0x9E3779B97F4A7C15))
        _, first = np.unique(names, return_index=True)
        copy = np.ones(len(names), bool)
        copy[first] = False
        self.row, self.count = row, count
        self.n_dup_lines = np.bincount(row[copy], minlength=rows)

        chars = np.maximum(self._per_line(points, begins, upto), 1)
        last_word = first_word + count
        total = np.concatenate(([0], np.cumsum(repeated)))
        measures = {
            "words": count,
            "word_length": chars / np.maximum(count, 1),
            "symbols": self._per_line(_SYMBOL[data], begins, upto) / chars,
            "capitals": self._per_line(_UPPER[data], begins, upto) / chars,
            "digits": self._per_line(_DIGIT[data], begins, upto) / chars,
            "repeats": (total[last_word] - total[first_word]) / np.maximum(count, 1),
        }
        features = np.zeros((len(row), N_FEATURES), np.float32)
        at, each = 0, np.arange(len(row))
        for name, cuts in _CUTS.items():
            features[each, at + np.searchsorted(cuts, measures[name])] = 1
            at += len(cuts) + 1
        new_row = np.concatenate(([True], row[1:] != row[:-1])) if len(row) else np.zeros(0, bool)
        for flag in (copy, _STOP[data[ends[last_word - 1] - 1]] if len(row) else copy, new_row, np.append(new_row[1:], True)[: len(row)]):
            features[:, at] = flag
            at += 1
        self.features = features

    @staticmethod
    def _per_line(mask: np.ndarray, begins: np.ndarray, upto: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(mask)))
        return total[upto] - total[begins]

    @staticmethod
    def _repeated(names: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Words in windows of WINDOW words that their row holds twice or more."""
        room = np.maximum(np.diff(offsets) - WINDOW + 1, 0)
        row = np.repeat(np.arange(len(room)), room)
        start = np.arange(room.sum()) + (offsets[:-1] - np.cumsum(room) + room)[row]
        windows = mix(Prefix(names).span(start, start + WINDOW) + row.astype(np.uint64) * _U(0x9E3779B97F4A7C15))
        order = np.argsort(windows)
        same = windows[order][1:] == windows[order][:-1]
        twice = np.zeros(len(start), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        depth = np.zeros(len(names) + 1, np.int32)
        np.add.at(depth, start[twice], 1)
        np.add.at(depth, start[twice] + WINDOW, -1)
        return np.cumsum(depth[:-1]) > 0


def viterbi(scores: np.ndarray, moves: np.ndarray) -> list[int]:
    """Best labels (0 or 1) of one sequence. scores: (lines, 2); moves[a, b]: score of b after a."""
    (m00, m01), (m10, m11) = moves.tolist()
    a, b = 0.0, 0.0
    back = []
    for k, (s0, s1) in enumerate(scores.tolist()):
        if not k:
            a, b = s0, s1
            continue
        to0, to1 = b + m10 > a + m00, b + m11 > a + m01
        back.append((to0, to1))
        a, b = (b + m10 if to0 else a + m00) + s0, (b + m11 if to1 else a + m01) + s1
    labels = [int(b > a)]
    for to in reversed(back):
        labels.append(int(to[labels[-1]]))
    return labels[::-1]


class LineField:
    """weights: (features, 2); moves: (2, 2)."""

    def __init__(self, weights: np.ndarray, moves: np.ndarray):
        self.weights, self.moves = weights, moves

    @classmethod
    def untrained(cls) -> LineField:
        return cls(np.tile([0.0, 1.0], (N_FEATURES, 1)), np.zeros((2, 2)))

    @classmethod
    def train(cls, sequences: list[np.ndarray], labels: list[list[int]], steps: int = STEPS, rate: float = 0.1, decay: float = 1e-3) -> LineField:
        """Adam on the mean log-likelihood of the labels of the sequences' lines; those of one label, of the other and of both weigh alike."""
        order = sorted(range(len(sequences)), key=lambda k: -len(sequences[k]))
        sequences, gold = [sequences[k] for k in order], np.concatenate([labels[k] for k in order])
        kind = np.array([labels[k][0] if len(set(labels[k])) == 1 else 2 for k in order])
        size = np.array([len(s) for s in sequences])
        n, longest = len(size), int(size.max())
        here = np.arange(longest)[:, None] < size[None, :]
        lines = np.concatenate(sequences).astype(float)
        column = np.repeat(np.arange(n), size)
        place = np.arange(len(lines)) - np.repeat(np.cumsum(size) - size, size)
        balance = 1.0 / np.maximum(np.bincount(kind, minlength=3), 1)[kind]
        weight = balance / size / balance.sum()
        true = np.zeros((longest, n, 2))
        true[place, column] = np.eye(2)[gold]
        theta = np.zeros(N_FEATURES * 2 + 4)
        slow, fast = np.zeros_like(theta), np.zeros_like(theta)
        alive = here.sum(1)
        for step in range(1, steps + 1):
            w, moves = theta[:-4].reshape(-1, 2), theta[-4:].reshape(2, 2)
            scores = np.zeros((longest, n, 2))
            scores[place, column] = lines @ w
            ahead, behind = np.zeros((longest, n, 2)), np.zeros((longest, n, 2))
            ahead[0] = scores[0]
            for t in range(1, longest):
                k = alive[t]
                ahead[t, :k] = np.logaddexp.reduce(ahead[t - 1, :k, :, None] + moves, axis=1) + scores[t, :k]
            for t in range(longest - 2, -1, -1):
                k = alive[t + 1]
                behind[t, :k] = np.logaddexp.reduce(moves + (scores[t + 1, :k] + behind[t + 1, :k])[:, None, :], axis=2)
            whole = np.logaddexp.reduce(ahead[size - 1, np.arange(n)], axis=1)
            odds = np.exp(np.clip(ahead + behind - whole[None, :, None], -50, 0))
            gap = (true - odds)[place, column] * weight[column, None]
            slope = np.empty_like(theta)
            slope[:-4] = (lines.T @ gap).ravel()
            pairs = np.zeros((2, 2))
            for t in range(1, longest):
                k = alive[t]
                both = np.exp(np.clip(ahead[t - 1, :k, :, None] + moves + (scores[t, :k] + behind[t, :k])[:, None, :] - whole[:k, None, None], -50, 0))
                pairs += np.einsum("n,nab->ab", weight[:k], true[t - 1, :k, :, None] * true[t, :k, None, :] - both)
            slope[-4:] = pairs.ravel()
            slope -= decay * theta
            slow, fast = 0.9 * slow + 0.1 * slope, 0.99 * fast + 0.01 * slope**2
            theta = theta + rate * (slow / (1 - 0.9**step)) / (np.sqrt(fast / (1 - 0.99**step)) + 1e-8)
        return cls(theta[:-4].reshape(-1, 2), theta[-4:].reshape(2, 2))

    def content(self, lines: Lines, rows: int) -> np.ndarray:
        """Words of each row that stand in content lines."""
        scores = lines.features @ self.weights
        edges = np.searchsorted(lines.row, np.arange(rows + 1))
        label = np.zeros(len(scores))
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
            if b > a:
                label[a:b] = viterbi(scores[a:b], self.moves)
        return np.bincount(lines.row, weights=label * lines.count, minlength=rows)


def trained_field(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> LineField:
    """Fit on a bounded sample: `sample` documents of each quality label, least by hash; their ids are broadcast."""
    marked = labels.filter("quality in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    sized = docs.filter(F.length("text") > 0).select("doc_id").join(marked, "doc_id")
    picked = least_by_hash(sized.select("doc_id", "quality"), "quality", sample)
    texts = docs.filter(F.length("text") > 0).select("doc_id", slice_by_hash("text", "doc_id", SAMPLE_CHARS).alias("text"))
    found = texts.join(F.broadcast(picked.distinct()), "doc_id")
    found = found.distinct().orderBy(F.xxhash64("text"), "doc_id", "text", "quality").limit(4 * sample)
    rows = sorted((r["text"], r["quality"]) for r in found.collect())
    of: tuple[list[np.ndarray], list[np.ndarray]] = ([], [])
    for text, quality in rows:
        data = np.frombuffer(text.encode(), np.uint8)
        features = Lines(data, np.array([0, len(data)])).features
        if len(features):
            of[int(quality)].append(features)
    if not (of[0] and of[1]):
        return LineField.untrained()
    sequences = [*of[0], *of[1]]
    marks = [[mark] * len(s) for mark in (0, 1) for s in of[mark]]
    # Documents have one label, pages have both kinds of lines: pairs in either order show the field where one kind ends.
    for k, pair in enumerate(zip(*of)):
        order = (0, 1) if k % 2 else (1, 0)
        sequences.append(np.concatenate([pair[i] for i in order]))
        marks.append([i for i in order for _ in range(len(pair[i]))])
    return LineField.train(sequences, marks)


MEASURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, content_words long, kept boolean"
)


def judged(docs: DataFrame, field: LineField) -> DataFrame:
    """doc_id, text and the other columns of docs, and a struct `_quality` of MEASURES."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [m.split()[0] for m in MEASURES.split(", ")]
        for batch in batches:
            texts = batch.column("text")
            if pa.types.is_null(texts.type):
                texts = texts.cast(pa.string())
            for first, last, data, bounds in text_chunks(texts):
                lines = Lines(data, bounds)
                content = field.content(lines, last - first).astype(np.int64)
                failed = (lines.n_words < LEAST_WORDS) | (100 * lines.n_repeat_words > MOST_REPEATED * lines.n_words)
                kept = ~failed & (content >= CONTENT_SHARE * lines.n_words)
                values = [lines.n_words, lines.word_chars, lines.n_symbols, lines.n_dup_lines, lines.n_repeat_words, failed, content, kept]
                measures = pa.StructArray.from_arrays([pa.array(v) for v in values], names)
                part = batch.slice(first, last - first)
                yield pa.RecordBatch.from_arrays([*part.columns, measures], [*part.schema.names, "_quality"])

    kinds = ", ".join(m.replace(" ", ": ", 1) for m in MEASURES.split(", "))
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(run, f"{columns}, _quality struct<{kinds}>")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that the rules reject go."""
    field = trained_field(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return judged(docs, field).filter("_quality.kept").select(*docs.columns)


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    field = trained_field(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return judged(texts, field).select("doc_id", "_quality.*")
