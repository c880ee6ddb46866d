"""The line field and the language net."""

import itertools
import random

import numpy as np
from pyspark.sql import functions as F

import brute
from tickbars.llm import op1_quality, op5_language
from tickbars.llm.samples import least_by_hash, slice_by_hash

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_viterbi_is_the_best_labelling():
    pick = np.random.default_rng(1)
    for n in range(1, 9):
        scores, moves = pick.normal(size=(n, 2)), pick.normal(size=(2, 2))
        best = max(itertools.product((0, 1), repeat=n), key=lambda y: sum(scores[k, v] for k, v in enumerate(y)) + sum(moves[a, b] for a, b in zip(y, y[1:])))
        assert op1_quality.viterbi(scores, moves) == list(best)


def test_training_tells_two_kinds_of_lines_apart():
    pick = np.random.default_rng(2)
    lines = [np.eye(op1_quality.N_FEATURES, dtype=np.float32)[pick.integers(0, 4, 6) + 4 * (k % 2)] for k in range(40)]
    marks = [[k % 2] * 6 for k in range(40)]
    field = op1_quality.LineField.train(lines, marks)
    assert all(op1_quality.viterbi(s @ field.weights, field.moves) == m for s, m in zip(lines, marks))


def test_a_change_of_kinds_within_a_text_is_found(spark):
    """Junk under content: the lines' labels change once, about where the texts meet, and the share follows."""
    docs, labels = (spark.read.parquet(f"{MIDDLE}/{t}.parquet") for t in ("documents", "labels"))
    field = op1_quality.trained_field(docs, labels)
    of = {q: [r["text"] for r in docs.join(labels.filter(F.col("quality") == q), "doc_id").orderBy("doc_id").collect() if r["text"]] for q in (0, 1)}
    found = []
    for junk, good in zip(of[0], of[1]):
        parts = [op1_quality.Lines(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())])) for t in (junk, good, f"{good}\n{junk}")]
        alone, both = [field.content(p, 1)[0] / p.count.sum() for p in parts[:2]], field.content(parts[2], 1)[0]
        if alone == [0, 1]:
            found.append(abs(both - parts[1].count.sum()) / parts[2].count.sum())
    assert len(found) > 20 and np.mean(np.array(found) < 0.1) > 0.9


def test_kept_is_the_share_of_the_best_labelling(spark):
    """Against all labellings of short texts, from the features of single lines."""
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    field = op1_quality.trained_field(docs, labels)
    rows = [r for r in docs.select("doc_id", "text").collect() if r["text"] and 0 < r["text"].count("\n") < 10]
    got = {r["doc_id"]: r["_quality"] for r in op1_quality.judged(docs.select("doc_id", "text"), field).collect()}
    assert len(rows) > 20
    for r in rows:
        data = np.frombuffer(r["text"].encode(), np.uint8)
        lines = op1_quality.Lines(data, np.array([0, len(data)]))
        scores = lines.features @ field.weights
        best = max(itertools.product((0, 1), repeat=len(scores)), key=lambda y: sum(scores[k, v] for k, v in enumerate(y)) + sum(field.moves[a, b] for a, b in zip(y, y[1:])))
        words = sum(n * v for n, v in zip(lines.count.tolist(), best))
        q = got[r["doc_id"]]
        assert q["content_words"] == words and q["kept"] == (not q["base_failed"] and 2 * words >= q["n_words"])


def test_net_against_plain_python():
    """The forward pass, one window, filter and place at a time."""
    pick = np.random.default_rng(3)
    texts = [b"abc", b"the cat sat" * 30, bytes(range(1, 256)) * 2]
    bounds = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    tables = [pick.normal(size=(span, 256, op5_language.FILTERS)).astype(np.float32) for span in op5_language.SPANS]
    bias = pick.normal(size=(len(tables), op5_language.FILTERS)).astype(np.float32)
    net = op5_language.ByteNet(["a", "b", "c"], tables, bias, pick.normal(size=(len(tables) * op5_language.FILTERS + 1, 3)).astype(np.float32))
    which, score = net.predict(np.frombuffer(b"".join(texts), np.uint8), bounds)
    for row, text in enumerate(texts):
        mean = [0.0] * 3
        for at in range(0, len(text), op5_language.WIDTH):
            part = text[at : at + op5_language.WIDTH]
            window = part.ljust(op5_language.WIDTH, b"\0")
            pooled = []
            for table, b in zip(tables, bias):
                for f in range(op5_language.FILTERS):
                    best = max(sum(float(table[k][window[i + k]][f]) for k in range(len(table))) for i in range(len(window) - len(table) + 1))
                    pooled.append(max(best + float(b[f]), 0.0))
            scores = [sum(p * float(net.out[j][c]) for j, p in enumerate(pooled)) + float(net.out[-1][c]) for c in range(3)]
            odds = np.exp(np.array(scores) - max(scores))
            mean = [m + o * len(part) / len(text) for m, o in zip(mean, odds / odds.sum())]
        assert which[row] == int(np.argmax(mean)) and abs(score[row] - max(mean)) < 1e-4


def test_slices_come_from_anywhere(spark):
    text = "".join(chr(97 + i % 26) for i in range(5000))
    df = spark.createDataFrame([(i, text) for i in range(40)] + [(100, "short"), (None, None)], "doc_id long, text string")
    got = {r["doc_id"]: r["s"] for r in df.select("doc_id", slice_by_hash("text", "doc_id", 100).alias("s")).collect()}
    assert got[100] == "short" and got[None] is None
    assert all(len(got[i]) == 100 and got[i] in text for i in range(40)) and len({got[i][0] for i in range(40)}) > 10


def test_base_measures(spark):
    pick = random.Random(4)
    texts = [None, "", "\n\n", "one", " a b\n a b\na b\n", "é# * x|<>&%$\x85\n" * 5, "a b c d e f g " * 30, "w " * 20_000, "\n".join(pick.choice("xyz") * 3 for _ in range(300))]
    texts += [" ".join(pick.choice("abc") for _ in range(n)) for n in range(0, 60, 3)]
    df = spark.createDataFrame([(i, t, None, i) for i, t in enumerate(texts)] + [(None, "x", None, 1), (1, "", None, 1), (1, "", None, 1)], "doc_id long, text string, kept string, n_words int")
    got = op1_quality.judged(df, op1_quality.LineField.untrained())
    assert got.columns == [*df.columns, "_quality"]
    for r in got.collect():
        assert tuple(r["_quality"][c] for c in BASE) == brute.base_measures(r["text"])
        assert r["_quality"]["kept"] == (not r["_quality"]["base_failed"])
    assert op1_quality.judged(df.filter("false"), op1_quality.LineField.untrained()).collect() == []


def test_quality_query(spark):
    got = op1_quality.op1_quality(spark, MIDDLE)
    texts = {r["doc_id"]: r["text"] for r in brute.documents(MIDDLE)}
    rows = {r["doc_id"]: r for r in got.collect()}
    assert rows.keys() == texts.keys()
    for d, r in rows.items():
        assert tuple(r[c] for c in BASE) == brute.base_measures(texts[d])
    labels = spark.read.parquet(f"{MIDDLE}/labels.parquet").collect()
    good = [rows[r["doc_id"]]["kept"] for r in labels if r["quality"] == 1 and not rows[r["doc_id"]]["base_failed"]]
    junk = [rows[r["doc_id"]]["kept"] for r in labels if r["quality"] == 0]
    assert np.mean(good) > 0.98 and np.mean(junk) < 0.1


def test_no_labels_keeps_what_passes_the_base_rule(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    field = op1_quality.trained_field(docs, spark.read.parquet(f"{SMALL}/labels.parquet").filter("false"))
    assert op1_quality.judged(docs, field).filter("_quality.kept = _quality.base_failed").count() == 0


def test_samples_are_the_least_of_each_label(spark):
    rows = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 10 == 0, "b").otherwise("a").alias("label"), F.xxhash64("id").alias("h"))
    got = {(r["label"], r["doc_id"]) for r in least_by_hash(rows.drop("h"), "label", 40).collect()}
    held = sorted((r["label"], r["h"], r["doc_id"]) for r in rows.collect())
    assert got == {(label, d) for label in "ab" for _, _, d in [r for r in held if r[0] == label][:40]}


def test_repeated_rows_train_once(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    twice = docs.unionByName(docs)
    a, b = op5_language.trained_net(docs, 2000), op5_language.trained_net(twice, 2000)
    assert all(np.array_equal(x, y) for x, y in zip([*a.tables, a.out], [*b.tables, b.out]))
    c, d = op1_quality.trained_field(docs, labels), op1_quality.trained_field(twice, labels.unionByName(labels))
    assert np.array_equal(c.weights, d.weights) and np.array_equal(c.moves, d.moves)


def test_language_query_on_held_out_rows(spark):
    got = op5_language.op5_language(spark, MIDDLE).join(spark.read.parquet(f"{MIDDLE}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    assert len(got) == len(brute.documents(MIDDLE))
    import zlib

    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    held = [r["lang"] == r["lang_pred"] for r in got if r["held_out"]]
    assert np.mean(held) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got)


def test_language_edge_cases(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    net = op5_language.trained_net(docs)
    english = docs.filter("lang = 'en'").first()["text"]
    rows = [(1, None), (2, ""), (3, "12 % 9"), (None, english), (5, english * 300), (5, english * 300), (6, "e")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, score string")
    got = {r["doc_id"]: (r["lang_pred"], r["held_out"]) for r in op5_language.predicted(df, net).collect()}
    assert got[1][0] == got[2][0] == got[3][0] == "und" and got[5][0] == "en" and got[None] == ("en", True)
    assert op5_language.trained_net(docs.filter("false")) is None
    assert {r["lang_pred"] for r in op5_language.predicted(df, None).collect()} == {"und"}
    assert op5_language.predicted(df.filter("false"), net).collect() == []


def test_training_uses_no_held_out_row(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    poisoned = docs.withColumn("lang", F.when(op5_language.held_out(F.col("doc_id")), F.lit("xx")).otherwise(F.col("lang")))
    a, b = op5_language.trained_net(docs), op5_language.trained_net(poisoned)
    assert a.languages == b.languages and all(np.array_equal(x, y) for x, y in zip([*a.tables, a.out], [*b.tables, b.out]))
