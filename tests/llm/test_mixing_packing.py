"""Mixing and packing."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from tickbars.llm import op3_packing, op10_mixing

SMALL = "/root/testdata/sf0.001"


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def sources(spark):
    pick = random.Random(2)
    rows = [(i, " ".join("w" * pick.randrange(1, 5) for _ in range(pick.randrange(0, 30))), pick.choice(["a", "a", "a", "b", "é", None, "Z"]), i) for i in range(400)]
    rows += [(900, None, "a", 1), (901, "", "empty", 2), (None, "three more words", "b", 3), (902, "x " * 30_000, "b", 4)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, words int")


@pytest.mark.parametrize(("range_rows", "block_ranges"), [(20_000, 4096), (7, 4096), (7, 2), (1, 3)])
def test_mix(sources, range_rows, block_ranges):
    got = op10_mixing.mix(sources, range_rows, block_ranges)
    assert got.columns[:4] == sources.columns
    columns = ["doc_id", "_mix_words", "_mix_size", F.round("_mix_target", 6), "_mix_taken"]
    rows = result(got.select(*columns))
    want = sorted(brute.mixing([r.asDict() for r in sources.collect()]), key=repr)
    assert [r[:3] + r[4:] for r in rows] == [w[:3] + w[4:] for w in want]
    assert [r[3] for r in rows] == pytest.approx([w[3] for w in want])
    for r in got.groupBy("source").agg(F.sum("_mix_taken").alias("taken"), F.first("_mix_target").alias("target")).collect():
        assert abs(r["taken"] - r["target"]) <= 0.5


def test_mix_query_is_native(spark, plan):
    df = op10_mixing.op10_mixing(spark, SMALL)
    assert not any(word in plan(df) for word in ("Python", "Arrow", "Pandas"))
    assert [r[:3] + r[4:] for r in result(df)] == [w[:3] + w[4:] for w in sorted(brute.mixing(brute.documents(SMALL)), key=repr)]


def test_mix_stage(spark, sources):
    got = op10_mixing.stage(spark, sources, "").groupBy("doc_id").count()
    assert {r["count"] for r in got.collect()} <= {1, 2}
    assert op10_mixing.stage(spark, sources.filter("false"), "").collect() == []


def test_whole_ranges_are_not_shuffled(spark, plan):
    """Texts go to other tasks in one exchange alone, that of the ranges in which targets end: its rows are judged before it."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    text = plan(op10_mixing.stage(spark, docs, "")).split("== Physical Plan ==")[1]
    lines = text.splitlines()
    shuffles = [k for k, line in enumerate(lines) if "Exchange hashpartitioning" in line or "Exchange rangepartitioning" in line]
    with_text = [k for k in shuffles if "text#" in lines[k + 1]]
    assert len(with_text) == 1
    assert "<=> _mix_cut" in lines[with_text[0] + 2]
    assert "SortMergeJoin" not in text


def naive_best_fit(lengths, capacity):
    left, used = [], 0
    for n in lengths:
        fits = [k for k, room in enumerate(left) if room >= n]
        if fits:
            left[min(fits, key=lambda k: left[k])] -= n
        else:
            left.append(capacity - n)
            used += 1
    return sorted(left)


@pytest.mark.parametrize("capacity", [1, 10, 63, 64, 4096])
def test_best_fit(capacity):
    pick = random.Random(capacity)
    lengths = sorted((pick.randrange(1, capacity + 1) for _ in range(500)), reverse=True)
    bins, offsets = op3_packing.best_fit(lengths, capacity)
    filled = {}
    for b, o, n in zip(bins, offsets, lengths):
        assert o == filled.get(b, 0)
        filled[b] = o + n
    assert sorted(capacity - n for n in filled.values()) == naive_best_fit(lengths, capacity)


def check_packing(rows, docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = []
    for d in docs:
        ids = tokenizer.encode(d["text"] or "", add_special_tokens=False).ids + [1]
        for n, at in enumerate(range(0, len(ids), 4096)):
            part = np.array(ids[at : at + 4096], "<u4")
            want.append((d["doc_id"], n, at, len(part), zlib.crc32(part.tobytes())))
    assert sorted((tuple(r)[:5] for r in rows), key=repr) == sorted(want, key=repr)
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 4096
    return len(sequences), sum(w[3] for w in want)


def test_packing_query(spark):
    used, tokens = check_packing(op3_packing.op3_packing(spark, SMALL).collect(), brute.documents(SMALL))
    assert used <= 1.01 * tokens / 4096 + 2


def test_packing_of_odd_texts(spark):
    texts = [None, "", " \t\n", "word " * 9000, "<|endoftext|> <|startoftext|>x", "É é  Σας ΟΔΟΣ 12,5€ don't DON'T", "\x1c\x1d\x85  ", "a" * 5000, "日本語 テスト", "\U0001f600‍ x\x00y"]
    rows = [(i, t, i) for i, t in enumerate(texts)] + [(3, "word " * 9000, 0), (None, "no id", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, shard int")
    check_packing(op3_packing.packed(df).collect(), [r.asDict() for r in df.collect()])
    assert op3_packing.packed(df.filter("false")).collect() == []
