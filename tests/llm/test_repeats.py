"""The two substring operators against counting all windows."""

import random

import pytest
from pyspark.sql import functions as F

import brute
from tickbars.llm import op4_suffix_dedup, op8_substring_dedup

SMALL = "/root/testdata/sf0.001"


def tricky_texts():
    pick = random.Random(3)
    letters = "abcdefgh ij\n"
    passage = "".join(pick.choice(letters) for _ in range(3000))
    words = [f"w{pick.randrange(40)}" for _ in range(4000)]
    texts = [None, "", " \n ", "short", "é" * 900, "ab" * 700, "For " * 600, "For " * 650 + "end", "x" * 399, "x" * 400, "y" * 401]
    for _ in range(30):
        a, n = pick.randrange(2400), pick.randrange(380, 600)
        texts.append("".join(pick.choice(letters) for _ in range(pick.randrange(300))) + passage[a : a + n] + "".join(pick.choice(letters) for _ in range(pick.randrange(300))))
        a, n = pick.randrange(3900), pick.randrange(30, 60)
        own = [f"v{pick.randrange(10**6)}" for _ in range(60)]
        texts.append(" ".join(own[:30]) + "\t" + "  ".join(words[a : a + n]) + " " + " ".join(own[30:]))
    texts += [texts[-1], texts[-2], " ".join(words), "a b c d e " * 40 + "\x85   z" * 40]
    return texts


@pytest.fixture(scope="module")
def tricky(spark):
    rows = [(i if i % 7 else i // 7, t, "x", i) for i, t in enumerate(tricky_texts())]
    rows += [(None, "y" * 500, "x", 0), rows[20], rows[20]]
    return spark.createDataFrame(rows, "doc_id long, text string, lo string, row_key int").repartition(3).cache()


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def expected(rows, solve):
    return sorted(solve([r if isinstance(r, dict) else r.asDict() for r in rows]), key=repr)


@pytest.mark.parametrize("hot", [op4_suffix_dedup.HOT, 0])
def test_bytes_of_tricky_texts(tricky, hot):
    assert result(op4_suffix_dedup.remove_repeats(tricky, hot).drop("kept")) == expected(tricky.collect(), brute.suffix_dedup)


def test_large_group_behind_small_ones(spark):
    """A group of over 4,096 contexts stays whole, wherever it begins in a batch."""
    one = F.when(F.col("id") == 14999, 9000).otherwise(F.col("id")).cast("string")
    rows = spark.range(0, 15000, 1, 1).select(
        F.least("id", F.lit(9000)).alias("around"), F.col("id").alias("row_key"), F.lit(0).alias("lo"), F.lit(0).alias("hi"),
        F.lit(True).alias("open"), F.lit(0).alias("anchor"), F.encode(F.rpad(one, op4_suffix_dedup.LENGTH, "-"), "UTF-8").alias("bytes"),
    )
    assert result(op4_suffix_dedup.rim_windows(rows)) == [(14999, 0, 0), (9000, 0, 0)]


def test_words_of_tricky_texts(tricky):
    assert result(op8_substring_dedup.remove_repeats(tricky).drop("kept")) == expected(tricky.collect(), brute.substring_dedup)


def test_queries(spark):
    rows = brute.documents(SMALL)
    assert result(op4_suffix_dedup.op4_suffix_dedup(spark, SMALL)) == expected(rows, brute.suffix_dedup)
    assert result(op8_substring_dedup.op8_substring_dedup(spark, SMALL)) == expected(rows, brute.substring_dedup)


def test_empty_table(tricky):
    nothing = tricky.filter(F.lit(False))
    assert result(op4_suffix_dedup.remove_repeats(nothing)) == result(op8_substring_dedup.remove_repeats(nothing)) == []


def test_kept_text(spark):
    same = " ".join(f"k{i}" for i in range(40))
    df = spark.createDataFrame([(1, f"head {same}"), (2, f"{same}  tail\n"), (3, "a\tb")], "doc_id long, text string")
    assert {r["doc_id"]: r["kept"] for r in op8_substring_dedup.remove_repeats(df).collect()} == {1: "head", 2: "tail", 3: "a b"}
    df = spark.createDataFrame([(1, "<" + "z" * 150 + same * 3 + ">"), (2, "[" + "z" * 150 + same * 3 + "]")], "doc_id long, text string")
    assert {r["doc_id"]: bytes(r["kept"]) for r in op4_suffix_dedup.remove_repeats(df).collect()} == {1: b"<>", 2: b"[]"}
