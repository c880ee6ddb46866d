"""Exact and near dedup, and components."""

import random

import pytest
from pyspark.sql import functions as F

import brute
from tickbars.llm import op2_exact_dedup, op7_simhash
from tickbars.llm.components import components

SMALL = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "_dedup_keep_id", "_dedup_size", "_dedup_kept", "_dedup_digest"]


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def copies(spark):
    rows = [(1, None, 5), (2, "", 6), (3, " \n", 7), (4, "a b", 1), (5, "ab", 2), (6, "a  b", 3), (7, "ab ", 4), (8, "a b", 1), (9, "é", 0), (10, "x" * 100_000, 0)]
    rows += [(None, "zz", 1), (20, "zz", 2), (30 + 0, "a\x1cb", 1)] + [(100 + i, "hot copy", i) for i in range(300)]
    return spark.createDataFrame(rows, "doc_id long, text string, digest int").repartition(4, "doc_id").cache()


@pytest.mark.parametrize("digest", [op2_exact_dedup.sha256, lambda c: F.lit("one"), lambda c: F.substring(F.sha2(c, 256), 1, 1)])
def test_exact_copies(copies, digest):
    got = op2_exact_dedup.exact_dedup(copies, digest)
    want = [w[:4] for w in brute.exact_dedup([r.asDict() for r in copies.collect()])]
    assert got.columns[:3] == copies.columns
    assert result(got.select(*COLUMNS[:4])) == sorted(want, key=repr)


def test_repeated_rows_leave_one(spark):
    df = spark.createDataFrame([(1, "same"), (1, "same"), (1, "sa me"), (1, "sa me")], "doc_id long, text string")
    got = op2_exact_dedup.exact_dedup(df).collect()
    assert [r["text"] for r in got if r["_dedup_kept"]] == ["sa me"]
    assert {r["_dedup_size"] for r in got} == {4}
    assert op2_exact_dedup.exact_dedup(df.filter("false")).collect() == []


def test_exact_query(spark):
    assert result(op2_exact_dedup.op2_exact_dedup(spark, SMALL)) == sorted(brute.exact_dedup(brute.documents(SMALL)), key=repr)


def test_components_of_random_graphs(spark):
    pick = random.Random(5)
    links = [(pick.randrange(300), pick.randrange(300)) for _ in range(180)] + [(1000 + i, 1001 + i) for i in range(200)] + [(5000, 5001 + i) for i in range(100)] + [(7, 7)]
    nodes = {n for a, b in links for n in (a, b) if a != b}
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "u long, v long"), "test").collect()}
    assert got == brute.components(nodes, [e for e in links if e[0] != e[1]])
    assert components(spark.createDataFrame([], "u long, v long"), "test").collect() == []


@pytest.mark.parametrize(("distance", "blocks"), [(3, 5), (3, 4), (2, 6)])
def test_each_close_pair_comes_once(spark, distance, blocks):
    pick = random.Random(9)
    held = {pick.getrandbits(64) for _ in range(30)}
    for base in list(held):
        held |= {base ^ sum(1 << b for b in pick.sample(range(64), pick.randrange(6))) for _ in range(6)}
    signed = sorted(f - (1 << 64) if f >> 63 else f for f in held)
    got = [tuple(r) for r in op7_simhash.links(spark.createDataFrame([(f,) for f in signed], "fingerprint long"), distance, blocks).collect()]
    want = [(u, v) for i, u in enumerate(signed) for v in signed[i + 1 :] if ((u ^ v) & (2**64 - 1)).bit_count() <= distance]
    assert sorted(got) == want
    assert len(want) > 40


def test_fingerprint():
    for text in ("", "one", "One two", "A b C d a B c D " * 9, "é È x\u0085y   z", "word " * 70_000):
        assert op7_simhash.fingerprint(text.encode()) % 2**64 == brute.fingerprint(text)


@pytest.mark.parametrize("blocks", [4, 5, 7])
def test_close_pairs_meet_and_others_do_not(spark, blocks):
    pick = random.Random(blocks)
    prints = {pick.getrandbits(64) for _ in range(40)} | {0, 2**64 - 1}
    for f in list(prints):
        for flips in (1, 2, 3, 4):
            prints.add(f ^ sum(1 << b for b in pick.sample(range(64), flips)))
    signed = [(f - 2**64 if f >> 63 else f,) for f in prints]
    got = {(r["u"] % 2**64, r["v"] % 2**64) for r in op7_simhash.links(spark.createDataFrame(signed, "fingerprint long"), blocks=blocks).collect()}
    want = {frozenset((a, b)) for a in prints for b in prints if a != b and (a ^ b).bit_count() <= 3}
    assert {frozenset(p) for p in got} == want and len(got) == len(want)


def test_near_query(spark):
    assert result(op7_simhash.op7_simhash(spark, SMALL)) == sorted(brute.simhash(brute.documents(SMALL)), key=repr)


def test_near_stage(spark):
    long = " ".join(f"w{i}" for i in range(4000))
    rows = [(4, long, 1), (3, long + " more", 2), (9, None, 3), (8, "", 4), (8, "", 4), (None, "quite another text", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, root int")
    kept = op7_simhash.stage(spark, df, "")
    assert kept.columns == df.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == [3, 8, None]
    assert op7_simhash.stage(spark, df.filter("false"), "").collect() == []


def test_near_stage_looks_up_the_dropped_rows(spark, plan):
    """The kept rows' ids are too many to broadcast here, the dropped ones' are not: no text is shuffled."""
    pick = random.Random(4)
    rows = [(i, " ".join(f"w{pick.randrange(10**6)}" for _ in range(20))) for i in range(4000)]
    df = spark.createDataFrame(rows + [(4000 + i, rows[i][1]) for i in range(3)], "doc_id long, text string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "4k")
    try:
        kept = op7_simhash.stage(spark, df, "")
        text = plan(kept).split("== Physical Plan ==")[1]
        assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text and "hashpartitioning" not in text
        assert sorted(r["doc_id"] for r in kept.collect()) == list(range(4000))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("operator", [op2_exact_dedup, op7_simhash])
def test_ids_outlive_a_change_of_splits(spark, tmp_path, monkeypatch, operator):
    """After the first action the source is split otherwise, as it is when executors come or go."""
    rows = [(i // 2, f"text {i // 2} of its own " * 40 + f"{i // 2}") for i in range(400)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(8, "doc_id").write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    keep = operator.stored

    def stored(*args):
        out = keep(*args)
        spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        return out

    monkeypatch.setattr(operator, "stored", stored)
    try:
        kept = [r["doc_id"] for r in operator.stage(spark, docs, "").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    want = {r["doc_id"] for r in operator.stage(spark, docs, "").collect()}
    assert len(kept) == len(set(kept)) and set(kept) == want and want
