"""A third of all rows may be one row."""

from pyspark.sql import functions as F

from tickbars.llm import op3_packing, op8_substring_dedup, repeats
from tickbars.llm.samples import least_by_hash
from tickbars.llm.texts import stored


def test_ranges_of_equal_rows_are_one_set(spark):
    once = spark.createDataFrame([(7, lo, lo + 3) for lo in range(0, 400, 4)], "row_key long, lo int, hi int")
    many = once.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(200)))).drop("copy")
    assert [len(r["ranges"]) for r in repeats.ranges_of(many, once).collect()] == [100]


def test_equal_rows_are_removed_whole(spark):
    text = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(1, text)] * 500 + [(2, text + " tail"), (3, "alone")], "doc_id long, text string")
    got = op8_substring_dedup.remove_repeats(docs).select("doc_id", "n_removed").distinct().collect()
    assert {tuple(r) for r in got} == {(1, 60), (2, 60), (3, 0)}


def test_samples_count_a_repeated_row_once(spark):
    once = spark.createDataFrame([(i, "en" if i % 3 else "de") for i in range(3000)], "doc_id long, lang string")
    many = once.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(30)))).drop("copy")
    a, b = ({(r["doc_id"], r["lang"]) for r in least_by_hash(rows, "lang", 300).collect()} for rows in (once, many))
    assert a == b and len(a) == 600


SAME = [("doc_id", "long", None), ("piece", "int", 0), ("start", "long", 0), ("length", "long", 100), ("ids_crc32", "long", 1)]


def test_pieces_of_one_id_lie_in_all_shards(spark):
    rows = spark.range(30_000).select(*(F.lit(v).cast(kind).alias(name) for name, kind, v in SAME))
    table = stored(rows, "test-pieces")
    placed = op3_packing.pack(table, shard_pieces=3000)
    sizes = [r["count"] for r in placed.groupBy(F.col("sequence_id") % 10).count().collect()]
    assert len(sizes) == 10 and sum(sizes) == 30_000 and max(sizes) < 1.2 * 3000
