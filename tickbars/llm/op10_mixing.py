"""Mixing sources to target weights, with DataFrame functions only.

Sources in code-point order (null last) weigh `WEIGHTS`, repeating, and share `SHARE` of all words. A target stops at
`MOST` times its source's size and the excess is reshared by weight, until none is above: every target is the lesser
of its stop and one level times its weight, and the level is found by a running sum over the sources.

Every document gets a hash-random key. A source's rows are dealt to ranges of the key; prefix sums over the ranges' totals
tell in which range a source's target ends. A source is taken whole as many times as its target holds it, and then in key order up
to the target exactly: ranges before the last are taken whole, later ones not at all, and the last range's rows are
sorted and added up one by one, so that its last document is taken in part.

Only those last ranges are shuffled with their texts, one of about `RANGE_ROWS` rows for each source, however large the corpus is. Other rows are judged
where they are read, by one stored row for each source, which Spark broadcasts if it is small enough. A hot source is split over as many ranges
as it needs. Prefix sums of the ranges' totals are taken in blocks of `BLOCK_RANGES`, and then over a source's blocks, which are
12,000 for 10**11 rows. Three windows over the sources themselves see one small row for each, all in one task: sources are
named collections, thousands and not millions.

Edge cases: an empty table gives no rows; a text that is null or without words has size 0 and nothing of it is taken;
a null doc_id comes first among equal keys, and rows that share one follow in the order of their size and text's hash;
extra columns are carried, whatever their names (but `_mix_*`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickbars.llm.texts import stored

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
RANGE_ROWS = 2_000
BLOCK_RANGES = 4_096
_KEY_DIGITS = 12


def targets(sizes: DataFrame) -> DataFrame:
    """(_mix_source, _mix_size, _mix_rows) -> the same with _mix_target; one row per source."""
    by_name = Window.orderBy(F.col("_mix_source").asc_nulls_last())
    everything = Window.partitionBy()
    ranked = sizes.withColumn("place", F.row_number().over(by_name) - 1)
    ranked = ranked.withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.pmod("place", F.lit(len(WEIGHTS))) + 1).cast("int")))
    stop = F.lit(MOST) * F.col("_mix_size")
    ranked = ranked.withColumns({"stop": stop, "reach": stop / F.col("weight"), "budget": F.lit(SHARE) * F.sum("_mix_size").over(everything)})
    # In the order in which sources reach their stops: the level if all before this one have stopped.
    by_reach = Window.orderBy("reach", "place")
    before = by_reach.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_reach.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    ranked = ranked.withColumn("level", (F.col("budget") - F.coalesce(F.sum("stop").over(before), F.lit(0))) / F.sum("weight").over(rest))
    fits = F.min(F.when(F.col("level") <= F.col("reach"), F.struct("reach", "place", "level"))).over(everything)["level"]
    return ranked.select(
        "_mix_source", "_mix_size", "_mix_rows", F.least(F.col("stop").cast("double"), F.coalesce(fits, F.col("reach")) * F.col("weight")).alias("_mix_target")
    )


def mix(docs: DataFrame, range_rows: int = RANGE_ROWS, block_ranges: int = BLOCK_RANGES) -> DataFrame:
    """The rows with _mix_words, _mix_size, _mix_target and _mix_taken."""
    words = F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
    key = F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), 1, _KEY_DIGITS)
    place = F.conv(key, 16, 10).cast("double") / float(16**_KEY_DIGITS)
    at = F.floor(place * F.ceil(F.col("_mix_rows") / range_rows))
    same_source = F.col("source").eqNullSafe(F.col("_mix_of"))
    counts = stored(docs.groupBy(F.col("source").alias("_mix_of")).agg(F.count(F.lit(1)).alias("_mix_rows")), "mixing-rows")
    dealt = docs.join(counts, same_source).select(F.col("source").alias("_mix_source"), at.alias("_mix_range"), words.alias("_mix_words"))
    ranges = dealt.groupBy("_mix_source", "_mix_range").agg(F.sum("_mix_words").alias("words"), F.count(F.lit(1)).alias("rows"))
    ranges = stored(ranges, "mixing-ranges")
    sources = targets(ranges.groupBy("_mix_source").agg(F.sum("words").alias("_mix_size"), F.sum("rows").alias("_mix_rows")))
    # Ranges are added up within blocks and the blocks' totals over the source, so no window has more than a block's ranges or a source's blocks.
    ranges = ranges.withColumn("block", F.floor(F.col("_mix_range") / block_ranges))
    blocks = ranges.groupBy(F.col("_mix_source").alias("of"), F.col("block").alias("at")).agg(F.sum("words").alias("words"))
    in_source = Window.partitionBy("of").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("of", "at", F.coalesce(F.sum("words").over(in_source), F.lit(0)).alias("blocks_before"))
    in_block = Window.partitionBy("_mix_source", "block").orderBy("_mix_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("ranges_before", F.coalesce(F.sum("words").over(in_block), F.lit(0)))
    ranges = ranges.join(blocks, F.col("_mix_source").eqNullSafe(F.col("of")) & (F.col("block") == F.col("at")))
    ranges = ranges.select(
        F.col("_mix_source").alias("_mix_of"), F.col("_mix_range").alias("_mix_cut"), (F.col("blocks_before") + F.col("ranges_before")).alias("_mix_earlier"), ranges["words"]
    )
    # For each source how often it is taken whole, what is left then, and the range in which that ends: none if no document has words.
    budget = F.round("_mix_target").cast("long")
    sources = sources.withColumn("_mix_times", F.when(F.col("_mix_size") > 0, F.floor(budget / F.col("_mix_size"))).otherwise(0))
    sources = sources.withColumn("_mix_left", budget - F.col("_mix_times") * F.col("_mix_size"))
    ends = (F.col("_mix_earlier") <= F.col("_mix_left")) & (F.col("_mix_left") < F.col("_mix_earlier") + F.col("words"))
    cuts = sources.join(ranges, F.col("_mix_source").eqNullSafe(F.col("_mix_of")) & ends, "left")
    cuts = cuts.select(F.col("_mix_source").alias("_mix_of"), "_mix_rows", "_mix_size", "_mix_target", "_mix_times", "_mix_left", "_mix_cut", "_mix_earlier")
    rows = docs.join(stored(cuts, "mixing-cuts"), same_source).withColumn("_mix_range", at)
    in_cut = F.col("_mix_range").eqNullSafe(F.col("_mix_cut"))
    whole = rows.filter(~in_cut).withColumn("_mix_words", words)
    whole = whole.withColumn("_mix_last", F.when(F.col("_mix_range") < F.col("_mix_cut"), F.col("_mix_words")).otherwise(0))
    parted = rows.filter(in_cut).withColumns({"_mix_words": words, "_mix_key": key, "_mix_tie": F.xxhash64("text")})
    in_range = Window.partitionBy("_mix_of", "_mix_range").orderBy("_mix_key", "doc_id", "_mix_words", "_mix_tie")
    before = F.col("_mix_earlier") + F.coalesce(F.sum("_mix_words").over(in_range.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parted = parted.withColumn("_mix_last", F.least(F.greatest(F.col("_mix_left") - before, F.lit(0)), F.col("_mix_words"))).drop("_mix_key", "_mix_tie")
    taken = (F.col("_mix_times") * F.col("_mix_words") + F.col("_mix_last")).cast("long")
    rows = whole.unionByName(parted).withColumn("_mix_taken", taken)
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns], "_mix_words", "_mix_size", "_mix_target", "_mix_taken")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: every document as many times as the mix takes it; one taken in part counts from a half on."""
    times = F.when(F.col("_mix_words") > 0, F.round(F.col("_mix_taken") / F.col("_mix_words"))).otherwise(0).cast("int")
    mixed = mix(docs).withColumn("_mix_copies", F.explode(F.array_repeat(F.lit(0), times)))
    return mixed.select(*[F.col(f"`{c}`") for c in docs.columns])


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    return mix(docs).select(
        "doc_id",
        F.col("_mix_words").alias("size"),
        F.col("_mix_size").alias("source_size"),
        F.round("_mix_target", 6).alias("target"),
        F.col("_mix_taken").alias("taken"),
    )


#: Resharing in rounds (one source at least stops in each but the last), not by the running sum above.
OP10_SQL = r"""
WITH RECURSIVE sized AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size, md5(coalesce(doc_id::VARCHAR, ''))[:12] AS key FROM documents
), sources AS (
    SELECT source, sum(size)::BIGINT AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS place FROM sized GROUP BY source
), weighed AS (
    SELECT source, source_size, [3, 1, 2][place + 1] AS weight, 1.5 * sum(source_size) OVER () AS budget FROM sources
), rounds AS (
    SELECT 0 AS step, source, source_size, weight, budget, FALSE AS stopped, budget::DOUBLE AS spare FROM weighed
    UNION ALL
    SELECT step + 1, source, source_size, weight, budget, stopped OR above,
           budget - sum(CASE WHEN stopped OR above THEN 2 * source_size ELSE 0 END) OVER ()
    FROM (
        SELECT *, NOT stopped AND spare * weight / sum(weight) FILTER (NOT stopped) OVER () > 2 * source_size AS above FROM rounds
    ) WHERE step <= (SELECT count(*) FROM weighed)
), goals AS (
    SELECT source, source_size, CASE WHEN stopped THEN 2.0 * source_size ELSE spare * weight / sum(weight) FILTER (NOT stopped) OVER () END::DOUBLE AS target
    FROM rounds WHERE step = (SELECT max(step) FROM rounds)
), placed AS (
    SELECT doc_id, size, source_size, target, round(target)::BIGINT AS budget,
           sum(size) OVER (PARTITION BY sized.source ORDER BY key, doc_id ROWS UNBOUNDED PRECEDING) - size AS before
    FROM sized JOIN goals ON sized.source IS NOT DISTINCT FROM goals.source
)
SELECT doc_id, size::BIGINT AS size, source_size, round(target, 6) AS target,
       CASE WHEN source_size = 0 THEN 0 ELSE (budget // source_size) * size + least(greatest(budget % source_size - before, 0), size) END::BIGINT AS taken
FROM placed
"""
