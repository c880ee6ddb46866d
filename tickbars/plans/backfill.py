"""Loading hourly vendor bars and counting what was loaded."""

from __future__ import annotations

import time
from collections.abc import Iterable
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tickbars.functions import instant, lookback_start
from tickbars.operators.filters import in_universe
from tickbars.operators.quality import REASON
from tickbars.plans.summary import refresh_summary
from tickbars.schemas import LOOKBACK_HOURS
from tickbars.sources.tables import MarketTables
from tickbars.sources.vendor import all_bars, backfill_rejects


def load_summary(bars: DataFrame, universe: DataFrame | Iterable[str]) -> DataFrame:
    """Loaded rows per configured symbol (0 when it has none) and, with a null symbol, in total.

    Counted before the join, so a symbol with very many bars is one row there.
    """
    if not isinstance(universe, DataFrame):
        spark = bars.sparkSession
        universe = spark.createDataFrame([(s,) for s in universe], "symbol STRING")
    counts = bars.groupBy("symbol").agg(F.count(F.lit(1)).alias("loaded"))
    return (
        universe.select("symbol")
        .distinct()
        .join(counts, "symbol", "left")
        .rollup("symbol")
        .agg(F.sum(F.coalesce("loaded", F.lit(0))).alias("loaded_rows"))
    )


@dataclass(frozen=True)
class BackfillResult:
    """What a load did, read from where it is stored: rows per symbol, and refused payloads and bars. `observed` counted them as they were written."""

    counts: DataFrame
    rejects: DataFrame
    observed: dict[str, int]


GOOD, REFUSED, OUTSIDE = "good", "refused", "outside"


def sorted_bars(bars: DataFrame, start: Column, end: Column) -> DataFrame:
    """With `kind`: good bars that start in [start, end), good ones outside of it, and refused ones."""
    inside = (F.col("candle_start") >= start) & (F.col("candle_start") < end)
    kind = F.when(F.col(REASON).isNotNull(), REFUSED).when(inside, GOOD).otherwise(OUTSIDE)
    return bars.withColumn("kind", kind)


def land_bars(bars: DataFrame, path: str) -> dict[str, int]:
    """Write sorted bars, a folder for each kind, and count them in the same pass."""
    kind, whole = F.col("kind"), F.col("position").isNull()
    seen = Observation()
    counted = bars.observe(
        seen,
        F.count_if(kind == GOOD).alias("accepted"),
        F.count_if(kind == OUTSIDE).alias("outside"),
        F.count_if((kind == REFUSED) & ~whole).alias("refused_bars"),
        F.count_if((kind == REFUSED) & whole).alias("refused_payloads"),
    )
    counted.write.mode("overwrite").partitionBy("kind").parquet(path)
    return {name: int(n or 0) for name, n in seen.get.items()}


def load_backfill(
    spark: SparkSession,
    payloads: DataFrame,
    tables: MarketTables,
    universe: DataFrame | Iterable[str],
    as_of: Column | datetime | str | None = None,
    hours: int = LOOKBACK_HOURS,
    run: int | None = None,
) -> BackfillResult:
    """Bars of the trailing window -> `candles_1h_backfill` -> refreshed summary.

    Only configured symbols are loaded. A payload that failed is reported and the others are loaded. Bars of one
    symbol and start replace each other in payload order. Payloads are decoded once, in the pass that lands their bars below
    `backfill_runs/run=<run>/bars` next to the tables and counts them; the upsert, the counts and the rejects read those files,
    and nothing is held in memory.
    """
    end = instant(datetime.now(timezone.utc) if as_of is None else as_of)
    run = run or int(time.time() * 1000)
    tables.create(spark)
    outcome = f"{tables.root}/backfill_runs/run={run}"
    bars = sorted_bars(all_bars(in_universe(payloads, universe)), lookback_start(end, hours), end)
    observed = land_bars(bars, f"{outcome}/bars")
    landed = spark.read.schema(bars.schema).parquet(f"{outcome}/bars")
    good = landed.filter(F.col("kind") == GOOD).drop("kind", REASON, "datetime")
    tables.backfill.upsert(good, run, 0, order_by=F.col("position"))
    load_summary(good, universe).write.mode("overwrite").parquet(f"{outcome}/counts")
    refresh_summary(spark, tables, run, 0, end)
    return BackfillResult(spark.read.parquet(f"{outcome}/counts"), backfill_rejects(landed.filter(F.col("kind") == REFUSED)), observed)
