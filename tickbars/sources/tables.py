"""Keyed tables on Parquet with insert-or-replace semantics.

Plain Parquet has no MERGE, so an upsert appends the new rows and the reader keeps the newest version of
each key. A micro-batch therefore never rewrites or deletes data, a task or driver lost in the middle
leaves nothing half-replaced, and a batch replayed after a failure appends the same rows again, which
changes nothing. Each writer has a folder of its own, `run=<run>`, in which it alone commits, so the stream and a
backfill can write to one table at once. Below it time tables are split by `candle_date` only.

Rows that break a table rule are stored in the same write with a `reject_reason`, each by itself and below
`refused=true`. Readers prune them, so one bad row neither fails the batch nor replaces a good row; compacting copies them.

A reader names the folders it needs: those of the writers, and below them the dates of its window. It never lists the rest
of the tree, so what it costs to plan a read doesn't grow with the table's age.

A writer of many small batches merges its own files from time to time (`RunFiles`): the newest version of each key is
written once more to the same folder, and the files it came from go when they are old enough for any reader to have ended. A row
that stands in both has one key and one version, so readers see the same table before, while and after.
"""

from __future__ import annotations

import time
from collections.abc import Iterable
from dataclasses import dataclass, field
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickbars.functions import digit_order, latest_by_key, pair_order
from tickbars.operators.quality import REASON, accepted, check_rows, rejected
from tickbars.schemas import CANDLES_1H_BACKFILL, CANDLES_1H_LIVE, CANDLES_1M, PAIR_ANALYSIS_24H, TableSpec
from tickbars.session import use_utc

# A file of a micro-batch holds some of the symbols, from the whole alphabet, once each: neither its least and greatest symbol nor a
# dictionary tells that another is absent. Some 12 KB for each row group do.
_BLOOM = {"parquet.bloom.filter.enabled#symbol": "true", "parquet.bloom.filter.expected.ndv#symbol": "10000"}

_VERSION = [
    T.StructField(REASON, T.StringType()),
    T.StructField("batch_id", T.LongType()),
]


def _listed(spark: SparkSession, folder: str) -> list[str]:
    """Full names of what lies directly in a folder; none if it doesn't exist."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [status.getPath().toString() for status in files.listStatus(path)] if files.exists(path) else []


def _existing(spark: SparkSession, folders: Iterable[str]) -> list[str]:
    configuration = spark.sparkContext._jsc.hadoopConfiguration()
    paths = {name: spark._jvm.org.apache.hadoop.fs.Path(name) for name in folders}
    return [name for name, path in paths.items() if path.getFileSystem(configuration).exists(path)]


@dataclass(frozen=True)
class KeyedTable:
    path: str
    spec: TableSpec

    def create(self, spark: SparkSession) -> KeyedTable:
        """Create the empty table unless it exists."""
        columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in self._layout().fields]
        spark.range(0).select(*columns).write.mode("ignore").partitionBy("run", "refused", *self._split).parquet(self.path)
        return self

    @property
    def _split(self) -> list[str]:
        return [] if self.spec.date_of is None else ["candle_date"]

    def _layout(self) -> T.StructType:
        split = [T.StructField("run", T.LongType()), T.StructField("refused", T.BooleanType())]
        split += [T.StructField(name, T.DateType()) for name in self._split]
        return T.StructType([*self.spec.columns.fields, *_VERSION, *split])

    def upsert(
        self,
        rows: DataFrame,
        run: int,
        batch_id: int,
        order_by: Column | None = None,
        files: int | None = None,
        unique: bool = False,
    ) -> None:
        """Insert the rows, replacing the stored row of an equal key.

        `run` is the start time of the writer (> 0), `batch_id` counts its writes. Two writers of a table need different runs.
        Of the good rows of a batch with one key, the last by `order_by` (a whole number, never null) is stored; equal ones, or all without
        it, are ordered by a hash of their content, so the same one wins in every run, however the rows are dealt. Refused rows are
        all kept. `unique` skips this: the rows come grouped by key. Output files are sized at run time, which also splits a large date
        over several tasks; for a batch of known size, `files` skips that shuffle.
        """
        if not (0 <= run < 10**13 and 0 <= batch_id < 10**9):
            raise ValueError("run is in epoch milliseconds and batch_id below a billion")
        checked = check_rows(rows, self.spec)
        if not unique:
            # A refused row is its own key, so it neither meets nor hides another.
            each = F.when(F.col(REASON).isNotNull(), F.monotonically_increasing_id())
            content = F.pmod(F.xxhash64(*self.spec.columns.fieldNames()), F.lit(10**18))
            order = pair_order(F.lit(0) if order_by is None else order_by, content)
            checked = latest_by_key(checked.withColumn("refused_row", each), [*self.spec.key, REASON, "refused_row"], order)
        self._append(checked, run, batch_id, files)

    def _append(self, checked: DataFrame, run: int, batch_id: int, files: int | None = None) -> None:
        spec = self.spec
        stored = (
            checked.select(*spec.columns.fieldNames(), REASON)
            .withColumn("updated_at", F.coalesce("updated_at", F.current_timestamp()))
            .withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        )
        self._write(stored, run, files)

    def _write(self, stored: DataFrame, run: int, files: int | None, by_time: bool = False) -> None:
        use_utc(stored.sparkSession)
        stored = stored.withColumn("refused", F.col(REASON).isNotNull())
        if self._split:
            stored = stored.withColumn("candle_date", F.to_date(self.spec.date_of))
        if by_time and self._split:
            # Ranges of time, merged or not by size: the files of a large date hold different hours.
            stored = stored.repartitionByRange("refused", "candle_date", self.spec.date_of)
        else:
            stored = stored.hint("rebalance", *self._split) if files is None else stored.coalesce(files)
        # Sorted files let row-group statistics skip other symbols and times.
        stored = stored.sortWithinPartitions("refused", *self._split, *self.spec.key)
        writer = stored.write.mode("append").partitionBy("refused", *self._split)
        for name, value in _BLOOM.items():
            writer = writer.option(name, value)
        writer.parquet(f"{self.path}/run={run}")

    def folders(self, spark: SparkSession, refused: bool = False, days: Iterable[date] | None = None) -> list[str]:
        """The folders that hold good or refused rows, of all dates or of some. Only the writers' folders are listed."""
        runs = [name for name in _listed(spark, self.path) if name.rpartition("/")[2].startswith("run=")]
        below = [f"{name}/refused={str(refused).lower()}" for name in runs]
        if days is not None and self._split:
            below = [f"{name}/candle_date={day}" for name in below for day in days]
        return _existing(spark, below)

    def _stored(self, spark: SparkSession, refused: bool = False, days: Iterable[date] | None = None) -> DataFrame:
        return self._of(spark, self.folders(spark, refused, days))

    def _of(self, spark: SparkSession, names: list[str]) -> DataFrame:
        layout = self._layout()
        if not names:
            return spark.range(0).select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in layout.fields))
        return spark.read.schema(layout).option("basePath", self.path).parquet(*names)

    def rejects(self, spark: SparkSession) -> DataFrame:
        """Refused rows of all writes, with the reason."""
        return rejected(self._stored(spark, refused=True)).drop("refused")

    def versions(
        self, spark: SparkSession, since: Column | None = None, until: Column | None = None, days: Iterable[date] | None = None
    ) -> DataFrame:
        """All good stored versions with `run` and `batch_id`, pruned to dates of [since, until].

        With both bounds, or with `days`, the folders are known and nothing else is listed.
        """
        if days is None and since is not None and until is not None and self._split:
            # Bounds are literals or arithmetic on them; this runs no job.
            first, last = spark.sql("SELECT 1").select(F.to_date(since), F.to_date(until)).first()
            days = [first + timedelta(n) for n in range((last - first).days + 1)]
        rows = accepted(self._stored(spark, days=days).filter("NOT refused")).drop("refused")
        if since is not None:
            rows = rows.filter((F.col("candle_date") >= F.to_date(since)) & (F.col(self.spec.date_of) >= since))
        if until is not None:
            rows = rows.filter((F.col("candle_date") <= F.to_date(until)) & (F.col(self.spec.date_of) <= until))
        return rows

    def read(self, spark: SparkSession, since: Column | None = None, until: Column | None = None) -> DataFrame:
        """Current rows. For time tables, `since` / `until` (both inclusive) prune dates and row groups."""
        return self.current(self.versions(spark, since, until))

    def current(self, versions: DataFrame) -> DataFrame:
        """The newest of some versions of each key, with the table's columns."""
        return self._newest(versions).select(*self.spec.columns.fieldNames())

    def _newest(self, versions: DataFrame) -> DataFrame:
        times = [f.name for f in self.spec.columns.fields if isinstance(f.dataType, T.TimestampType)]
        parts = [(F.unix_micros(c) if c in times else F.col(c), digits) for c, digits in self.spec.version]
        return latest_by_key(versions, self.spec.key, digit_order(*parts))

    def compact(self, spark: SparkSession, target_path: str) -> KeyedTable:
        """Write the current rows, and all refused ones, as the base of a new table, for the writers to go on with.

        The base is run 0, so whatever is written to the new table later wins over it.
        """
        target = KeyedTable(target_path, self.spec).create(spark)
        current = self.read(spark).withColumn(REASON, F.lit(None).cast("string"))
        target._append(current.unionByName(self.rejects(spark).select(*current.columns)), run=0, batch_id=0)
        return target


@dataclass
class RunFiles:
    """The files of good rows that one writer has in a table, for that writer to merge between its batches.

    A folder (a date) is merged once it holds `LEAST` files that aren't merged yet. Merged files are deleted by the first merge that
    finds them `keep` seconds old, which must exceed the longest report. A writer that dies in between leaves files that its next start
    merges again. `wrote` tells which dates to look at; the first merge of a start, and one after dates unknown, looks at all of its own.
    """

    table: KeyedTable
    run: int
    keep: float = 3600
    merged: dict[str, float] = field(default_factory=dict)
    days: set[date] | None = None

    LEAST = 16

    def wrote(self, days: Iterable[date] | None) -> None:
        if days is None:
            self.days = None
        elif self.days is not None:
            self.days.update(days)

    def merge(self, spark: SparkSession) -> int:
        """Merge the crowded folders; the number of files merged."""
        self._delete(spark)
        table, top = self.table, f"{self.table.path}/run={self.run}/refused=false"
        if not table._split:
            names = [top]
        elif self.days is None:
            names = [n for n in _listed(spark, top) if n.rpartition("/")[2].startswith("candle_date=")]
        else:
            names = [f"{top}/candle_date={day}" for day in sorted(self.days)]
        files = {name: [f for f in _listed(spark, name) if f.endswith(".parquet") and f not in self.merged] for name in names}
        crowded = [f for held in files.values() if len(held) >= self.LEAST for f in held]
        if table._split:
            # Dates with few files wait for more.
            waiting = [name for name, held in files.items() if 1 < len(held) < self.LEAST]
            self.days = {date.fromisoformat(name.rpartition("=")[2]) for name in waiting}
        if crowded:
            own = table._of(spark, crowded)
            table._write(table._newest(own.drop("refused", REASON)).withColumn(REASON, F.lit(None).cast("string")).drop("run"), self.run, None, by_time=True)
            self.merged |= dict.fromkeys(crowded, time.monotonic())
        return len(crowded)

    def _delete(self, spark: SparkSession) -> None:
        hadoop = spark.sparkContext._jsc.hadoopConfiguration()
        old = [name for name, since in self.merged.items() if time.monotonic() - since >= self.keep]
        for name in old:
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(hadoop).delete(path, False)
            del self.merged[name]


@dataclass(frozen=True)
class MarketTables:
    """The three tables below one root folder, and the hourly states that the summary's refresh keeps of the first."""

    root: str

    @property
    def candles(self) -> KeyedTable:
        return KeyedTable(f"{self.root}/{CANDLES_1M.name}", CANDLES_1M)

    @property
    def backfill(self) -> KeyedTable:
        return KeyedTable(f"{self.root}/{CANDLES_1H_BACKFILL.name}", CANDLES_1H_BACKFILL)

    @property
    def hours(self) -> KeyedTable:
        return KeyedTable(f"{self.root}/{CANDLES_1H_LIVE.name}", CANDLES_1H_LIVE)

    @property
    def summary(self) -> KeyedTable:
        return KeyedTable(f"{self.root}/{PAIR_ANALYSIS_24H.name}", PAIR_ANALYSIS_24H)

    def create(self, spark: SparkSession) -> MarketTables:
        for table in (self.candles, self.backfill, self.summary):
            table.create(spark)
        return self

    def register_views(self, spark: SparkSession) -> None:
        """Expose the current rows under the table names, for plain `spark.sql` reports.

        A view knows the files of the moment; call again to see later batches.
        """
        for table in (self.candles, self.backfill, self.summary):
            table.read(spark).createOrReplaceTempView(table.spec.name)
