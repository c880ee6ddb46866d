"""Splitting good rows from bad ones. Rejected rows keep a reason; nothing is dropped silently."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickbars.schemas import TableSpec

REASON = "reject_reason"

_REQUIRED = ("symbol", "event_time", "price", "volume")
#: All reasons of `check_ticks`.
TICK_REASONS = ("undecodable", *(f"missing {name}" for name in _REQUIRED), "event_time out of range")


def first_reason(checks: Sequence[tuple[Column, str]]) -> Column:
    """The label of the first check that fails the row, else null. A null check does not fail."""
    return F.coalesce(*(F.when(failed, F.lit(label)) for failed, label in checks))


def accepted(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col(REASON).isNull()).drop(REASON)


def rejected(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col(REASON).isNotNull())


def check_ticks(ticks: DataFrame, latest: Column | None = None) -> DataFrame:
    """Add `reject_reason` to decoded ticks.

    A tick from beyond `latest` is refused because it would drive the event-time watermark into
    the future and every later tick would then be dropped as late.
    """
    nothing = F.lit(True)
    for name in _REQUIRED:
        nothing = nothing & F.col(name).isNull()
    checks = [(nothing, "undecodable")]
    checks += [(F.col(name).isNull(), f"missing {name}") for name in _REQUIRED]
    if latest is not None:
        checks.append((F.col("event_time") > latest, "event_time out of range"))
    return ticks.withColumn(REASON, first_reason(checks))


def check_rows(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """Cast rows to the table's types and add `reject_reason` for NOT NULL, range and length rules.

    A value that cannot be held by its column type (number out of range, unreadable text) is told
    apart from a missing one. Columns absent from `rows` are filled with their default or null, and
    columns the table does not have are passed on.
    """
    checks, casts = [], []
    for f in spec.columns.fields:
        default = F.lit(spec.defaults.get(f.name)).cast(f.dataType)
        if f.name not in rows.columns:
            casts.append(default.alias(f.name))
            continue
        given = F.col(f.name)
        held = given if rows.schema[f.name].dataType == f.dataType else given.try_cast(f.dataType)
        casts.append(F.coalesce(held, default).alias(f.name) if f.name in spec.defaults else held.alias(f.name))
        if f.name not in spec.nullable and f.name not in spec.defaults:
            checks.append((given.isNull(), f"{f.name} is null"))
        if not isinstance(f.dataType, T.StringType):
            checks.append((given.isNotNull() & held.isNull(), f"{f.name} out of range"))
        if f.name in spec.limits:
            limit = spec.limits[f.name]
            checks.append((F.char_length(given.cast("string")) > limit, f"{f.name} longer than {limit}"))
    extra = [c for c in rows.columns if c not in spec.columns.fieldNames()]
    return rows.select(*casts, *extra, first_reason(checks).alias(REASON))


def key_violations(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with the number of rows."""
    return rows.groupBy(*key).agg(F.count(F.lit(1)).alias("row_count")).filter("row_count > 1")
