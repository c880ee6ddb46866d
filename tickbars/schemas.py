"""Declared schemas of messages, payloads and tables. Nothing is inferred."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# Tags and names carried in the data itself.
LIVE_SOURCE = "finnhub"
BACKFILL_SOURCE = "twelve_data"
DEFAULT_SYMBOLS = ("AAPL", "MSFT", "TSLA", "NVDA", "AMZN")
TICK_TOPIC = "market_ticks"
WATERMARK = "2 minutes"
CANDLE_WIDTH = "1 minute"
TRIGGER_INTERVAL = "10 seconds"
LOOKBACK_HOURS = 24

PRICE = T.DecimalType(18, 6)
PERCENT = T.DecimalType(10, 4)
RATE = T.DecimalType(18, 2)

# A message of the tick topic. `offset` orders messages of one symbol and breaks ties in time.
MESSAGE = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("offset", T.LongType()),
    ]
)

TICK_JSON = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("event_time", T.TimestampType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("volume", T.LongType()),
        T.StructField("source", T.StringType()),
    ]
)

@dataclass(frozen=True)
class TableSpec:
    """A keyed table: typed columns, primary key, text limits, defaults, partition source.

    `nullable` names the columns without a NOT NULL rule. `version` names the columns (with the digits
    they may take) that decide which of several rows with one key is current: the largest wins.
    """

    name: str
    columns: T.StructType
    key: tuple[str, ...]
    version: tuple[tuple[str, int], ...]
    limits: dict[str, int] = field(default_factory=dict)
    defaults: dict[str, object] = field(default_factory=dict)
    nullable: tuple[str, ...] = ("updated_at",)
    date_of: str | None = None

    @property
    def values(self) -> list[str]:
        return [c for c in self.columns.fieldNames() if c not in self.key]


def _columns(*pairs: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in pairs])


_OHLC = tuple((f"{name}_price", PRICE) for name in ("open", "high", "low", "close"))

# A writer's start in milliseconds, its batch number, and the write time in microseconds for a batch that
# is written again.
_WRITER_ORDER = (("run", 13), ("batch_id", 9), ("updated_at", 16))

CANDLES_1M = TableSpec(
    name="candles_1m",
    columns=_columns(
        ("symbol", T.StringType()),
        ("candle_start", T.TimestampType()),
        ("candle_end", T.TimestampType()),
        *_OHLC,
        ("volume", T.LongType()),
        ("trade_count", T.IntegerType()),
        ("vwap", PRICE),
        ("updated_at", T.TimestampType()),
    ),
    key=("symbol", "candle_start"),
    version=_WRITER_ORDER,
    limits={"symbol": 20},
    date_of="candle_start",
)

CANDLES_1H_BACKFILL = TableSpec(
    name="candles_1h_backfill",
    columns=_columns(
        ("symbol", T.StringType()),
        ("candle_start", T.TimestampType()),
        ("candle_end", T.TimestampType()),
        *_OHLC,
        ("volume", T.LongType()),
        ("source", T.StringType()),
        ("updated_at", T.TimestampType()),
    ),
    key=("symbol", "candle_start"),
    version=_WRITER_ORDER,
    limits={"symbol": 20, "source": 30},
    defaults={"source": LIVE_SOURCE},
    date_of="candle_start",
)

# Hours of live minutes, derived from `candles_1m`: whoever began to read the minutes last has seen all that the others have.
CANDLES_1H_LIVE = TableSpec(
    name="candles_1h_live",
    columns=_columns(
        ("symbol", T.StringType()),
        ("candle_start", T.TimestampType()),
        ("candle_end", T.TimestampType()),
        *_OHLC,
        ("volume", T.LongType()),
        ("updated_at", T.TimestampType()),
    ),
    key=("symbol", "candle_start"),
    version=(("updated_at", 19), ("run", 13)),
    limits={"symbol": 20},
    # An hour's volume can exceed its type; the summary adds up the others.
    nullable=("volume", "updated_at"),
    date_of="candle_start",
)

# Two writers refresh the summary (stream and backfill), so its newest `updated_at` wins; the
# writer's run only breaks a tie.
PAIR_ANALYSIS_24H = TableSpec(
    name="pair_analysis_24h",
    columns=_columns(
        ("symbol", T.StringType()),
        ("window_start", T.TimestampType()),
        ("window_end", T.TimestampType()),
        ("open_24h", PRICE),
        ("high_24h", PRICE),
        ("low_24h", PRICE),
        ("close_24h", PRICE),
        ("price_change", PRICE),
        ("price_change_pct", PERCENT),
        ("total_volume", T.LongType()),
        ("avg_volume_per_min", RATE),
        ("avg_price", PRICE),
        ("updated_at", T.TimestampType()),
    ),
    key=("symbol",),
    version=(("updated_at", 19), ("run", 19)),
    limits={"symbol": 20},
)
