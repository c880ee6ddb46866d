"""Market-tick analytics on Spark: ticks, candles, hourly coverage, 24h summaries and reports."""
