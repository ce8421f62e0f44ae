"""barline: market-candle analytics on Spark.

Every stage is a plain ``DataFrame -> DataFrame`` function (or one Structured
Streaming query) so Catalyst sees the whole plan: raw candle messages are
validated and deduplicated, rolled up into hourly and daily candles, turned
into technical indicators, and modelled into a daily fact table and a
per-pair dimension, with data-quality checks, health counts and a run log.
"""

__version__ = "0.1.0"
