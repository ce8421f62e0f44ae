"""DataFrame -> DataFrame operators: staging, candles, indicators, dedupe, marts."""
