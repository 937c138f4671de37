"""Market-stream analytics on Spark: feeds, windowed indicators, history, metrics, alerts."""
