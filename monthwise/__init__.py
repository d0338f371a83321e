"""Monthly sales forecasting on Spark: ingest, close months, build windows, score, upsert."""
