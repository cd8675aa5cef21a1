"""Daily batch ledgers on Spark: scan, validate, post, snapshot, export, backfill and stream."""
