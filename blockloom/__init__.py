"""Event-log analytics on Spark: decoding, ranges, export, integrity checks and streams."""
