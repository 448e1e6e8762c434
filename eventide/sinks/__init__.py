"""Outputs: keyed tables (upsert / insert-ignore), per-batch JSON and
Parquet folders, Kafka topics and JDBC tables."""
