"""DataFrame operators: windowed counts, batch statistics and anomaly
grading, enrichment, keyed merges, natural-key dedup, store constraints,
audit records and the log tail."""
