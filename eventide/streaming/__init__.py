"""Structured Streaming: the raw, archive and windowed-count queries, their
foreachBatch handlers, and the alert notifier."""
