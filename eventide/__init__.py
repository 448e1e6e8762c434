"""Activity analytics on Spark: event parsing, windowed per-user counts,
batch z-score anomaly grading, enrichment, keyed sinks and alert handling.

Every transformation is a DataFrame -> DataFrame function, so the same code
runs on a bounded table and inside a Structured Streaming micro-batch.
"""

__version__ = "0.1.0"
