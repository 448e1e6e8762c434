"""Per-user event counts in tumbling and sliding event-time windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import WindowSpec


def window_counts(events: DataFrame, length: str, slide: str | None = None, *,
                  time_col: str = "event_time", key: str = "user_id",
                  watermark: str | None = None) -> DataFrame:
    """(window struct, key) -> event_count.

    Every form feeds a partial (map-side) hash aggregate, so a hot key is
    combined before a shuffle. With ``watermark`` it is a stateful streaming
    aggregate over ``window()`` that drops late rows and evicts finished
    windows. On bounded input a sliding window counts panes of its slide first:
    ``window()`` then expands a pane's count to the windows that cover it, not
    every event, so the expansion does not grow with how often a user acts, and
    follows a shuffle that spreads it. A pane lies within all windows that its
    events are in, as long as the length is a multiple of the slide; other
    lengths count the events themselves.
    """
    slide = slide or length
    df = events.select(key, time_col)
    if watermark:
        df = df.withWatermark(time_col, watermark)
    elif slide != length and _whole_panes(df, length, slide):
        return _pane_counts(df, length, slide, time_col, key)
    win = F.window(F.col(time_col), length, slide)
    return df.groupBy(win.alias("window"), F.col(key)).agg(F.count(F.lit(1)).alias("event_count"))


def _whole_panes(df: DataFrame, length: str, slide: str) -> bool:
    """Whether the length is a multiple of the slide (Spark reads the durations;
    intervals of months have no fixed length and are no windows either)."""
    micros = "unix_micros(timestamp'1970-01-01 00:00:00 UTC' + INTERVAL {})"
    one, other = df.sparkSession.sql(f"SELECT {micros.format(length)}, {micros.format(slide)}").first()  # folded: no job
    return other > 0 and one % other == 0


def _pane_counts(df: DataFrame, length: str, slide: str, time_col: str, key: str) -> DataFrame:
    pane = F.window(F.col(time_col), slide).start
    # the filter, which window() would add above, lets a plan that reads the counts twice reuse this shuffle
    panes = df.groupBy(pane.alias("pane"), F.col(key)).agg(F.count(F.lit(1)).alias("n")).filter(F.col("pane").isNotNull())
    win = F.window(F.col("pane"), length, slide)
    return panes.groupBy(win.alias("window"), F.col(key)).agg(F.sum("n").alias("event_count"))


def flatten_window(counts: DataFrame, key: str = "user_id") -> DataFrame:
    """Window struct -> window_start, window_end columns."""
    return counts.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        F.col(key),
        F.col("event_count"),
    )


def counts_for(events: DataFrame, spec: WindowSpec, streaming: bool = False) -> DataFrame:
    """Flat counts for one configured window; watermarked when streaming."""
    counts = window_counts(events, spec.length, spec.slide, watermark=spec.watermark if streaming else None)
    return counts if streaming else flatten_window(counts)
