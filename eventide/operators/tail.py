"""Log tail: newest records at or after a cursor, shown oldest first; and a
reader that follows the whole log without skipping."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def tail_log(log: DataFrame, cursor, n: int = 10, ts_col: str = "logged_at",
             tiebreak: str | Sequence[str] | None = None) -> DataFrame:
    """Up to ``n`` newest rows with ``ts_col >= cursor`` (inclusive, so the
    boundary record repeats on the next poll), ascending, plus ``next_cursor``
    = the newest time on the page. The top-n is a per-partition take-ordered
    merge; only the n-row page is ordered again."""
    columns = [ts_col, *([tiebreak] if isinstance(tiebreak, str) else tiebreak or [])]
    order = [F.col(c).desc() for c in columns]
    page = log.filter(F.col(ts_col) >= F.lit(cursor)).orderBy(*order).limit(n)
    page = page.withColumn("next_cursor", F.max(ts_col).over(Window.partitionBy()))
    return page.orderBy(*columns)


def next_page(log: DataFrame, after: dict | None, order: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows behind ``after`` (values of the ``order`` columns),
    oldest first: nothing is skipped however many rows came in between. The
    order must tell any two rows apart, and hold no nulls."""
    if after is not None:
        types = dict(log.dtypes)
        place = [F.lit(after[c]).cast(types[c]) for c in order]
        # the bound on the first column alone can be pushed to the scan
        log = log.filter((F.col(order[0]) >= place[0]) & (F.struct(*order) > F.struct(*(
            v.alias(c) for v, c in zip(place, order, strict=True)))))
    return log.orderBy(*order).limit(n)


class LogTail:
    """Reads a growing log page by page, with a cursor that outlives the reader.

    The cursor is a one-row JSON table in its own folder, replaced after the
    page was handed out; a reader that dies in between sees the page again."""

    def __init__(self, log: DataFrame, cursor_path: str, order: Sequence[str], settle_seconds: float = 0.0):
        self.spark: SparkSession = log.sparkSession
        self.path, self.order = cursor_path, list(order)
        # records become visible a little after their time: younger ones wait for the next poll
        self.log = log if not settle_seconds else log.filter(
            F.col(self.order[0]) < F.current_timestamp() - F.make_dt_interval(secs=F.lit(settle_seconds)))

    def cursor(self) -> dict | None:
        from pyspark.errors import AnalysisException
        try:
            rows = self.spark.read.text(self.path).collect()  # one row
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        return json.loads(rows[0][0]) if rows else None

    def poll(self, n: int = 10) -> list:
        """The next ``n`` records at most (a bounded page), oldest first."""
        # times as text of the session's zone, to the microsecond
        place = F.to_json(F.struct(*(F.col(c).cast("string").alias(c) for c in self.order))).alias("_place")
        page = next_page(self.log, self.cursor(), self.order, n).select("*", place).collect()
        if page:
            self.spark.createDataFrame([(page[-1]["_place"],)], "value string").coalesce(1).write.mode("overwrite").text(self.path)
        return page
