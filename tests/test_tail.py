"""Log tail: newest n at/after the cursor, oldest first, inclusive cursor."""

import datetime as dt

from pyspark.sql import functions as F

from eventide.operators.tail import tail_log

T0 = dt.datetime(2024, 1, 1)


def test_tail_pages_and_cursor(spark):
    rows = [(i, T0 + dt.timedelta(seconds=i)) for i in range(30)]
    log = spark.createDataFrame(rows, "id long, logged_at timestamp")
    page = tail_log(log, T0 + dt.timedelta(seconds=5), n=10).collect()
    assert [r["id"] for r in page] == list(range(20, 30))
    cursor = page[0]["next_cursor"]
    assert cursor == T0 + dt.timedelta(seconds=29)
    again = tail_log(log, cursor, n=10).collect()
    assert [r["id"] for r in again] == [29]  # boundary record repeats
    assert tail_log(log.filter(F.col("id") < 0), T0, n=10).count() == 0
