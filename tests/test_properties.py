"""Properties of the windowed counts and of the z-score."""

import math

import numpy as np
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from conftest import SF001
from eventide.operators import anomaly as AN
from eventide.plans import batch as B


def test_every_event_counted_once_per_tumbling_window(spark):
    events = spark.read.parquet(f"{SF001}/events.parquet").count()
    total = B.tumbling_count_5s(spark, SF001).agg(F.sum("event_count")).first()[0]
    assert total == events


def test_every_event_in_twelve_sliding_windows(spark):
    events = spark.read.parquet(f"{SF001}/events.parquet").count()
    total = B.sliding_count_1min(spark, SF001).agg(F.sum("event_count")).first()[0]
    assert total == 12 * events


def test_emitted_rows_have_z_above_three(spark):
    rows = B.anomalies_1min(spark, SF001).collect()
    assert rows and all(r["z_score"] > 3 for r in rows)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(min_value=1, max_value=50), min_size=1, max_size=40))
def test_zscore_matches_population_formula(spark, counts):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(counts)], "user_id int, event_count long")
    got = {r["user_id"]: r["z_score"] for r in AN.with_zscore(df).collect()}
    arr = np.array(counts, dtype=float)
    sd = arr.std()
    for i, c in enumerate(counts):
        if sd == 0 or math.isclose(sd, 0.0, abs_tol=1e-12):
            assert got[i] is None
        else:
            assert math.isclose(got[i], (c - arr.mean()) / sd, rel_tol=1e-9, abs_tol=1e-9)
    # a batch of n rows cannot exceed z = sqrt(n - 1)
    zs = [z for z in got.values() if z is not None]
    assert all(z <= math.sqrt(len(counts) - 1) + 1e-9 for z in zs)


def test_fixture_counts_sf001(spark):
    """Expected counts of FIXTURES section 4 at sf0.01."""
    from conftest import SF01

    def grades(counts):
        g = AN.grade(AN.with_zscore(counts))
        row = g.agg(
            F.count(F.lit(1)).alias("groups"), F.max("event_count").alias("max"),
            F.sum(F.when(g.is_anomaly & (g.severity == "high"), 1).otherwise(0)).alias("high"),
            F.sum(F.when(g.is_anomaly & (g.severity == "medium"), 1).otherwise(0)).alias("medium"),
            F.sum(F.when((g.event_count > 5) & ~F.coalesce(g.z_score > 3, F.lit(False)), 1).otherwise(0)).alias("capped"),
        ).first()
        return tuple(row)

    assert grades(B.tumbling_count_5s(spark, SF01)) == (10000, 1, 0, 0, 0)
    assert grades(B.sliding_count_1min(spark, SF01)) == (119922, 2, 78, 0, 0)
    assert grades(B.day_counts(spark, SF01)) == (4006, 10, 1, 31, 90)
