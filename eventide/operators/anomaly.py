"""Batch statistics, z-score, anomaly flag, severity and the emit filter.

Statistics are over all (window, user) rows of one batch. They come from
exact integer moments n, S = sum(c), Q = sum(c^2):
mean = S / n, stddev_pop = sqrt(n*Q - S^2) / n, so the result does not
depend on partitioning or summation order. The one-row moments are attached
to every row as a scalar subquery: Spark runs it once and reuses the count
shuffle it reads, so no row leaves its partition and nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import ANOMALY_THRESHOLD, Z_THRESHOLD

EXACT = "decimal(38,0)"

# Fixed values that must equal the reference's: severity cut points and the
# severities that leave the detector.
HIGH_Z = 5.0
MEDIUM_Z = 3.0
EMITTED_SEVERITIES = ("high", "medium")


def moments(counts: DataFrame, col: str = "event_count") -> DataFrame:
    """One row: n, s1 = sum(c), q = sum(c*c), exact."""
    c = F.col(col).cast(EXACT)
    return counts.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(c).alias("s1"),
        F.sum(c * c).alias("q"),
    )


def _spread(n: Column, s1: Column, q: Column) -> Column:
    """n*Q - S^2 = n^2 * variance, exact."""
    return n.cast(EXACT) * q - s1 * s1


def mean_col(n: Column, s1: Column) -> Column:
    return s1.cast("double") / n.cast("double")


def stddev_col(n: Column, s1: Column, q: Column) -> Column:
    return F.sqrt(_spread(n, s1, q).cast("double")) / n.cast("double")


def batch_stats(counts: DataFrame, col: str = "event_count") -> DataFrame:
    """One row: n, mean_event_count, stddev_event_count (population)."""
    m = moments(counts, col)
    n, s1, q = F.col("n"), F.col("s1"), F.col("q")
    return m.select(
        n,
        F.when(n > 0, mean_col(n, s1)).otherwise(F.lit(0.0)).alias("mean_event_count"),
        F.when(n > 0, stddev_col(n, s1, q)).otherwise(F.lit(0.0)).alias("stddev_event_count"),
    )


def _z_params(n: Column, s1: Column, q: Column) -> list[Column]:
    """mean, stddev and whether stddev > 0, from exact moments."""
    return [mean_col(n, s1).alias("mean"), stddev_col(n, s1, q).alias("sd"),
            (_spread(n, s1, q) > 0).alias("spread")]


def with_zscore(counts: DataFrame, col: str = "event_count", out: str = "z_score",
                stats=None) -> DataFrame:
    """Adds ``z_score`` = (c - mean) / stddev, null when stddev is 0.

    The exact integer work happens once, on the one-row moments; each row
    only does double arithmetic. ``stats`` is an already computed moments row
    (n, s1, q); without it the parameters come from a scalar subquery in the
    same plan (Spark runs it once and reuses the count shuffle it reads)."""
    if stats is None:
        m = moments(counts, col)
        p = m.select(F.struct(*_z_params(F.col("n"), F.col("s1"), F.col("q"))).alias("p")).scalar()
        mean, sd, spread = p.getField("mean"), p.getField("sd"), p.getField("spread")
    else:
        n = F.lit(int(stats["n"])).cast("long")
        s1 = F.lit(stats["s1"] if stats["s1"] is not None else 0).cast(EXACT)
        q = F.lit(stats["q"] if stats["q"] is not None else 0).cast(EXACT)
        mean, sd, spread = _z_params(n, s1, q)
    z = (F.col(col).cast("double") - mean) / sd
    return counts.withColumn(out, F.when(spread, z))


def anomaly_flag(z: Column, count: Column, anomaly_threshold: int = ANOMALY_THRESHOLD,
                 z_threshold: float = Z_THRESHOLD) -> Column:
    """count above the threshold, or z at/above the z threshold (null z never)."""
    return (count > F.lit(anomaly_threshold)) | F.coalesce(z >= F.lit(z_threshold), F.lit(False))


def severity(z: Column) -> Column:
    """high above 5, medium above 3, else low (null z is low)."""
    return (F.when(z > F.lit(HIGH_Z), F.lit("high"))
            .when(z > F.lit(MEDIUM_Z), F.lit("medium"))
            .otherwise(F.lit("low")))


def grade(scored: DataFrame, anomaly_threshold: int = ANOMALY_THRESHOLD,
          z_threshold: float = Z_THRESHOLD) -> DataFrame:
    """Adds is_anomaly and severity to rows that carry z_score."""
    z, c = F.col("z_score"), F.col("event_count")
    return scored.select("*", anomaly_flag(z, c, anomaly_threshold, z_threshold).alias("is_anomaly"),
                         severity(z).alias("severity"))


def emitted(graded: DataFrame) -> DataFrame:
    """Rows that leave the detector: anomalous and graded high or medium."""
    return graded.filter(F.col("is_anomaly") & F.col("severity").isin(*EMITTED_SEVERITIES))


def detect(counts: DataFrame, anomaly_threshold: int = ANOMALY_THRESHOLD,
           z_threshold: float = Z_THRESHOLD) -> DataFrame:
    """counts -> emitted anomalies with z_score and severity."""
    graded = grade(with_zscore(counts), anomaly_threshold, z_threshold)
    return emitted(graded).drop("is_anomaly")
