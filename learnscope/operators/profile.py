"""Cluster profiles: sizes, centroids, per-cluster distributions, z-scored
feature means across clusters, class x cluster pivot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import attach_one_row
from .stats import exact_quantiles, histogram, long_form


def cluster_sizes(df: DataFrame, cluster_col: str = "cluster") -> DataFrame:
    """AGG25 + SRT3: size and share per cluster, and its position by size."""
    c = df.groupBy(cluster_col).agg(F.count(F.lit(1)).alias("n"))
    tot = c.agg(F.sum("n").alias("__tot"))
    w = Window.partitionBy(F.lit(0)).orderBy(F.col("n").desc(), cluster_col)  # one row per cluster
    return attach_one_row(c, tot).withColumn("share", F.col("n") / F.col("__tot")).withColumn("position", F.row_number().over(w)).drop("__tot")


def cluster_centroids(df: DataFrame, cluster_col: str = "cluster", cols: Sequence[str] = ("pc1", "pc2")) -> DataFrame:
    """AGG26: mean coordinates per cluster."""
    return df.groupBy(cluster_col).agg(*[F.avg(c).alias(c) for c in cols])


def turns_box(df: DataFrame, cluster_col: str = "cluster", col: str = "qa_turns") -> DataFrame:
    """AGG27: per cluster mean/std/min/max and min-max-normalized quartiles
    (0.5 when the cluster's values are constant)."""
    g = df.groupBy(cluster_col).agg(
        F.avg(col).alias("mean"), F.stddev_samp(col).alias("std"), F.min(col).cast("double").alias("min"),
        F.max(col).cast("double").alias("max"))
    q = exact_quantiles(df, col, [cluster_col], [0.25, 0.5, 0.75]).groupBy(cluster_col).pivot("p", [0.25, 0.5, 0.75]).agg(F.first("value"))
    g = g.join(q, on=cluster_col, how="left")
    rng = F.col("max") - F.col("min")
    norm = [F.when(rng > 0, (F.col(f"`{p}`") - F.col("min")) / rng).otherwise(F.lit(0.5)).alias(n)
            for p, n in ((0.25, "q1_norm"), (0.5, "median_norm"), (0.75, "q3_norm"))]
    return g.select(cluster_col, "mean", "std", "min", "max", *norm)


def profile_z(df: DataFrame, cols: Sequence[str], cluster_col: str = "cluster") -> DataFrame:
    """AGG28: feature means per cluster, z-scored across clusters (sample
    std; 0 std -> 1e-8; a single cluster gives null)."""
    means = df.groupBy(cluster_col).agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in cols])
    lf = long_form(means, cols, [cluster_col]).withColumnRenamed("value", "mean")
    w = Window.partitionBy("feature")  # |clusters| rows per feature
    sd = F.stddev_samp("mean").over(w)
    sd = F.when(sd == 0, F.lit(1e-8)).otherwise(sd)
    return lf.withColumn("z", (F.col("mean") - F.avg("mean").over(w)) / sd)


def progress_hist(df: DataFrame, cluster_col: str = "cluster", col: str = "course_progress_ratio", bins: int = 20) -> DataFrame:
    """AGG29 + FLT13: per-cluster histogram of positive values, bin edges
    from each cluster's own range."""
    pos = df.filter(F.col(col) > 0)
    return histogram(pos, [col], bins=bins, by=[cluster_col])


def class_pivot(df: DataFrame, k: int, class_col: str = "class_id", cluster_col: str = "cluster") -> DataFrame:
    """AGG30: class x cluster counts, clusters 0..k-1 as columns, missing -> 0."""
    p = df.groupBy(class_col).pivot(cluster_col, list(range(k))).agg(F.count(F.lit(1)))
    return p.fillna(0, subset=[str(i) for i in range(k)])


def preview(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    """SRT3: the first ``n`` rows in the order of the given columns (nulls last),
    as a report shows them, with their ``position``. Each task sends ``n`` rows."""
    by = [F.asc_nulls_last(c) for c in order]
    return df.orderBy(*by).limit(n).withColumn("position", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*by)))
