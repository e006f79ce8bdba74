"""K-means over one integer column.

Only the value of a row decides its cluster, so the passes run on the histogram of the values; the
rows are labelled once, after the last pass.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgeflow.functions import div_trunc, nearest
from edgeflow.operators.degree import degree_histogram
from edgeflow.plans.shared import keep
from edgeflow.schema import exact

MAX_PASSES = 11


def kmeans_seeds(values, k):
    """k evenly spaced seeds from the smallest to the largest value: (centroid)."""
    if k < 2:
        raise ValueError("k must be at least 2")
    lo, hi, i = F.col("lo"), F.col("hi"), F.col("i")
    return (
        values.agg(F.min("n").alias("lo"), F.max("n").alias("hi"))
        .where(lo.isNotNull())
        .select("lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("i"))
        .select((lo + div_trunc((hi - lo) * i, F.lit(k - 1))).cast("bigint").alias("centroid"))
    )


def kmeans_assign(values, centroids):
    """Each row with its nearest centroid; the smaller one wins a tie."""
    return values.withColumn("centroid", nearest(F.col("n"), centroids))


def pass_stats(histogram, centroids):
    """One pass over (n, users): (old, centroid, members, sse).

    The new centroid is the truncated mean without its sign; the squared error is taken against the
    old one. A centroid that attracts nothing gives no row.
    """
    old, users = F.col("old"), F.col("users")
    gap = exact(F.col("n") - old)
    mean = div_trunc(F.sum(exact("n") * exact(users)), F.sum(users))
    return (
        histogram.withColumn("old", nearest(F.col("n"), centroids))
        .groupBy("old")
        .agg(
            F.abs(mean).cast("bigint").alias("centroid"),
            F.sum(users).alias("members"),
            exact(F.sum(gap * gap * exact(users))).alias("sse"),
        )
    )


@dataclass(frozen=True)
class KMeansResult:
    centroids: DataFrame  # (old, centroid, members, sse) of the last pass
    trace: DataFrame  # (pass, sse, changed), one row per pass
    members: DataFrame  # the input rows with the centroid of their cluster


def kmeans_1d(values, seeds, max_passes=MAX_PASSES):
    """K-means over the column `n` of `values` from the given seeds, a list or a table (centroid).

    Runs at least two passes and at most `max_passes`, and stops after a pass that changes no
    centroid. Clusters that reach the same centroid are one cluster in the next pass.
    """
    spark = values.sparkSession
    histogram = keep(degree_histogram(values), "kmeans-histogram")
    if isinstance(seeds, DataFrame):
        seeds = [row.centroid for row in seeds.select("centroid").distinct().collect()]
    current, passes = sorted(set(seeds)), []
    for number in range(1, max_passes + 1):
        stats = pass_stats(histogram, current).collect()  # at most one row per centroid
        changed = sum(row.old != row.centroid for row in stats)
        passes.append((number, sum(row.sse for row in stats), changed))
        final, moved = stats, {row.old: row.centroid for row in stats}
        used, current = current, sorted(set(moved.values()))
        if not stats or (number > 1 and changed == 0):
            break
    old = nearest(F.col("n"), used)
    label = F.lit(None).cast("bigint")
    for before, after in moved.items():
        label = F.when(old == before, F.lit(after).cast("bigint")).otherwise(label)
    return KMeansResult(
        spark.createDataFrame(final, "old bigint, centroid bigint, members bigint, sse decimal(38,0)"),
        spark.createDataFrame(passes, "pass int, sse decimal(38,0), changed bigint"),
        values.withColumn("centroid", label),
    )
