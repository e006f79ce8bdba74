"""Counts per vertex."""

from pyspark.sql import functions as F

from edgeflow.plans.hot import SLICE_ROWS, hot_keys
from edgeflow.schema import exact


def follower_count(G, strategy="partial", slice_rows=SLICE_ROWS):
    """Followers per vertex that has any: (id, n).

    "partial" counts on the map side before the shuffle. "grouped" ships every edge to its group and
    counts the collected group there; it is the slow contrast. Its groups are cut into slices of
    `slice_rows`, so a hot vertex is never one group.
    """
    if strategy == "partial":
        return G.groupBy(F.col("dst").alias("id")).agg(F.count(F.lit(1)).alias("n"))
    if strategy != "grouped":
        raise ValueError(f"unknown strategy: {strategy}")
    hot = F.broadcast(hot_keys(follower_count(G), slice_rows))
    # sorted first, so that a task that runs again gives every row its old slice
    numbered = G.sortWithinPartitions("dst", "src").select(
        F.col("dst").alias("id"), F.monotonically_increasing_id().alias("row")
    )
    turn = F.pmod(F.col("row"), F.coalesce(F.col("slices"), F.lit(1)))
    ones = numbered.join(hot, "id", "left").select(
        "id", turn.alias("slice"), F.lit(1).cast("bigint").alias("one")
    )
    grouped = ones.groupBy("id", "slice").agg(F.collect_list("one").alias("ones"))
    size = F.aggregate("ones", F.lit(0).cast("bigint"), lambda total, one: total + one)
    return grouped.select("id", size.alias("n")).groupBy("id").agg(F.sum("n").alias("n"))


def follower_count_all(G, nodes):
    """Followers per vertex, zero included: every node, and every followed vertex known or not."""
    zero = nodes.select("id", F.lit(0).cast("bigint").alias("one"))
    one = G.select(F.col("dst").alias("id"), F.lit(1).cast("bigint").alias("one"))
    return zero.unionByName(one).groupBy("id").agg(F.sum("one").alias("n"))


def degree_histogram(counts):
    """How many vertices have each count: (n, users)."""
    return counts.groupBy("n").agg(F.count(F.lit(1)).alias("users"))


def _end_counts(G):
    """(id, n_in) and (id, n_out): each reads one column of the edges and leaves by id."""
    return (
        G.groupBy(F.col(end).alias("id")).agg(F.count(F.lit(1)).alias(name))
        for end, name in (("dst", "n_in"), ("src", "n_out"))
    )


def in_out_degrees(G):
    """(id, n_in, n_out), parallel edges counted."""
    n_in, n_out = _end_counts(G)
    zero = F.lit(0).cast("bigint")
    counts = [F.coalesce(n, zero).alias(n) for n in ("n_in", "n_out")]
    return n_in.join(n_out, "id", "full").select("id", *counts)


def two_path_cardinality(G):
    """Number of paths of length two, from the degrees alone: one row (two_paths)."""
    n_in, n_out = _end_counts(G)
    paths = F.sum(exact("n_in") * exact("n_out"))
    return n_in.join(n_out, "id").agg(exact(F.coalesce(paths, F.lit(0))).alias("two_paths"))
