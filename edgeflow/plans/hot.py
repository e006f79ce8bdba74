"""Joins on a vertex that may hold a large share of all rows.

A key is hot when it holds more than max(slice_rows, rows / HOT_KEYS) rows. Fewer than HOT_KEYS keys
can be hot whatever the data, so the table of hot keys is safe to broadcast. The rows of a hot key
are spread over slices and the one vertex row is copied to each slice: every task gets at most about
one slice of a key, and no row is lost or seen twice.
"""

from pyspark.sql import functions as F

from edgeflow.functions import spread
from edgeflow.plans.shared import partitions

HOT_KEYS = 1_000_000
SLICE_ROWS = 1_000_000


def slice_rows_of(sizes, slice_rows=SLICE_ROWS):
    """Rows a single slice may hold, given key sizes (id, n)."""
    total = sizes.agg(F.sum("n").alias("total")).scalar()
    share = F.call_function("div", total, F.lit(HOT_KEYS)) + 1
    return F.greatest(F.lit(slice_rows).cast("bigint"), share)


def hot_keys(sizes, slice_rows=SLICE_ROWS):
    """Hot keys of (id, n) with their number of slices: (id, slices)."""
    limit = slice_rows_of(sizes, slice_rows)
    return sizes.where(F.col("n") > limit).select(
        "id", F.call_function("div", F.col("n") + limit - 1, limit).cast("int").alias("slices")
    )


def found_once(hot):
    """Hot keys for a loop, worked out once: cached, or None if there are none."""
    hot = hot.persist()
    if not hot.isEmpty():
        return hot
    hot.unpersist()
    return None


def slice_keys(key, hot):
    """Join columns of rows that went through `with_slice` or `slice_copies`."""
    return [key] if hot is None else [key, "slice"]


def settled(rows, key, hot=None, by=None, size=0):
    """`rows`, at most `size`, cached for many joins on `key`: partitioned and sorted once, hot keys in slices."""
    keys = slice_keys(key, hot)
    sliced = with_slice(rows, key, hot, by)
    return sliced.repartition(partitions(rows.sparkSession, size), *keys).sortWithinPartitions(*keys).persist()


def _slices(rows, key, hot):
    marked = hot.select(F.col("id").alias(key), F.col("slices").alias("_slices"))
    return rows.join(F.broadcast(marked), key, "left"), F.col("_slices")


def with_slice(rows, key, hot, *by, name="slice"):
    """Add the slice of each row: 0 for a normal key, spread by `by` for a hot one.

    Without hot keys (None) there is no such column.
    """
    if hot is None:
        return rows
    marked, slices = _slices(rows, key, hot)
    number = F.when(slices.isNull(), F.lit(0)).otherwise(spread(slices, *by))
    return marked.withColumn(name, number).drop("_slices")


def slice_copies(rows, key, hot, name="slice"):
    """One copy of each row per slice of its key."""
    if hot is None:
        return rows
    marked, slices = _slices(rows, key, hot)
    numbers = F.sequence(F.lit(0), F.coalesce(slices, F.lit(1)) - 1)
    return marked.withColumn(name, F.explode(numbers)).drop("_slices")


def join_on_vertex(rows, key, vertices, hot, by, how="inner"):
    """rows ⋈ vertices on `key` (one vertex row per key), hot keys spread by the column `by`.

    The spread is even when `rows` are distinct in (key, by); a row keeps its slice when its task
    runs again.
    """
    return (
        with_slice(rows, key, hot, by)
        .join(slice_copies(vertices, key, hot), slice_keys(key, hot), how)
        .drop("slice")
    )
