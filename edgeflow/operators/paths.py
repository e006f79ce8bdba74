"""Hop distances from a few sources."""

from pyspark.sql import functions as F

from edgeflow.operators.edges import vertices
from edgeflow.plans.hot import SLICE_ROWS, found_once, hot_keys, settled, slice_copies, slice_keys
from edgeflow.plans.shared import Rounds, keep

MERGE_ROUNDS = 10


def bfs_distances(G, sources, max_rounds=None, slice_rows=SLICE_ROWS):
    """Hops from each source to every vertex it reaches: (source, id, dist).

    A source that no edge touches gives no rows. Each round sends the frontier along the edges, puts
    what was seen before and what was reached into one aggregate, and writes the vertices that are
    new as the next frontier; it stops when nothing is new or after `max_rounds`. The edges stay
    partitioned by source vertex (and slice) over all rounds. Every MERGE_ROUNDS rounds the frontiers
    are merged into one table of seen vertices, so a long search does not read ever more files.
    """
    spark = G.sparkSession
    out_degrees = G.groupBy(F.col("src").alias("id")).agg(F.count(F.lit(1)).alias("n"))
    hot = found_once(hot_keys(out_degrees, slice_rows))
    edges = settled(G.select("src", "dst").distinct(), "src", hot, "dst", G.count())
    rounds = Rounds(spark, "bfs", "source bigint, id bigint")
    try:
        touched = edges.where(F.col("src").isin(*sources) | F.col("dst").isin(*sources))
        seeds = vertices(touched).where(F.col("id").isin(*sources))
        frontier = rounds.write(0, seeds.select(F.col("id").alias("source"), "id"))
        number, merged, first = 0, None, 0
        while not frontier.isEmpty() and (max_rounds is None or number < max_rounds):
            number += 1
            sent = slice_copies(frontier.withColumnRenamed("id", "src"), "src", hot)
            reached = sent.join(edges, slice_keys("src", hot)).select(
                "source", F.col("dst").alias("id"), F.lit(False).alias("seen")
            )
            before = rounds.read(*range(first, number))
            if merged is not None:
                before = before.unionByName(merged)
            if number - first == MERGE_ROUNDS:
                before = merged = keep(before, "bfs-seen")
                first = number
            both = before.withColumn("seen", F.lit(True)).unionByName(reached)
            both = both.groupBy("source", "id").agg(F.max("seen").alias("seen"))
            frontier = rounds.write(number, both.where(~F.col("seen")).select("source", "id"))
    finally:
        edges.unpersist()
        if hot is not None:
            hot.unpersist()
    return rounds.all().select("source", "id", F.col("round").alias("dist"))


def bfs_distances_wide(distances, sources, all_vertices):
    """One row per vertex, one column d_<source> per source; NULL where the source does not reach."""
    rows = distances.unionByName(all_vertices, allowMissingColumns=True)
    columns = [F.min(F.when(F.col("source") == s, F.col("dist"))).alias(f"d_{s}") for s in sources]
    return rows.groupBy("id").agg(*columns)


def eccentricity(distances):
    """The longest shortest path of each source: (source, dist)."""
    return distances.groupBy("source").agg(F.max("dist").alias("dist"))


def diameter_estimate(distances):
    """The longest shortest path over all sources: one row (diameter)."""
    return distances.agg(F.max("dist").alias("diameter"))


def farthest_vertex(distances):
    """The farthest vertex of each source, the smaller id on a tie: (source, id, dist)."""
    farthest = F.max(F.struct(F.col("dist"), (-F.col("id")).alias("neg"))).alias("far")
    return distances.groupBy("source").agg(farthest).select(
        "source", (-F.col("far.neg")).alias("id"), F.col("far.dist").alias("dist")
    )
