"""The chain graph: i → i+1, but i → 0 where 3 divides i."""

from pyspark.sql import functions as F


def chain_edges(ids):
    """One chain edge per id of a vertex table with ids 1 … N: (src, dst)."""
    after = F.when(F.col("id") % 3 == 0, F.lit(0).cast("bigint")).otherwise(F.col("id") + 1)
    return ids.select(F.col("id").alias("src"), after.alias("dst"))


def chain_ranks(ids):
    """1/N for each of the N ids and 0.0 for the sink, vertex 0: (id, pr)."""
    n = ids.agg(F.count(F.lit(1)).cast("double")).scalar()
    sink = ids.sparkSession.range(1).select("id", F.lit(0.0).alias("pr"))
    return ids.select("id", (F.lit(1.0) / n).alias("pr")).unionByName(sink)


def chain_graph(spark, k):
    """The chain over k² vertices: (edges, ranks)."""
    ids = spark.range(1, k * k + 1)
    return chain_edges(ids), chain_ranks(ids)
