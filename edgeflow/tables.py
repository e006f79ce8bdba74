"""Edge and vertex tables taken from the given tables by projection alone.

Both graphs read two columns of every row of lineitem. `purchases` is sparse, has vertices without
in-edges and without out-edges and long paths; in `supplies` a few vertices receive all edges.
"""

from pyspark.sql import functions as F

from edgeflow.schema import edges_of

EDGE_COLUMNS = {"purchases": ("l_orderkey", "l_partkey"), "supplies": ("l_partkey", "l_suppkey")}
NODE_COLUMNS = {"orders": "o_orderkey", "part": "p_partkey"}


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def graph(spark, sf_dir, name):
    return edges_of(_table(spark, sf_dir, "lineitem"), *EDGE_COLUMNS[name])


def nodes(spark, sf_dir, table):
    return _table(spark, sf_dir, table).select(F.col(NODE_COLUMNS[table]).alias("id"))


def chain_ids(spark, sf_dir):
    """Ids 1 … N, one per part."""
    return nodes(spark, sf_dir, "part").select((F.col("id") + 1).alias("id"))
