"""Operators on the edge table (src, dst); an edge means "src follows dst"."""

from pyspark.sql import functions as F

from edgeflow.functions import record, spread_fixed
from edgeflow.plans.hot import SLICE_ROWS, hot_keys, join_on_vertex

# Longest neighbour list kept in one row.
MAX_LIST = 10_000


def filter_max_id(G, max_id=None):
    """Edges with both ends below `max_id`; None keeps all."""
    if max_id is None:
        return G
    return G.where((F.col("src") < max_id) & (F.col("dst") < max_id))


def reverse_edges(G):
    return G.select(F.col("dst").alias("src"), F.col("src").alias("dst"))


def edge_endpoints(G):
    """Every edge under both of its ends: (id, other, dir). One scan."""
    ends = F.array(
        record(id=F.col("src"), other=F.col("dst"), dir=F.lit("out")),
        record(id=F.col("dst"), other=F.col("src"), dir=F.lit("in")),
    )
    return G.select(F.inline(ends))


def weighted(G):
    """Parallel edges as one row with their number: (src, dst, w)."""
    return G.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("w"))


def vertices(G):
    """Every vertex at either end of an edge: (id)."""
    return G.select(F.explode(F.array("src", "dst")).alias("id")).distinct()


def distinct_sources(G):
    """Every vertex with an outgoing edge: (id)."""
    return G.select(F.col("src").alias("id")).distinct()


def send_state(G, state, slice_rows=SLICE_ROWS):
    """Each edge with the state of its source vertex; `state` has one row per `id`.

    Parallel edges come as one row with their number `w`.
    """
    sizes = G.groupBy(F.col("src").alias("id")).agg(F.count(F.lit(1)).alias("n"))
    return join_on_vertex(
        weighted(G), "src", state.withColumnRenamed("id", "src"), hot_keys(sizes, slice_rows), "dst"
    )


def expand_neighbours(G, state, distances, slice_rows=SLICE_ROWS):
    """The state itself plus one message per edge, each distance one hop longer: (id, …, n).

    Equal messages from parallel edges come as one row with their number `n`. An unknown distance is
    NULL and stays NULL.
    """
    hop = [(F.col(c) + 1).alias(c) for c in distances]
    sent = send_state(G, state.select("id", *distances), slice_rows)
    messages = sent.select(F.col("dst").alias("id"), *hop, F.col("w").alias("n"))
    return state.select("id", *distances, F.lit(1).cast("bigint").alias("n")).unionByName(messages)


def _list_parts(rows, max_list):
    """Split the rows (id, other, …) of long lists into parts of about `max_list` neighbours."""
    sizes = rows.groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    parts = hot_keys(sizes, max_list)
    return (
        rows.join(F.broadcast(parts), "id", "left")
        .withColumn("part", spread_fixed(F.coalesce(F.col("slices"), F.lit(1)), F.col("other")))
        .drop("slices")
    )


def adjacency_lists(G, max_list=MAX_LIST):
    """Out-neighbours of each vertex: (id, part, nbrs array<struct<id, n>>), n = parallel edges.

    One row (part 0) per vertex, unless the vertex has more than `max_list` distinct neighbours:
    then its neighbours are spread over several parts, so no row or task holds an unbounded list.
    """
    rows = weighted(G).select(F.col("src").alias("id"), F.col("dst").alias("other"), "w")
    neighbour = record(id=F.col("other"), n=F.col("w"))
    return (
        _list_parts(rows, max_list)
        .groupBy("id", "part")
        .agg(F.sort_array(F.collect_list(neighbour)).alias("nbrs"))
    )


def in_out_neighbour_lists(G, max_list=MAX_LIST):
    """In- and out-neighbours of each vertex side by side: (id, part, ins, outs).

    Lists as in `adjacency_lists`; a vertex with more than `max_list` entries has several parts.
    """
    ends = F.array(
        record(id=F.col("src"), other=F.col("dst"), out=F.lit(True)),
        record(id=F.col("dst"), other=F.col("src"), out=F.lit(False)),
    )
    rows = weighted(G).select("w", F.inline(ends))
    neighbour = record(id=F.col("other"), n=F.col("w"))
    return (
        _list_parts(rows, max_list)
        .groupBy("id", "part")
        .agg(
            F.sort_array(F.collect_list(F.when(~F.col("out"), neighbour))).alias("ins"),
            F.sort_array(F.collect_list(F.when(F.col("out"), neighbour))).alias("outs"),
        )
    )
