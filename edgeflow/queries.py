"""One query per operator over the given tables: name → function of (spark, sf_dir).

Totals that can pass 2^63 are returned as decimal text, so that they stay exact in every client.
"""

from pyspark.sql import functions as F

import edgeflow as ef
from edgeflow.functions import weighted_list_text
from edgeflow.plans import keep, new_folder
from edgeflow.schema import exact
from edgeflow.tables import chain_ids, graph, nodes

SOURCES = [2, 3]
MANY_SOURCES = range(200)
RESTART, RESTART_DAMPING, TOLERANCE = [0, 1, 2, 3], 0.3, 1e-9
MAX_ID = 1000
K = 4
PR_ROUNDS = 10
DAMPING = 0.85

QUERIES = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def purchases(spark, sf_dir):
    return graph(spark, sf_dir, "purchases")


def supplies(spark, sf_dir):
    return graph(spark, sf_dir, "supplies")


def bag(df):
    """A bag of rows as distinct rows with their number."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("n"))


def text(df, *columns):
    return df.withColumns({c: F.col(c).cast("string") for c in columns})


def on_grid(df, column, bits=36):
    """Doubles as multiples of 2^-bits.

    Sums differ in their last digits with the order of adding. Ranks are often decimal fractions that
    end in a 5, which decimal rounding would send either way; they do not lie between two multiples.
    """
    grid = float(2**bits)
    return df.withColumn(column, F.round(F.col(column) * grid) / grid)


# Sources: the table goes out as text through a sink and comes back through the source.


@query
def scan_edges_csv(spark, sf_dir):
    path = new_folder(spark, "edges-csv")
    ef.write_delimited(purchases(spark, sf_dir), path, ",")
    return bag(ef.read_edges(spark, path))


@query
def scan_edges_text(spark, sf_dir):
    path = new_folder(spark, "edges-text")
    ef.write_delimited(supplies(spark, sf_dir), path, ",")
    return bag(ef.read_edges_text(spark, path))


@query
def scan_nodes_text(spark, sf_dir):
    path = new_folder(spark, "nodes-text")
    ef.write_delimited(nodes(spark, sf_dir, "orders"), path)
    return bag(ef.read_nodes(spark, path))


@query
def tagged_inputs(spark, sf_dir):
    followed = purchases(spark, sf_dir).select(F.col("dst").alias("id"))
    return bag(ef.tagged_union(node=nodes(spark, sf_dir, "orders"), edge=followed))


@query
def scan_centroid_seeds(spark, sf_dir):
    path = new_folder(spark, "seeds")
    seeds = ef.kmeans_seeds(ef.follower_count(purchases(spark, sf_dir)), K)
    ef.write_named({"first": seeds, "second/nested": seeds.select(F.col("centroid") + 1)}, path)
    return ef.read_centroid_seeds(spark, path)


@query
def roundtrip_tsv_counts(spark, sf_dir):
    path = new_folder(spark, "counts-tsv")
    ef.write_delimited(ef.follower_count(purchases(spark, sf_dir)), path, "\t")
    return ef.read_counts(spark, path)


@query
def adjacency_text_roundtrip(spark, sf_dir):
    path = new_folder(spark, "adjacency")
    lists = ef.adjacency_lists(purchases(spark, sf_dir))
    ef.write_adjacency(ef.initial_states(lists, *SOURCES), path)
    states = ef.read_adjacency(spark, path)
    return states.withColumn("nbrs", F.array_join(F.col("nbrs").cast("array<string>"), ","))


@query
def chain_graph_edges(spark, sf_dir):
    return ef.chain_edges(chain_ids(spark, sf_dir))


@query
def chain_graph_ranks(spark, sf_dir):
    return on_grid(ef.chain_ranks(chain_ids(spark, sf_dir)), "pr")


# Sinks: the result is written and its lines are read back.


def _lines(spark, path):
    return spark.read.option("recursiveFileLookup", True).text(path).withColumnRenamed("value", "line")


@query
def sink_tuple_text(spark, sf_dir):
    path = new_folder(spark, "tuples")
    ef.write_tuples(ef.follower_count(purchases(spark, sf_dir)), path)
    return _lines(spark, path)


@query
def sink_delimited_text(spark, sf_dir):
    path, separators = new_folder(spark, "delimited"), {"comma": ",", "dash": "-", "tab": "\t", "none": ""}
    counts = ef.follower_count(purchases(spark, sf_dir))
    for name, separator in separators.items():
        ef.write_delimited(counts, f"{path}/{name}", separator)
    read = {name: _lines(spark, f"{path}/{name}") for name in separators}
    return bag(ef.tagged_union(**read))


@query
def sink_named_outputs(spark, sf_dir):
    path = new_folder(spark, "named")
    result = _kmeans(spark, sf_dir)
    members = result.members.select("centroid", F.col("n").alias("value"))
    ef.write_named({"centroid": result.centroids.select("centroid"), "cluster": members}, path)
    read = {name: _lines(spark, f"{path}/{name}") for name in ("centroid", "cluster")}
    return bag(ef.tagged_union(**read))


@query
def sink_summary_line(spark, sf_dir):
    path = new_folder(spark, "summary")
    count = ef.triangle_count(supplies(spark, sf_dir), "preagg")
    ef.write_summary(count, path, triangles="Number of triangles")
    return _lines(spark, path)


# Edges.


@query
def filter_max_id(spark, sf_dir):
    return bag(ef.filter_max_id(purchases(spark, sf_dir), MAX_ID))


@query
def reverse_edges(spark, sf_dir):
    return bag(ef.reverse_edges(purchases(spark, sf_dir)))


@query
def edge_endpoints(spark, sf_dir):
    return bag(ef.edge_endpoints(purchases(spark, sf_dir)))


@query
def distinct_sources(spark, sf_dir):
    return ef.distinct_sources(purchases(spark, sf_dir))


@query
def expand_neighbours(spark, sf_dir):
    G = purchases(spark, sf_dir)
    start = [F.when(F.col("id") == s, F.lit(0)).alias(f"d_{s}") for s in SOURCES]
    state = ef.vertices(G).select("id", *start)
    columns = [f"d_{s}" for s in SOURCES]
    return ef.expand_neighbours(G, state, columns).groupBy("id", *columns).agg(F.sum("n").alias("n"))


@query
def adjacency_lists(spark, sf_dir):
    lists = ef.adjacency_lists(purchases(spark, sf_dir))
    return lists.withColumn("nbrs", weighted_list_text("nbrs"))


@query
def in_out_neighbour_lists(spark, sf_dir):
    lists = ef.in_out_neighbour_lists(purchases(spark, sf_dir))
    return lists.withColumns({c: weighted_list_text(c) for c in ("ins", "outs")})


# Counts.


@query
def follower_count(spark, sf_dir):
    return ef.follower_count(purchases(spark, sf_dir))


@query
def follower_count_grouped(spark, sf_dir):
    return ef.follower_count(purchases(spark, sf_dir), "grouped")


@query
def follower_count_all(spark, sf_dir):
    return ef.follower_count_all(purchases(spark, sf_dir), nodes(spark, sf_dir, "orders"))


@query
def degree_histogram(spark, sf_dir):
    return ef.degree_histogram(ef.follower_count(purchases(spark, sf_dir)))


@query
def two_path_cardinality(spark, sf_dir):
    return text(ef.two_path_cardinality(purchases(spark, sf_dir)), "two_paths")


# Paths of length two and triangles.


@query
def two_paths(spark, sf_dir):
    return text(ef.two_paths(purchases(spark, sf_dir)), "n")


@query
def triangle_rows(spark, sf_dir):
    return text(ef.triangle_rows(supplies(spark, sf_dir)), "n")


def _triangles(strategy):
    def run(spark, sf_dir):
        count = ef.triangle_count(supplies(spark, sf_dir), strategy)
        return text(count, "closed_walks", "triangles")

    return run


for _strategy in ("auto", "broadcast", "shuffle_merge", "shuffle_hash", "preagg"):
    QUERIES[f"triangle_count_{_strategy}"] = _triangles(_strategy)


@query
def triangle_count_max_id(spark, sf_dir):
    count = ef.triangle_count(ef.filter_max_id(purchases(spark, sf_dir), MAX_ID))
    return text(count, "closed_walks", "triangles")


@query
def closed_two_paths_semi(spark, sf_dir):
    return text(ef.closed_two_paths(supplies(spark, sf_dir)), "two_paths_closed", "triangles")


@query
def successor_lookup(spark, sf_dir):
    return ef.successor_lookup(purchases(spark, sf_dir))


@query
def two_path_metrics(spark, sf_dir):
    """Counters that fill while the follower table and the closed walks are written."""
    G = supplies(spark, sf_dir)
    products = F.sum(exact("n_in") * exact("n_out"))
    degrees, paths = ef.counted(
        ef.in_out_degrees(G), two_paths=F.coalesce(products, F.lit(0)), vertices=F.count(F.lit(1))
    )
    copies = exact("w1") * exact("w2") * exact("w3") * F.col("rotations")
    walks, closed = ef.counted(ef.closed_walks(G), closed=F.coalesce(F.sum(copies), F.lit(0)))
    path = new_folder(spark, "metrics")
    degrees.write.parquet(f"{path}/degrees")
    walks.write.parquet(f"{path}/walks")
    counters = {**paths.get, **closed.get}
    row = [(str(counters["two_paths"]), counters["vertices"], str(counters["closed"]))]
    return spark.createDataFrame(row, "two_paths string, vertices bigint, closed string")


# Ranks.


def _chain(spark, sf_dir):
    ids = chain_ids(spark, sf_dir)
    return ef.chain_pagerank(ef.chain_edges(ids), ef.chain_ranks(ids), iters=PR_ROUNDS)


@query
def rank_contributions(spark, sf_dir):
    ids = chain_ids(spark, sf_dir)
    received = ef.rank_contributions(ef.chain_edges(ids), ef.chain_ranks(ids))
    return on_grid(received, "pr")


@query
def left_outer_default_zero(spark, sf_dir):
    ids = chain_ids(spark, sf_dir)
    edges = ef.chain_edges(ids)
    received = ef.rank_contributions(edges, ef.chain_ranks(ids))
    return on_grid(ef.with_default_zero(ef.distinct_sources(edges), received), "pr")


@query
def pagerank_chain(spark, sf_dir):
    return on_grid(ef.last_round(_chain(spark, sf_dir), PR_ROUNDS), "pr")


@query
def pagerank_chain_trace(spark, sf_dir):
    return on_grid(ef.rank_trace(_chain(spark, sf_dir)), "total", 30)


@query
def pagerank_chain_top100(spark, sf_dir):
    ranks = on_grid(ef.last_round(_chain(spark, sf_dir), PR_ROUNDS), "pr")
    return ef.top_k(ranks, "pr", 100)


@query
def pagerank_edges(spark, sf_dir):
    ranks = ef.pagerank(purchases(spark, sf_dir), iters=PR_ROUNDS)
    return on_grid(ef.last_round(ranks, PR_ROUNDS), "pr")


@query
def pagerank_edges_damped(spark, sf_dir):
    ranks = ef.pagerank(supplies(spark, sf_dir), damping=DAMPING, iters=PR_ROUNDS)
    return on_grid(ef.last_round(ranks, PR_ROUNDS), "pr")


@query
def pagerank_residual(spark, sf_dir):
    found = ef.pagerank_residual(supplies(spark, sf_dir), RESTART_DAMPING, TOLERANCE, RESTART)
    return on_grid(found.ranks, "pr", 18)


# Hop distances.


def _distances(spark, sf_dir):
    return ef.bfs_distances(purchases(spark, sf_dir), SOURCES)


@query
def bfs_distances(spark, sf_dir):
    return _distances(spark, sf_dir)


@query
def bfs_distances_wide(spark, sf_dir):
    every = ef.vertices(purchases(spark, sf_dir))
    return ef.bfs_distances_wide(_distances(spark, sf_dir), SOURCES, every)


@query
def eccentricity(spark, sf_dir):
    return ef.eccentricity(_distances(spark, sf_dir))


@query
def diameter_estimate(spark, sf_dir):
    return ef.diameter_estimate(_distances(spark, sf_dir))


@query
def farthest_vertex(spark, sf_dir):
    return ef.farthest_vertex(_distances(spark, sf_dir))


# Searches from many sources, and what bounds of eccentricities tell.


def _many(spark, sf_dir):
    return ef.many_searches(purchases(spark, sf_dir), MANY_SOURCES)


@query
def many_source_distances(spark, sf_dir):
    return _many(spark, sf_dir).distances()


@query
def neighbourhood_sizes(spark, sf_dir):
    return _many(spark, sf_dir).hop_counts()


@query
def closeness_centrality(spark, sf_dir):
    return ef.closeness(_many(spark, sf_dir).hop_counts())


@query
def exact_extent(spark, sf_dir):
    return ef.exact_extent(supplies(spark, sf_dir)).by_component()


# K-means over follower counts.


def _counts_and_seeds(spark, sf_dir):
    counts = keep(ef.follower_count(purchases(spark, sf_dir)), "counts")
    return counts, [row.centroid for row in ef.kmeans_seeds(counts, K).collect()]  # K rows


def _kmeans(spark, sf_dir):
    return ef.kmeans_1d(*_counts_and_seeds(spark, sf_dir))


@query
def kmeans_seeds(spark, sf_dir):
    return ef.kmeans_seeds(ef.follower_count(purchases(spark, sf_dir)), K)


@query
def kmeans_assign(spark, sf_dir):
    return ef.kmeans_assign(*_counts_and_seeds(spark, sf_dir))


@query
def kmeans_pass_stats(spark, sf_dir):
    counts, seeds = _counts_and_seeds(spark, sf_dir)
    return text(ef.pass_stats(ef.degree_histogram(counts), seeds), "sse")


@query
def kmeans_centroids(spark, sf_dir):
    return text(_kmeans(spark, sf_dir).centroids, "sse")


@query
def kmeans_sse_trace(spark, sf_dir):
    return text(_kmeans(spark, sf_dir).trace, "sse")


@query
def kmeans_members(spark, sf_dir):
    return _kmeans(spark, sf_dir).members
