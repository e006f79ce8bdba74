from edgeflow.operators.degree import (
    degree_histogram, follower_count, follower_count_all, in_out_degrees, two_path_cardinality,
)
from edgeflow.operators.edges import (
    adjacency_lists, distinct_sources, edge_endpoints, expand_neighbours, filter_max_id,
    in_out_neighbour_lists, reverse_edges, send_state, vertices, weighted,
)
from edgeflow.operators.kmeans import kmeans_1d, kmeans_assign, kmeans_seeds, pass_stats
from edgeflow.operators.paths import (
    bfs_distances, bfs_distances_wide, diameter_estimate, eccentricity, farthest_vertex,
)
from edgeflow.operators.rank import (
    chain_pagerank, last_round, pagerank, pagerank_residual, rank_contributions, rank_trace, top_k,
    with_default_zero,
)
from edgeflow.operators.searches import closeness, exact_extent, many_searches
from edgeflow.operators.triangles import (
    closed_two_paths, closed_walks, counted, successor_lookup, triangle_count, triangle_rows,
    two_paths,
)

__all__ = [
    "adjacency_lists", "bfs_distances", "bfs_distances_wide", "chain_pagerank", "closed_two_paths",
    "closed_walks", "closeness", "counted", "degree_histogram", "diameter_estimate", "distinct_sources",
    "eccentricity", "edge_endpoints", "exact_extent", "expand_neighbours", "farthest_vertex",
    "filter_max_id", "follower_count", "follower_count_all", "in_out_degrees",
    "in_out_neighbour_lists", "kmeans_1d", "kmeans_assign", "kmeans_seeds", "last_round", "many_searches",
    "pagerank", "pagerank_residual", "pass_stats", "rank_contributions", "rank_trace", "reverse_edges",
    "send_state", "successor_lookup", "top_k", "triangle_count", "triangle_rows",
    "two_path_cardinality", "two_paths", "vertices", "weighted", "with_default_zero",
]
