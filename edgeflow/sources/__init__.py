from edgeflow.sources.chain import chain_edges, chain_graph, chain_ranks
from edgeflow.sources.text import (
    initial_states, parse_adjacency, read_adjacency, read_centroid_seeds, read_counts, read_edges,
    read_edges_text, read_nodes, tagged_union,
)

__all__ = [
    "chain_edges", "chain_graph", "chain_ranks", "initial_states", "parse_adjacency",
    "read_adjacency", "read_centroid_seeds", "read_counts", "read_edges", "read_edges_text",
    "read_nodes", "tagged_union",
]
