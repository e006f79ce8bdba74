from edgeflow.sinks.text import (
    adjacency_lines, write_adjacency, write_delimited, write_named, write_summary, write_tuples,
)

__all__ = [
    "adjacency_lines", "write_adjacency", "write_delimited", "write_named", "write_summary",
    "write_tuples",
]
