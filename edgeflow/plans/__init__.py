from edgeflow.plans.hot import (
    HOT_KEYS, SLICE_ROWS, found_once, hot_keys, join_on_vertex, settled, slice_copies, slice_keys,
    with_slice,
)
from edgeflow.plans.inspect import plan_text
from edgeflow.plans.shared import Rounds, drop_written, keep, new_folder, partitions

__all__ = [
    "HOT_KEYS", "SLICE_ROWS", "found_once", "hot_keys", "join_on_vertex", "settled",
    "slice_copies", "slice_keys", "with_slice", "plan_text", "Rounds", "drop_written", "keep", "new_folder", "partitions",
]
