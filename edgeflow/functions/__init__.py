from edgeflow.functions.columns import (
    div_trunc, nearest, record, spread, spread_fixed, weighted_list_text,
)

__all__ = ["div_trunc", "nearest", "record", "spread", "spread_fixed", "weighted_list_text"]
