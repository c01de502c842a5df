"""DataFrame operators; each takes and returns DataFrames and runs nothing."""

from farelake.operators.filters import (
    blank_values,
    drop_sentinel,
    require_non_null,
    slice_period,
    unmatched,
)
from farelake.operators.heavy import top_keys
from farelake.operators.joins import lookup_place, match, match_operations
from farelake.operators.measures import (
    duplicate_keys,
    match_coverage,
    route_frequency,
    row_counts,
    sort_by,
    top_routes,
    weighted_mean,
)
from farelake.operators.projections import cast_columns, promote_names, select_as
from farelake.operators.reduction import reduce_to_keys

__all__ = [
    "blank_values",
    "cast_columns",
    "drop_sentinel",
    "duplicate_keys",
    "lookup_place",
    "match",
    "match_coverage",
    "match_operations",
    "promote_names",
    "reduce_to_keys",
    "require_non_null",
    "route_frequency",
    "row_counts",
    "select_as",
    "slice_period",
    "sort_by",
    "top_keys",
    "top_routes",
    "unmatched",
    "weighted_mean",
]
