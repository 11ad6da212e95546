"""Registered queries and the SQL each is compared with."""

from checks import (  # noqa: F401
    s01_sources,
    s02_columns_rows,
    s03_joins,
    s04_aggregates,
    s05_windows,
    s06_functions,
    s07_order_sets,
    s09_streams,
    s10_udfs,
    s11_merge_history,
    s12_plans,
    s13_quality,
    s14_layout,
)
from checks.registry import ORACLES, QUERIES  # noqa: F401
