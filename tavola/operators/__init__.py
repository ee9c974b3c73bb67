"""Relational operators composed from Spark joins, aggregates and windows."""

from tavola.operators.asof import last_before, next_after
from tavola.operators.bitmaps import day_bitmaps, distinct_in_periods
from tavola.operators.hot import hot_keys
from tavola.operators.joins import (
    broadcast_if_small,
    enrich,
    estimated_bytes,
    fits_broadcast,
    lookup_names,
    splittable,
    unique_on,
)
from tavola.operators.multiset import adjust, adjust_tagged, copies_list, format_list, item_lists, joined_list, total_by_item
from tavola.operators.periods import in_any_period
from tavola.operators.quality import check_split, check_status, write_checked
from tavola.operators.ranges import dense_rank_in_ranges, with_position
from tavola.operators.ranking import dense_rank_of, first_by, keep_max_ties, rows_at_extreme, top_one
from tavola.operators.record_id import continue_record_seq, with_record_seq

__all__ = [
    "adjust",
    "adjust_tagged",
    "broadcast_if_small",
    "check_split",
    "check_status",
    "continue_record_seq",
    "copies_list",
    "day_bitmaps",
    "dense_rank_in_ranges",
    "dense_rank_of",
    "distinct_in_periods",
    "enrich",
    "estimated_bytes",
    "first_by",
    "fits_broadcast",
    "format_list",
    "hot_keys",
    "in_any_period",
    "item_lists",
    "joined_list",
    "keep_max_ties",
    "last_before",
    "lookup_names",
    "next_after",
    "rows_at_extreme",
    "splittable",
    "top_one",
    "total_by_item",
    "unique_on",
    "with_position",
    "with_record_seq",
    "write_checked",
]
