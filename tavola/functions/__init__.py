"""Column-level building blocks (pure ``Column -> Column`` expressions, JVM-side)."""

from tavola.functions.clean import (
    is_numeric,
    nullify_sentinels,
    numeric_cast,
    strip_units,
    to_decimal,
    to_int,
)
from tavola.functions.lists import csv_items, csv_part
from tavola.functions.numeric import round_ratio, to_money
from tavola.functions.timeutil import minutes_between, monday_week_of_year, weekday_name

__all__ = [
    "csv_items",
    "csv_part",
    "is_numeric",
    "minutes_between",
    "monday_week_of_year",
    "nullify_sentinels",
    "numeric_cast",
    "round_ratio",
    "strip_units",
    "to_decimal",
    "to_int",
    "to_money",
    "weekday_name",
]
