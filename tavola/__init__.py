"""tavola — order, delivery and loyalty analytics as lazy Spark DataFrame operators.

Every public operator is a function ``DataFrame(s) -> DataFrame`` built from Spark's own
joins, aggregates, windows and array functions; nothing runs until an action.
"""

from tavola.session import get_spark, materialize

__all__ = ["get_spark", "materialize"]
