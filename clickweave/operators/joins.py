"""How the sides of a join reach each other."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 100_000


def broadcast_below(rows: DataFrame, at_most: int) -> DataFrame:
    """Hint a broadcast if the relation holds `at_most` narrow rows and that is small.

    Beyond the limit the join is left to Catalyst and AQE, which shuffle it if need be.
    """
    return F.broadcast(rows) if at_most <= BROADCAST_ROWS else rows


def keys_to_match(rows: DataFrame, key: str) -> DataFrame:
    """The keys of a semi or anti join, free of the partitioning that made them.

    AQE splits a hot key of the other side only if both sides are shuffled for the join itself.
    Keys fresh from a grouping are already in place and would keep the hot key in one task, so they
    are spread again; they are few against the rows they select.
    """
    return rows.select(key).hint("rebalance")
