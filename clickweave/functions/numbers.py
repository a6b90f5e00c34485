"""Numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_up(value: Column, scale: int) -> Column:
    """Round half up on the decimal text of the value."""
    return F.round(value, scale)


def share(part: Column, total: Column, scale: int = 2) -> Column:
    """part / total rounded half up; 0 when the total is 0."""
    return F.coalesce(round_half_up(F.try_divide(part, total), scale), F.lit(0.0))
