"""Optional predicates: each is None when its parameter is absent."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F

from clickweave.params import TaskParams


def number_between(value: Column, low: int | None, high: int | None) -> Column | None:
    """Within both bounds; off unless both are given."""
    return None if low is None or high is None else value.between(low, high)


def one_of(value: Column, allowed: Sequence) -> Column | None:
    return value.isin(*allowed) if allowed else None


def any_of(values: Column, allowed: Sequence, item_type: str) -> Column | None:
    """Some item of an array column is allowed."""
    if not allowed:
        return None
    return F.arrays_overlap(values, F.array(*[F.lit(a).cast(item_type) for a in allowed]))


def equal_to(value: Column, wanted: str | None) -> Column | None:
    return None if wanted is None else value == wanted


def conjunction(predicates: Iterable[Column | None]) -> Column:
    """All predicates that are on; true if none is. A null operand counts as false."""
    active = [F.coalesce(p, F.lit(False)) for p in predicates if p is not None]
    return reduce(and_, active) if active else F.lit(True)


def user_predicate(params: TaskParams) -> Column:
    """Age, profession, city and sex of the session's user."""
    return conjunction([
        number_between(F.col("age"), params.start_age, params.end_age),
        one_of(F.col("professional"), params.professionals),
        one_of(F.col("city"), params.cities),
        equal_to(F.col("sex"), params.sex),
    ])


def interest_predicate(params: TaskParams) -> Column:
    """Keywords and categories of the session, held as arrays."""
    return conjunction([
        any_of(F.col("keywords"), params.keywords, "string"),
        any_of(F.col("categories"), params.category_ids, "bigint"),
    ])
