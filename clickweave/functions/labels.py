"""Labels of products, areas and session bands."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from clickweave.functions.text import get_json_field

# Bands of a session's length in seconds, name, lowest, highest (None: open).
VISIT_BANDS = (
    ("1s_3s", 1, 3),
    ("4s_6s", 4, 6),
    ("7s_9s", 7, 9),
    ("10s_30s", 10, 30),
    ("30s_60s", 31, 60),
    ("1m_3m", 61, 180),
    ("3m_10m", 181, 600),
    ("10m_30m", 601, 1800),
    ("30m", 1801, None),
)

# Bands of a session's number of actions.
STEP_BANDS = (
    ("1_3", 1, 3),
    ("4_6", 4, 6),
    ("7_9", 7, 9),
    ("10_30", 10, 30),
    ("30_60", 31, 60),
    ("60", 61, None),
)

# Level of an area; any other area has the last level.
AREA_LEVELS = (
    ("A_Level", ("华北", "华东")),
    ("B_Level", ("华中", "华南")),
    ("C_Level", ("西南", "西北")),
)
OTHER_AREA_LEVEL = "D_Level"


def in_band(value: Column, low: int, high: int | None) -> Column:
    return value >= low if high is None else value.between(low, high)


def band_name(value: Column, bands: tuple) -> Column:
    """Name of the band a value lies in, null outside all of them."""
    names = [F.when(in_band(value, low, high), name) for name, low, high in bands]
    return F.coalesce(*names)


def visit_band(seconds: Column) -> Column:
    return band_name(seconds, VISIT_BANDS)


def step_band(steps: Column) -> Column:
    return band_name(steps, STEP_BANDS)


def product_status(extend_info: Column) -> Column:
    """'Self' for status 0, 'Third Party' for any other or none."""
    status = get_json_field(extend_info, "product_status")
    return F.when(status == "0", "Self").otherwise("Third Party")


def area_level(area: Column) -> Column:
    first, *rest = AREA_LEVELS
    start = F.when(area.isin(*first[1]), first[0])
    chain = reduce(lambda acc, level: acc.when(area.isin(*level[1]), level[0]), rest, start)
    return chain.otherwise(OTHER_AREA_LEVEL)
