"""Text, comma lists and `key=value` records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit("")) == ""


def is_not_empty(text: Column) -> Column:
    return ~is_empty(text)


def empty_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def id_list(text: Column) -> Column:
    """A comma list of ids as ARRAY<BIGINT>; parts that are no number are left out."""
    ids = F.transform(F.split(text, ","), lambda part: F.trim(part).try_cast("bigint"))
    return F.array_compact(ids)


def join_list(items: Column) -> Column:
    """Array items in order, joined by commas; null when there are none."""
    return empty_to_null(F.array_join(items, ","))


def join_sorted(items: Column) -> Column:
    """Array items sorted by value, joined by commas; null when there are none."""
    return join_list(F.array_sort(items))


def trim_comma(text: Column) -> Column:
    """Drop one leading and one trailing comma."""
    return F.regexp_replace(text, "^,|,$", "")


def pad2(text: Column) -> Column:
    """Keep two-character text, put a zero before any other."""
    return F.when(F.length(text) == 2, text).otherwise(F.concat(F.lit("0"), text))


def concat_long_string(number: Column, text: Column, separator: str = ":") -> Column:
    return F.concat_ws(separator, number.cast("string"), text)


def group_concat_distinct(text: Column) -> Column:
    """Aggregate: the distinct values of a group, sorted and joined by commas."""
    return join_sorted(F.collect_set(text))


def get_json_field(json: Column, field: str) -> Column:
    return F.get_json_object(json, f"$.{field}")


def get_field(record: Column, field: str, separator: str = "|") -> Column:
    """Value of a field in `a=1|b=2`; null if absent, empty or holding a further `=`."""
    pairs = F.transform(F.split(record, _literal(separator)), lambda part: F.split(part, "="))
    found = F.filter(pairs, lambda pair: (F.size(pair) == 2) & (F.get(pair, F.lit(0)) == field)
                     & (F.get(pair, F.lit(1)) != ""))
    return F.get(F.get(found, F.lit(0)), F.lit(1))


def set_field(record: Column, field: str, value: Column, separator: str = "|") -> Column:
    """Replace the value of a field in `a=1|b=2`, keeping the order of the fields."""
    replaced = F.transform(
        F.split(record, _literal(separator)),
        lambda part: F.when(F.substring_index(part, "=", 1) == field,
                            F.concat(F.lit(f"{field}="), value)).otherwise(part))
    return F.array_join(replaced, separator)


def _literal(separator: str) -> str:
    """The separator as a pattern that matches itself."""
    return "\\Q" + separator + "\\E"
