"""The functions by the names SQL users call them.

They are SQL functions, which Catalyst replaces by their bodies. Distinct lists of a group need no
function: `listagg(DISTINCT x, ',') WITHIN GROUP (ORDER BY x)`.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from clickweave.functions.labels import AREA_LEVELS, OTHER_AREA_LEVEL

FUNCTIONS = {
    "concat_long_string(number BIGINT, text STRING, separator STRING)":
        "concat_ws(separator, number, text)",
    "get_json_field(json STRING, field STRING)":
        "get_json_object(json, concat('$.', field))",
    "area_level(area STRING)":
        "CASE " + " ".join(
            f"WHEN area IN ({', '.join(repr(a) for a in areas)}) THEN '{level}'"
            for level, areas in AREA_LEVELS) + f" ELSE '{OTHER_AREA_LEVEL}' END",
}


def register(spark: SparkSession) -> None:
    for signature, body in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURNS STRING RETURN {body}")
