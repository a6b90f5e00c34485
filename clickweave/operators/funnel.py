"""Conversion from page to page along a given flow."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Minutes of a session that one task orders, unless it has more rows then.
SLICE_MINUTES, SLICE_ROWS = 10, 1_000_000


def tie_breaker(actions: DataFrame) -> str:
    """Column that orders actions of the same session and second."""
    return "event_id" if "event_id" in actions.columns else "page_id"


def in_slices(actions: DataFrame, slice_minutes: int = SLICE_MINUTES,
              slice_rows: int = SLICE_ROWS) -> DataFrame:
    """The rows with `slice`, the number of their slice of the calendar.

    How long slices are is a scalar of the log, counted before it is shuffled.
    """
    whole = slice_minutes * 60_000_000
    # Of the zone-free time: a change of clocks does not touch it.
    micros = F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"),
                              F.col("action_time").cast("timestamp_ntz"))
    fullest = (actions.groupBy("session_id", F.floor(micros / whole)).agg(F.count("*").alias("n"))
               .agg(F.max("n")).scalar())
    width = F.greatest(F.lit(1), F.least(F.lit(whole), F.floor(
        F.lit(float(whole)) * slice_rows / fullest)))
    return actions.withColumn("slice", F.floor(micros / width))


def page_transitions(actions: DataFrame, slice_minutes: int = SLICE_MINUTES,
                     slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Each action's page and the next page of its session, null at the session's end.

    Every session is ordered slice by slice of its wall-clock time, so that no task orders a whole
    one. Slices are as much shorter than `slice_minutes` as the fullest of these needs to hold about
    `slice_rows`. The last row of a slice is followed by the first of the session's next slice: these ends
    are found by an aggregate merged on the map side, and a session has at most one pair of them for
    each slice of the calendar. Rows without a session id are taken as one session.
    """
    ordering = list(dict.fromkeys(["action_time", tie_breaker(actions), "page_id"]))
    rows = in_slices(actions.select("session_id", *ordering), slice_minutes, slice_rows)
    in_slice = Window.partitionBy("session_id", "slice").orderBy(*ordering)
    in_session = Window.partitionBy("session_id").orderBy("slice")
    result = ["session_id", "page_id", "next_page_id"]
    inside = (rows.withColumn("next_page_id", F.lead("page_id").over(in_slice))
              .withColumn("is_last", F.lead(F.lit(False), 1, True).over(in_slice))
              .where("NOT is_last").select(*result))
    row = F.struct(*ordering)
    across = (rows.groupBy("session_id", "slice")
              .agg(F.min(row).alias("first"), F.max(row).alias("last"))
              .withColumn("next_page_id", F.lead("first.page_id").over(in_session))
              .select("session_id", "last.page_id", "next_page_id"))
    return inside.unionByName(across)


def flow_steps(flow: Sequence[int]) -> list[tuple[int, int]]:
    """Consecutive pages of a flow."""
    return list(zip(flow, flow[1:]))


def transition_counts(transitions: DataFrame, flow: Sequence[int]) -> DataFrame:
    """Per step of the flow the number of transitions, and of what it is a part.

    The first step is a part of the views of its start page, each later one of the step before.
    All counts are taken in one pass and one row; pairs repeated in the flow keep their steps.
    """
    pages = F.col("page_id")
    steps = flow_steps(flow)
    counts = [F.count_if((pages == a) & (F.col("next_page_id") == b)).alias(f"n{i}")
              for i, (a, b) in enumerate(steps, 1)]
    once = (transitions.where(pages.isin(*flow))
            .agg(F.count_if(pages == flow[0]).alias("n0"), *counts))
    rows = [F.struct(F.lit(i).alias("step_no"), F.lit(f"{a}_{b}").alias("step"),
                     F.col(f"n{i}").alias("transitions"), F.col(f"n{i - 1}").alias("base"))
            for i, (a, b) in enumerate(steps, 1)]
    return once.select(F.inline(F.array(*rows)))


def page_conversion(counts: DataFrame) -> DataFrame:
    """Share of the base that made the step; null where the base is 0."""
    rate = F.try_divide(F.col("transitions"), F.col("base")).cast("double")
    return counts.select("step_no", "step", "transitions", rate.alias("rate"))


def conversion_text(conversion: DataFrame, decimals: int | None = None) -> DataFrame:
    """All steps in one text, `1_2=0.5|2_3=0.25`, in flow order."""
    rate = F.col("rate").cast("string") if decimals is None \
        else F.format_string(f"%.{decimals}f", "rate")
    pair = F.concat(F.col("step"), F.lit("="), F.coalesce(rate, F.lit("")))
    ordered = F.array_sort(F.collect_list(F.struct("step_no", pair.alias("pair"))))
    return conversion.agg(F.array_join(F.transform(ordered, lambda s: s["pair"]), "|")
                          .alias("convert_rate"))
