"""One row per session, filters on it, and the spread of its lengths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickweave.functions.dates import seconds_between
from clickweave.functions.labels import STEP_BANDS, VISIT_BANDS, in_band
from clickweave.functions.numbers import share
from clickweave.functions.text import empty_to_null
from clickweave.operators.filters import interest_predicate, one_of, user_predicate
from clickweave.operators.joins import keys_to_match
from clickweave.params import TaskParams
from clickweave.sources.tables import NO_CLICK

USER_COLUMNS = ("age", "professional", "city", "sex")


def searched_keyword() -> Column:
    """The keyword searched for, null where there was no search."""
    return empty_to_null(F.col("search_keyword"))


def clicked_category() -> Column:
    """The clicked category, null where there was no click."""
    return F.nullif(F.col("click_category_id"), F.lit(NO_CLICK).cast("bigint"))


def session_aggregate(actions: DataFrame) -> DataFrame:
    """User, start, length, steps, keyword set and category set of each session.

    Equal (session, keyword, category) rows are merged first: a session holding a large part of
    the log is then spread over the tasks by its values, and the sets are built from distinct rows.
    """
    merged = (actions
              .groupBy("session_id", searched_keyword().alias("keyword"),
                       clicked_category().alias("category"))
              .agg(F.min("user_id").alias("user_id"),
                   F.min("action_time").alias("start_time"),
                   F.max("action_time").alias("end_time"),
                   F.count("*").alias("step_length")))
    return (merged.groupBy("session_id")
            .agg(F.min("user_id").alias("user_id"),
                 F.min("start_time").alias("start_time"),
                 F.max("end_time").alias("end_time"),
                 F.sum("step_length").alias("step_length"),
                 F.array_sort(F.collect_set("keyword")).alias("keywords"),
                 F.array_sort(F.collect_set("category")).alias("categories"))
            .select("session_id", "user_id", "start_time",
                    seconds_between(F.col("start_time"), F.col("end_time")).alias("visit_length"),
                    "step_length", "keywords", "categories"))


def session_full_info(sessions: DataFrame, users: DataFrame) -> DataFrame:
    """Sessions with their user's data; sessions of unknown users are dropped."""
    return sessions.join(users.select("user_id", *USER_COLUMNS), "user_id")


def filter_sessions(full_info: DataFrame, params: TaskParams) -> DataFrame:
    """Sessions that meet every given condition."""
    return full_info.where(user_predicate(params)).where(interest_predicate(params))


def matching_sessions(actions: DataFrame, users: DataFrame, params: TaskParams) -> DataFrame:
    """What `filter_sessions` keeps, without building the keyword and category sets.

    The conditions on keywords and categories are folded into the aggregate as flags, so each
    session is a fixed-width row from the map side on and is shuffled once.
    """
    flags = [F.coalesce(F.max(hit), F.lit(False)) for hit in (
        one_of(searched_keyword(), params.keywords),
        one_of(clicked_category(), params.category_ids)) if hit is not None]
    names = [f"hit_{i}" for i in range(len(flags))]
    sessions = (actions.groupBy("session_id")
                .agg(F.min("user_id").alias("user_id"),
                     F.min("action_time").alias("start_time"),
                     F.max("action_time").alias("end_time"),
                     F.count("*").alias("step_length"),
                     *[flag.alias(name) for flag, name in zip(flags, names)]))
    for name in names:
        sessions = sessions.where(F.col(name))
    sessions = sessions.select(
        "session_id", "user_id", "start_time",
        seconds_between(F.col("start_time"), F.col("end_time")).alias("visit_length"),
        "step_length")
    return session_full_info(sessions, users.where(user_predicate(params)))


def filtered_actions(actions: DataFrame, sessions: DataFrame) -> DataFrame:
    """Actions of the given sessions."""
    return actions.join(keys_to_match(sessions, "session_id"), "session_id", "left_semi")


def band_counts(sessions: DataFrame) -> DataFrame:
    """One row: number of sessions, in all and per band of visit length and of steps."""
    visits = [F.count_if(in_band(F.col("visit_length"), low, high)).alias(f"visit_length_{name}")
              for name, low, high in VISIT_BANDS]
    steps = [F.count_if(in_band(F.col("step_length"), low, high)).alias(f"step_length_{name}")
             for name, low, high in STEP_BANDS]
    return sessions.agg(F.count("*").alias("session_count"), *visits, *steps)


def band_ratios(counts: DataFrame) -> DataFrame:
    """Each band's share of all sessions, rounded to two places; 0 without sessions."""
    shares = [share(F.col(c), F.col("session_count")).alias(f"{c}_ratio")
              for c in counts.columns if c != "session_count"]
    return counts.select("session_count", *shares)
