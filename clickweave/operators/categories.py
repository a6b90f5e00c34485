"""Most popular categories and their most active sessions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickweave.operators.joins import broadcast_below, keys_to_match
from clickweave.operators.sessions import clicked_category

KINDS = ("click", "order", "pay")
COUNTS = tuple(f"{kind}_count" for kind in KINDS)


def action_items(actions: DataFrame) -> DataFrame:
    """One row per category an action clicked, ordered or paid for.

    `stack` and `explode` stay in generated code, which higher-order functions on arrays leave.
    """
    lists = (clicked_category().cast("string"), F.col("order_category_ids"),
             F.col("pay_category_ids"))
    pairs = [part for kind, ids in zip(KINDS, lists) for part in (F.lit(kind), ids)]
    return (actions
            .select("session_id", F.stack(F.lit(len(KINDS)), *pairs).alias("kind", "ids"))
            .where("ids IS NOT NULL")
            .select("session_id", "kind", F.explode(F.split("ids", ",")).alias("id"))
            .select("session_id", F.trim("id").try_cast("bigint").alias("category_id"), "kind")
            .where("category_id IS NOT NULL"))


def category_counts(items: DataFrame, sessions: DataFrame) -> DataFrame:
    """Clicks, orders and payments of every category touched in the given sessions."""
    kept = items.join(keys_to_match(sessions, "session_id"), "session_id", "left_semi")
    return kept.groupBy("category_id").agg(*_counts())


def category_session_counts(items: DataFrame, sessions: DataFrame) -> DataFrame:
    """Clicks, orders and payments per category and session, for the given sessions.

    Counts are made before the join with the sessions, so what is shuffled and joined is one row
    per (session, category) however many actions a session has.
    """
    counts = items.groupBy("session_id", "category_id").agg(*_counts())
    return counts.join(sessions.select("session_id"), "session_id", "left_semi")


def _counts() -> list[Column]:
    return [F.count_if(F.col("kind") == kind).alias(name) for kind, name in zip(KINDS, COUNTS)]


def category_domain(items: DataFrame) -> DataFrame:
    """The categories touched by a click, an order or a payment."""
    return items.select("category_id").distinct()


def top_categories(counts: DataFrame, size: int = 10) -> DataFrame:
    """Most clicked categories, then most ordered, most paid, lowest id."""
    order = [F.desc(c) for c in COUNTS] + [F.asc("category_id")]
    return counts.orderBy(*order).limit(size)


def top_sessions(items: DataFrame, sessions: DataFrame, top: DataFrame, categories: int = 10,
                 size: int = 10) -> DataFrame:
    """Per top category the given sessions that clicked it most, ties by session id.

    `top` holds at most `categories` rows, which bounds its broadcast: all but the clicks on them
    are gone before the first shuffle.
    """
    wanted = broadcast_below(top.select("category_id"), categories)
    clicks = items.where("kind = 'click'").join(wanted, "category_id", "left_semi")
    counts = category_session_counts(clicks, sessions)
    order = Window.partitionBy("category_id").orderBy(F.desc("click_count"), "session_id")
    return (counts.withColumn("position", F.row_number().over(order))
            .where(F.col("position") <= size)
            .select("category_id", "session_id", "click_count"))
