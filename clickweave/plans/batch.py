"""The three batch jobs."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from clickweave.operators import categories, funnel, regions, sampling, sessions
from clickweave.params import TaskParams
from clickweave.plans.results import Writer
from clickweave.sources.tables import actions_in_range, clicked_products

TOP_CATEGORIES = 10


def session_job(actions: DataFrame, users: DataFrame, params: TaskParams, write: Writer, *,
                sample_size: int = 100, seed: str = "0") -> None:
    """Ratios, sample, popular categories and their active sessions.

    The sessions, the sample and the top categories each serve several results and are much smaller
    than the log, so they are kept; what a lost executor held is computed again.
    """
    actions = actions_in_range(actions, params.start_date, params.end_date)
    kept: list[DataFrame] = []

    def keep(rows: DataFrame) -> DataFrame:
        kept.append(rows.persist(StorageLevel.MEMORY_AND_DISK))
        return rows

    try:
        matching = keep(sessions.matching_sessions(actions, users, params))
        write("session_stat_ratio", sessions.band_ratios(sessions.band_counts(matching)))

        sample = keep(sampling.sample_sessions(matching, sample_size, seed))
        write("session_extract", sampling.sample_report(sample, actions, sample_size))
        write("session_detail", sampling.sample_detail(sample, actions, sample_size))

        items = categories.action_items(actions)
        counts = categories.category_counts(items, matching)
        top = keep(categories.top_categories(counts, TOP_CATEGORIES))
        write("top10_category", top)
        write("top10_session", categories.top_sessions(items, matching, top, TOP_CATEGORIES))
    finally:
        for rows in kept:
            rows.unpersist()


def page_job(actions: DataFrame, params: TaskParams, write: Writer) -> None:
    """Conversion along the target page flow, as one text."""
    actions = actions_in_range(actions, params.start_date, params.end_date)
    counts = funnel.transition_counts(funnel.page_transitions(actions), params.target_page_flow)
    write("page_split_convert_rate", funnel.conversion_text(funnel.page_conversion(counts)))


def region_job(actions: DataFrame, products: DataFrame, cities: DataFrame, params: TaskParams,
               write: Writer) -> None:
    """The three most clicked products of each area."""
    clicks = clicked_products(actions_in_range(actions, params.start_date, params.end_date))
    found = regions.area_product_info(regions.area_product_clicks(clicks, cities), products)
    write("area_top3_product", regions.top_products(found))
