"""Every operator as a query over the given tables, by name."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweave.functions import dates, labels, numbers, text
from clickweave.operators import ads, categories, funnel, regions, sampling, sessions
from clickweave.params import TaskParams
from clickweave.plans.region_sql import region_views
from clickweave.session import work_folder
from clickweave.sources import sinks, star_schema, tables
from clickweave.streaming.ad_monitor import CATCH_UP, AdMonitor
from clickweave.streaming.replay import replay, replay_late

PARAMS = TaskParams(start_date="2024-01-05", end_date="2024-01-25", start_age=20, end_age=50,
                    target_page_flow=(1, 2, 3, 4, 5, 6, 7))
ALL_USERS = replace(PARAMS, start_age=None, end_age=None)
PROFESSIONALS = ("professional0", "professional7", "professional42", "professional63")
CITIES = ("city3", "city11", "city20")
KEYWORDS = ("kw3", "kw7")
CATEGORY_IDS = (5, 17, 44, 71)

# Forty sessions for each of the 21 days: a part of an hour's sessions, and not rounded down to 0.
SAMPLE_SIZE = 840
# The largest number of clicks by one user on one ad in one day is 3 at the small scales.
THRESHOLD = 2
# Two task ids and the day that cuts the log in two batches, for the sinks.
TASKS = ("task-1", "task-2")
SECOND_BATCH = "20240116"


@dataclass(frozen=True)
class Inputs:
    """The clickstream views of one folder of given tables."""

    spark: SparkSession
    sf_dir: str

    def __post_init__(self) -> None:
        self.spark.conf.set("spark.sql.session.timeZone", "UTC")

    @property
    def all_actions(self) -> DataFrame:
        return star_schema.user_visit_action(self.spark, self.sf_dir)

    @property
    def actions(self) -> DataFrame:
        bounds = PARAMS.start_date, PARAMS.end_date
        return tables.actions_in_range(
            star_schema.user_visit_action(self.spark, self.sf_dir, *bounds), *bounds)

    @property
    def users(self) -> DataFrame:
        return star_schema.user_info(self.spark, self.sf_dir)

    @property
    def products(self) -> DataFrame:
        return star_schema.product_info(self.spark, self.sf_dir)

    @property
    def cities(self) -> DataFrame:
        return tables.city_dimension(self.spark)

    @property
    def product_clicks(self) -> DataFrame:
        return tables.clicked_products(self.actions)

    @property
    def ad_clicks(self) -> DataFrame:
        return star_schema.ad_click(self.spark, self.sf_dir)

    @property
    def full_info(self) -> DataFrame:
        return sessions.session_full_info(sessions.session_aggregate(self.actions), self.users)

    @property
    def matching(self) -> DataFrame:
        return sessions.matching_sessions(self.actions, self.users, PARAMS)

    @property
    def items(self) -> DataFrame:
        return categories.action_items(self.actions)

    @property
    def category_counts(self) -> DataFrame:
        return categories.category_counts(self.items, self.matching)

    @property
    def top_categories(self) -> DataFrame:
        return categories.top_categories(self.category_counts)

    @property
    def area_clicks(self) -> DataFrame:
        return regions.area_product_clicks(self.product_clicks, self.cities)

    @property
    def area_products(self) -> DataFrame:
        return regions.area_product_info(self.area_clicks, self.products)

    @property
    def sample(self) -> DataFrame:
        return sampling.sample_sessions(self.matching, SAMPLE_SIZE)

    @property
    def transitions(self) -> DataFrame:
        return funnel.page_transitions(self.actions)

    @property
    def funnel_counts(self) -> DataFrame:
        return funnel.transition_counts(self.transitions, PARAMS.target_page_flow)

    @property
    def user_clicks(self) -> DataFrame:
        return ads.user_clicks(self.ad_clicks)

    @property
    def city_clicks(self) -> DataFrame:
        return ads.city_clicks(self.ad_clicks)

    @property
    def blacklist(self) -> DataFrame:
        return ads.blacklisted_users(self.user_clicks, THRESHOLD)

    @property
    def monitor(self) -> AdMonitor:
        key = self.spark.sparkContext.applicationId, self.sf_dir, self._files_of("events")
        if key not in _MONITORS:
            _MONITORS[key] = replay(self.spark, self.sf_dir, THRESHOLD)
        return _MONITORS[key]

    def _files_of(self, name: str) -> str:
        """The files of a table, with their sizes and times: other ones are other data."""
        files = star_schema.table(self.spark, self.sf_dir, name).select(
            "_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time")
        return str(sorted(tuple(map(str, row)) for row in files.distinct().collect()))

    def folder(self, name: str) -> str:
        return work_folder(self.spark, name)


def _with_text_time(rows: DataFrame, *names: str) -> DataFrame:
    return rows.withColumns({name: dates.format_time(F.col(name)) for name in names})


def _with_text_date(rows: DataFrame) -> DataFrame:
    return rows.withColumn("date", F.col("date").cast("string"))


def _with_text_lists(info: DataFrame) -> DataFrame:
    """Session info with its time and lists as text."""
    return _with_text_time(info, "start_time").withColumns({
        "keywords": text.join_list(F.col("keywords")),
        "categories": text.join_list(F.col("categories"))})


def _filtered(**conditions) -> Callable[[Inputs], DataFrame]:
    params = replace(ALL_USERS, **conditions)
    return lambda t: _with_text_lists(sessions.filter_sessions(t.full_info, params))


# Scans, functions.

def _fn_dates(t: Inputs) -> DataFrame:
    ts = F.col("ts")
    one_digit_hour = F.date_format(ts, "yyyy-MM-dd H:mm:ss")
    ms = F.timestamp_diff("MILLISECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), ts)
    midnight = ts.cast("date").cast("timestamp_ntz")
    noon = midnight + F.make_dt_interval(hours=F.lit(12))
    key = dates.day_key(dates.from_epoch_ms(ms))
    return star_schema.table(t.spark, t.sf_dir, "events").select(
        "event_id",
        dates.format_time(dates.parse_time(one_digit_hour)).alias("parsed"),
        dates.format_date(ts).alias("day"),
        dates.date_hour_key(ts).alias("date_hour"),
        key.alias("day_key"),
        dates.minute_key(dates.from_epoch_ms(ms)).alias("minute_key"),
        dates.format_date(dates.parse_day_key(key)).alias("day_again"),
        dates.is_before(ts, noon).alias("before_noon"),
        dates.is_after(ts, noon).alias("after_noon"),
        dates.seconds_between(midnight, ts).alias("second_of_day"),
        F.length(dates.today()).alias("today_length"),
        F.date_diff(dates.today().cast("date"), dates.yesterday().cast("date"))
        .alias("days_since_yesterday"))


def _fn_text(t: Inputs) -> DataFrame:
    keyword, hour = F.col("search_keyword"), F.hour("action_time").cast("string")
    record = F.concat_ws("|", F.concat(F.lit("sessionid="), F.col("session_id")),
                         F.concat(F.lit("kw="), F.coalesce(keyword, F.lit(""))),
                         F.concat(F.lit("hour="), hour))
    return t.all_actions.select(
        "event_id",
        text.join_sorted(text.id_list(F.col("order_category_ids"))).alias("order_ids"),
        text.trim_comma(F.concat(F.lit(","), keyword, F.lit(","))).alias("trimmed"),
        text.is_empty(keyword).alias("no_keyword"),
        text.is_not_empty(keyword).alias("has_keyword"),
        text.pad2(hour).alias("padded_hour"),
        text.concat_long_string(F.col("city_id"), F.col("date"), ":").alias("city_date"),
        text.get_field(record, "kw").alias("field_kw"),
        text.get_field(record, "hour").alias("field_hour"),
        text.set_field(record, "hour", text.pad2(hour)).alias("record_set"))


def _fn_numbers(t: Inputs) -> DataFrame:
    return t.ad_clicks.select("event_id", numbers.share(
        F.col("ad_id"), F.col("user_id") + 20).alias("share"))


def _session_bands(t: Inputs) -> DataFrame:
    return t.full_info.select(
        "session_id", labels.visit_band(F.col("visit_length")).alias("visit_band"),
        labels.step_band(F.col("step_length")).alias("step_band"))


def _product_labels(t: Inputs) -> DataFrame:
    return t.products.select(
        "product_id", text.get_json_field(F.col("extend_info"), "product_status").alias("status"),
        labels.product_status(F.col("extend_info")).alias("product_status"))


def _area_levels(t: Inputs) -> DataFrame:
    clicks = regions.click_cities(t.product_clicks, t.cities)
    return (clicks.groupBy("area", labels.area_level(F.col("area")).alias("area_level"))
            .agg(F.count("*").alias("click_count"),
                 text.group_concat_distinct(F.col("city_name")).alias("city_names")))


# Ad log.

def _log_parsed(t: Inputs) -> DataFrame:
    clicks = ads.valid_clicks(star_schema.ad_lines(t.spark, t.sf_dir, broken_errors=True))
    return clicks.select("event_id", dates.day_key(F.col("ts")).alias("date"),
                         dates.minute_key(F.col("ts")).alias("minute"),
                         F.unix_millis("ts").alias("epoch_ms"),
                         "province", "city", "user_id", "ad_id")


def _log_rejects(t: Inputs) -> DataFrame:
    lines = star_schema.ad_lines(t.spark, t.sf_dir, broken_errors=True)
    return ads.rejected_lines(lines.select("event_id", "value"))


def _clicks_clean(t: Inputs) -> DataFrame:
    return ads.without_users(t.ad_clicks, t.blacklist).drop("ts")


# Streams. One replay serves all queries of a session over the same files, as one live monitor
# would; each query then runs its own streaming query to the end of the log.

_MONITORS: dict[tuple[str, str, str], AdMonitor] = {}


def _stream_clean(t: Inputs) -> DataFrame:
    return t.monitor.clean().select(F.unix_millis("ts").alias("epoch_ms"), "province", "city",
                                    "user_id", "ad_id")


def _stream_out_of_time(t: Inputs) -> DataFrame:
    """The first part of the log comes last, when its days have long been closed."""
    monitor = replay_late(t.spark, t.sf_dir)
    return monitor.out_of_time().select(F.unix_millis("ts").alias("epoch_ms"), "province", "city",
                                        "user_id", "ad_id", "reason")


def _stream_city_clicks(t: Inputs) -> DataFrame:
    t.monitor.start_ad_stat(CATCH_UP).awaitTermination()
    return t.monitor.ad_stat()


def _stream_province_top(t: Inputs) -> DataFrame:
    t.monitor.start_province_top(CATCH_UP).awaitTermination()
    return t.monitor.province_top()


def _stream_trend(t: Inputs) -> DataFrame:
    t.monitor.start_click_trend(CATCH_UP).awaitTermination()
    return t.monitor.click_trend()


def _stream_recent_hour(t: Inputs) -> DataFrame:
    t.monitor.start_click_trend(CATCH_UP).awaitTermination()
    return t.monitor.recent_hour()


# Sinks: written, read back.

def _sink_append(t: Inputs) -> DataFrame:
    path = t.folder("top10_category")
    for task_id in (*TASKS, TASKS[0]):
        sinks.append_result(t.top_categories, path, task_id)
    schema = sinks.with_task_id(t.top_categories, "").schema
    return t.spark.read.schema(schema).parquet(path)


def _sink_saved_table(t: Inputs) -> DataFrame:
    name = "clickweave_top10_category"
    sinks.replace_table(t.top_categories, name, t.folder(name))
    return t.spark.table(name)


_USER_CLICK = "date STRING, user_id BIGINT, ad_id BIGINT, click_count BIGINT"
_USER_CLICK_KEYS = ["date", "user_id", "ad_id"]


def _two_batches(t: Inputs, name: str, second: DataFrame) -> DataFrame:
    """A table whose first batch holds the first days, the second what is given; both replayed."""
    path = t.folder(name)
    sinks.create_batches(t.spark, path, _USER_CLICK, ["date"])
    first = t.user_clicks.where(F.col("date") < SECOND_BATCH)
    for batch_id, rows in ((0, first), (1, second), (1, second)):
        sinks.write_batch(rows, path, batch_id, ["date"])
    return sinks.read_batches(t.spark, path, _USER_CLICK)


def _sink_upsert_latest(t: Inputs) -> DataFrame:
    return sinks.latest(_two_batches(t, "latest", t.user_clicks), _USER_CLICK_KEYS)


def _sink_upsert_add(t: Inputs) -> DataFrame:
    return sinks.summed(_two_batches(t, "summed", t.user_clicks), _USER_CLICK_KEYS)


def _sink_compacted(t: Inputs) -> DataFrame:
    path = t.folder("compacted")
    sinks.compact(_two_batches(t, "latest", t.user_clicks), path, _USER_CLICK_KEYS, 1,
                  partition_by=["date"])
    return sinks.read_batches(t.spark, path, _USER_CLICK).drop("batch_id")


def _sink_replace_groups(t: Inputs) -> DataFrame:
    """All days with the top ad, then the later days with the top three."""
    path, groups = t.folder("replaced"), ["date"]
    per_province = ads.province_clicks(t.city_clicks)
    sinks.replace_groups(ads.province_top(per_province, 1), path, groups)
    later = per_province.where(F.col("date") >= SECOND_BATCH)
    sinks.replace_groups(ads.province_top(later), path, groups)
    return t.spark.read.schema(
        "date STRING, province STRING, ad_id BIGINT, click_count BIGINT").parquet(path)


_QUERIES: dict[str, Callable[[Inputs], DataFrame]] = {
    # Scans and dimensions.
    "actions_in_range": lambda t: _with_text_time(t.actions, "action_time"),
    "clicked_products": lambda t: t.product_clicks,
    "user_dimension": lambda t: t.users,
    "product_dimension": lambda t: t.products,
    "action_items": lambda t: t.items,
    # Functions.
    "fn_dates": _fn_dates,
    "fn_text": _fn_text,
    "fn_numbers": _fn_numbers,
    "session_bands": _session_bands,
    "product_labels": _product_labels,
    "area_levels": _area_levels,
    # Regions.
    "click_cities": lambda t: regions.click_cities(t.product_clicks, t.cities),
    "area_product_clicks": lambda t: t.area_clicks,
    "area_product_info": lambda t: t.area_products,
    "regional_top3": lambda t: regions.top_products(t.area_products),
    "regional_top3_sql": lambda t: region_views(t.product_clicks, t.products, t.cities),
    # Sessions.
    "session_aggregate": lambda t: _with_text_lists(sessions.session_aggregate(t.actions)),
    "session_full_info": lambda t: _with_text_lists(t.full_info),
    "sessions_by_age": _filtered(start_age=20, end_age=50),
    "sessions_by_professional": _filtered(professionals=PROFESSIONALS),
    "sessions_by_city": _filtered(cities=CITIES),
    "sessions_by_sex": _filtered(sex="male"),
    "sessions_by_keyword": _filtered(keywords=KEYWORDS),
    "sessions_by_category": _filtered(category_ids=CATEGORY_IDS),
    "sessions_one_age_bound": _filtered(start_age=20),
    "session_filtered": lambda t: _with_text_time(t.matching, "start_time"),
    "session_filtered_all": lambda t: _with_text_time(sessions.matching_sessions(
        t.actions, t.users, replace(PARAMS, sex="male", keywords=KEYWORDS,
                                    category_ids=tuple(range(0, 50)))), "start_time"),
    "session_band_counts": lambda t: sessions.band_counts(t.matching),
    "session_ratios": lambda t: sessions.band_ratios(sessions.band_counts(t.matching)),
    "filtered_actions": lambda t: _with_text_time(
        sessions.filtered_actions(t.actions, t.matching), "action_time"),
    # Categories.
    "category_domain": lambda t: categories.category_domain(t.items),
    "category_counts": lambda t: t.category_counts,
    "top10_categories": lambda t: t.top_categories,
    "category_session_counts": lambda t: categories.category_session_counts(t.items, t.matching),
    "top10_sessions": lambda t: categories.top_sessions(t.items, t.matching, t.top_categories),
    # Sample.
    "session_hour_counts": lambda t: _with_text_date(sampling.hour_counts(t.matching)),
    "session_hour_quota": lambda t: _with_text_date(sampling.hour_quota(
        sampling.hour_counts(t.matching), SAMPLE_SIZE)),
    "session_sample": lambda t: sampling.sample_report(t.sample, t.actions, SAMPLE_SIZE),
    "session_detail": lambda t: sampling.sample_detail(t.sample, t.actions, SAMPLE_SIZE),
    # Funnel.
    "page_transitions": lambda t: t.transitions,
    "transition_counts": lambda t: t.funnel_counts,
    "page_conversion": lambda t: funnel.page_conversion(t.funnel_counts),
    "page_conversion_string": lambda t: funnel.conversion_text(
        funnel.page_conversion(t.funnel_counts), decimals=4),
    # Ads.
    "ad_log_parsed": _log_parsed,
    "ad_log_rejects": _log_rejects,
    "ad_user_clicks": lambda t: t.user_clicks,
    "ad_blacklist": lambda t: t.blacklist,
    "ad_clicks_clean": _clicks_clean,
    "ad_city_clicks": lambda t: t.city_clicks,
    "ad_province_clicks": lambda t: ads.province_clicks(t.city_clicks),
    "ad_province_top3": lambda t: ads.province_top(ads.province_clicks(t.city_clicks)),
    "ad_minute_trend": lambda t: ads.minute_trend(ads.minute_clicks(t.ad_clicks)),
    "ad_recent_hour": lambda t: ads.minute_trend(
        ads.minute_clicks(ads.recent_clicks(t.ad_clicks))),
    # Streams.
    "stream_ad_blacklist": lambda t: t.monitor.blacklist(),
    "stream_ad_user_clicks": lambda t: t.monitor.user_clicks(),
    "stream_ad_clicks_clean": _stream_clean,
    "stream_ad_rejects": lambda t: t.monitor.rejects(),
    "stream_ad_out_of_time": _stream_out_of_time,
    "stream_ad_city_clicks": _stream_city_clicks,
    "stream_ad_province_top3": _stream_province_top,
    "stream_ad_minute_trend": _stream_trend,
    "stream_ad_recent_hour": _stream_recent_hour,
    # Sinks.
    "sink_append": _sink_append,
    "sink_saved_table": _sink_saved_table,
    "sink_upsert_latest": _sink_upsert_latest,
    "sink_upsert_add": _sink_upsert_add,
    "sink_compacted": _sink_compacted,
    "sink_replace_groups": _sink_replace_groups,
}


def _bind(build: Callable[[Inputs], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: build(Inputs(spark, sf_dir))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _bind(build) for name, build in _QUERIES.items()}
