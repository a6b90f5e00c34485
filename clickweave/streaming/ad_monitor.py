"""Live ad statistics with a blacklist that feeds back into the stream.

The stream filters on a list it writes itself, which no single streaming plan can say. It is cut
into queries that meet in tables:

    lines -> filter  -> clean             clicks of users not listed when their batch began
                     -> rejects           lines that are no click
                     -> out_of_time       clicks too far ahead, or of a closed day or minute
                     -> inboxes           what the batch adds to each of the counts below
    inbox -> user_clicks                  per day, user and ad; above the threshold -> blacklist
    inbox -> ad_stat                      per day, province, city and ad
    inbox -> ad_province_top3             per day, province and ad, the best of them
    inbox -> ad_click_trend               per minute and ad; of them the last hour -> ad_recent_hour

The filter counts each batch for every query before it hands it on, so a user with very many clicks is
one row. Counts live in the state store; a batch costs what it brings, not what the day has
gathered. Every query has its checkpoint, and every table is published batch by batch through its
manifest, so a restart goes on where it stopped and a replayed batch changes nothing. The queries merge
the tables they write, and a day's rows become one run when the day is closed. An inbox is emptied by
the stream that reads it. So what a batch has to list does not grow.

A watermark closes old days and minutes. The filter keeps the same clock over what it lets through and
sets aside what the counts would drop; it also sets aside clicks from the future, one of which would
else close every day before it. So each line is in `clean`, `rejects` or `out_of_time`, or its user is
listed.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import datetime, timedelta
from functools import lru_cache

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clickweave.functions.dates import day_key
from clickweave.operators import ads
from clickweave.sources import batch_table, files
from clickweave.sources.batch_table import BatchTable
from clickweave.streaming import user_state

CLICK_SCHEMA = "ts TIMESTAMP, province STRING, city STRING, user_id BIGINT, ad_id BIGINT"
# The reason says why a click is not counted in full, null if it is.
CLEAN_SCHEMA = f"{CLICK_SCHEMA}, reason STRING, date STRING"
USER_CLICK_SCHEMA = "date STRING, user_id BIGINT, ad_id BIGINT, click_count BIGINT"
STAT_SCHEMA = "date STRING, province STRING, city STRING, ad_id BIGINT, click_count BIGINT"
PROVINCE_SCHEMA = "date STRING, province STRING, ad_id BIGINT, click_count BIGINT"
TREND_SCHEMA = "date STRING, hour STRING, minute STRING, ad_id BIGINT, click_count BIGINT"

# What the filter hands to each query: the clicks per key, and the time that its watermark is on.
INBOXES = {
    "user_clicks": ("day", ["user_id", "ad_id"]),
    "ad_stat": ("day", ["province", "city", "ad_id"]),
    "province_top": ("day", ["province", "ad_id"]),
    "click_trend": ("minute", ["ad_id"]),
}
_TYPES = {"user_id": "BIGINT", "ad_id": "BIGINT", "province": "STRING", "city": "STRING"}

# Batches whose emptied folders an inbox keeps, as a stream may be listing them.
SETTLED = 8

EPOCH = datetime(1970, 1, 1)

LIVE = {"processingTime": "5 seconds"}
CATCH_UP = {"availableNow": True}

# The user counts need a store that holds several states of a key. It is set where queries start, as
# the caller's session may have another one.
STORE = {"spark.sql.streaming.stateStore.providerClass":
         "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


@dataclass(frozen=True)
class AdMonitor:
    """The tables and queries below one shared folder.

    A day is dated by its first second, so `day_late_by` has to be over a day for clicks of
    yesterday to count after midnight. `ahead_by` is how far a click may be ahead of the time its
    batch began. `recent_minutes` is how many minutes the table of recent clicks holds.
    """

    spark: SparkSession
    root: str
    threshold: int = 100
    top_size: int = 3
    day_late_by: str = "25 hours"
    minute_late_by: str = "60 minutes"
    ahead_by: str = "10 minutes"
    recent_minutes: int = 60

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def create_tables(self) -> AdMonitor:
        """Make the inboxes, which a stream has to find; tables come with their first batch."""
        for name in INBOXES:
            files.make_folder(self.spark, self._inbox(name))
        return self

    def table(self, name: str) -> BatchTable:
        """A table by name; `clean`, `rejects`, `ad_blacklist`, ..."""
        key = ["date", "province", "city", "ad_id"]
        schema, merge, day, replaces = {
            "clean": (CLEAN_SCHEMA, batch_table.append, "date", False),
            "rejects": ("value STRING", batch_table.append, None, False),
            "out_of_time": (f"{CLICK_SCHEMA}, reason STRING", batch_table.append, None, False),
            "ad_blacklist": ("user_id BIGINT", batch_table.distinct, None, False),
            "ad_user_click_count": (f"{USER_CLICK_SCHEMA}, newly_listed BOOLEAN",
                                    batch_table.latest("date", "user_id", "ad_id"), "date", False),
            "ad_stat": (STAT_SCHEMA, batch_table.latest(*key), "date", False),
            "ad_province_click_count": (PROVINCE_SCHEMA, batch_table.latest(
                "date", "province", "ad_id"), "date", False),
            "ad_province_top3": (PROVINCE_SCHEMA, batch_table.append, "date", True),
            "ad_click_trend": (TREND_SCHEMA, batch_table.latest("date", "hour", "minute", "ad_id"),
                               "date", False),
            "ad_recent_hour": (TREND_SCHEMA, batch_table.append, None, True),
        }[name]
        return BatchTable(self.spark, self.path(name), schema, merge, day, replaces)

    # Tables as they are now.

    def blacklist(self) -> DataFrame:
        return self.table("ad_blacklist").read()

    def clean(self) -> DataFrame:
        return self.table("clean").read().select("ts", "province", "city", "user_id", "ad_id")

    def rejects(self) -> DataFrame:
        return self.table("rejects").read()

    def out_of_time(self) -> DataFrame:
        """Clicks set aside. Those of a closed minute are in `clean` too, for the counts by day."""
        return self.table("out_of_time").read()

    def user_clicks(self) -> DataFrame:
        return self.table("ad_user_click_count").read().drop("newly_listed")

    def ad_stat(self) -> DataFrame:
        return self.table("ad_stat").read()

    def province_top(self) -> DataFrame:
        return self.table("ad_province_top3").read()

    def click_trend(self) -> DataFrame:
        return self.table("ad_click_trend").read()

    def recent_hour(self) -> DataFrame:
        """The trend of the minutes up to the newest one that was clicked in."""
        return self.table("ad_recent_hour").read()

    # Queries.

    def start_filter(self, lines: DataFrame, trigger: dict = LIVE) -> StreamingQuery:
        """Sort the lines; what is listed meanwhile counts from the next batch.

        `now` is the time the batch began, which a replay finds in the checkpoint.
        """
        timed = lines.select("value", F.current_timestamp().alias("now"))
        return self._start("filter", timed, self._write_lines, trigger, "append")

    def start_user_clicks(self, trigger: dict = LIVE) -> StreamingQuery:
        """Count clicks per day, user and ad, and list users above the threshold."""
        counts = user_state.user_counts(self._inbox_stream("user_clicks"), self.threshold,
                                        self.day_late_by)
        return self._start("user_clicks", counts, self._write_user_clicks, trigger)

    def start_ad_stat(self, trigger: dict = LIVE) -> StreamingQuery:
        """Count clicks per day, province, city and ad."""
        return self._start("ad_stat", self._day_counts("ad_stat"), self._write_ad_stat, trigger)

    def start_province_top(self, trigger: dict = LIVE) -> StreamingQuery:
        """Count clicks per day, province and ad, and keep the best ads of each province."""
        return self._start("province_top", self._day_counts("province_top"),
                           self._write_province_top, trigger)

    def start_click_trend(self, trigger: dict = LIVE) -> StreamingQuery:
        """Count clicks per minute and ad, and keep those of the last hour at hand."""
        counts = (self._inbox_stream("click_trend").withWatermark("minute", self.minute_late_by)
                  .groupBy(F.col("minute").alias("time"), "ad_id")
                  .agg(F.sum("clicks").alias("click_count")))
        return self._start("click_trend", ads.minute_trend(counts), self._write_trend, trigger)

    def start_all(self, lines: DataFrame, trigger: dict = LIVE) -> list[StreamingQuery]:
        return [self.start_filter(lines, trigger), self.start_user_clicks(trigger),
                self.start_ad_stat(trigger), self.start_province_top(trigger),
                self.start_click_trend(trigger)]

    def _day_counts(self, name: str) -> DataFrame:
        keys = INBOXES[name][1]
        counts = (self._inbox_stream(name).withWatermark("day", self.day_late_by)
                  .groupBy("day", *keys).agg(F.sum("clicks").alias("click_count")))
        return counts.select(day_key(F.col("day")).alias("date"), *keys, "click_count")

    # One micro-batch of each query.

    def _write_lines(self, lines: DataFrame, batch_id: int) -> None:
        """Publish rejects, clicks out of time, then the clean clicks; hand on what they add."""
        clean = self.table("clean")
        before = clean.manifest()
        if before.batch < batch_id:
            parsed = ads.parsed_lines(lines).persist(StorageLevel.MEMORY_AND_DISK)
            try:
                self.table("rejects").commit(ads.rejects_of(parsed).select("value"), batch_id)
                newest = before.note.get("newest")
                clicks = (ads.clicks_of(parsed).withColumn("reason", self._out_of_time(newest))
                          .drop("now"))
                late = clicks.where(F.col("reason").isNotNull())
                self.table("out_of_time").commit(late, batch_id)
                counted = clicks.where(
                    F.coalesce("reason", F.lit("minute_closed")) == "minute_closed")
                self._write_clean(counted.withColumn("date", day_key(F.col("ts"))), batch_id)
            finally:
                parsed.unpersist()
        self._hand_on(batch_id)
        self._tidy(clean.manifest().note.get("newest"), "rejects", "out_of_time", "clean")

    def _write_clean(self, clicks: DataFrame, batch_id: int) -> None:
        """Drop listed users, publish, set the clock: the newest click, in microseconds."""
        clean = self.table("clean")

        def newest() -> dict:
            written = clean.written(batch_id).agg(F.max(F.unix_micros("ts"))).first()[0]
            times = [t for t in (written, clean.manifest().note.get("newest")) if t is not None]
            return {"newest": max(times, default=None)}

        clean.commit(ads.without_users(clicks, self.blacklist()), batch_id, newest)

    def _hand_on(self, batch_id: int) -> None:
        """Put what a published batch adds to the counts into the inboxes, each once.

        An inbox is the source of a stream, which would take a batch file by file while it is written,
        and rewritten files as new; part of a batch might then close a day before the rest has come.
        So each is written beside and moved in whole.
        """
        done = f"{self.path('staged')}/{batch_id}"
        clicks = self.table("clean").written(batch_id)

        def send(name: str) -> None:
            time, keys = INBOXES[name]
            staged, marker = f"{done}/{name}", f"{done}/{name}-sent"
            target = f"{self._inbox(name)}/batch_id={batch_id}"
            if files.exists(self.spark, marker):
                return
            if not files.exists(self.spark, target):
                own = clicks.where(F.col("reason").isNull()) if time == "minute" else clicks
                partial = (own.groupBy(F.date_trunc(time, "ts").alias(time), *keys)
                           .agg(F.count("*").alias("clicks")))
                if name == "user_clicks":
                    partial = user_state.per_user(partial)
                partial.write.mode("overwrite").parquet(staged)
                files.move(self.spark, staged, target)
            files.write_text(self.spark, marker, "")

        # Small jobs of their own: side by side they take as long as one.
        with ThreadPoolExecutor(len(INBOXES)) as pool:
            list(pool.map(send, INBOXES))
        for name in files.names(self.spark, self.path("staged")):
            if int(name) < batch_id:
                files.delete(self.spark, f"{self.path('staged')}/{name}")
        self._sweep_inboxes(batch_id)

    def _sweep_inboxes(self, batch_id: int) -> None:
        """Remove the folders of batches whose files the streams have deleted."""
        for name in INBOXES:
            for folder in files.names(self.spark, self._inbox(name)):
                path = f"{self._inbox(name)}/{folder}"
                if int(folder.partition("=")[2]) < batch_id - SETTLED and not any(
                        f.startswith("part-") for f in files.names(self.spark, path)):
                    files.delete(self.spark, path)

    def _out_of_time(self, newest: int | None) -> Column:
        """Why a click is not counted in full.

        The counts close a day (a minute) by what they have taken from `clean`, which is never more
        than the filter had let through before. So they drop nothing that passes here.
        """
        clock = F.lit(None).cast("timestamp") if newest is None else F.timestamp_micros(F.lit(newest))
        return (F.when(F.col("ts") > F.col("now") + F.expr(f"INTERVAL {self.ahead_by}"), "ahead")
                .when(ads.is_closed("day", clock, self.day_late_by), "day_closed")
                .when(ads.is_closed("minute", clock, self.minute_late_by), "minute_closed"))

    def _write_user_clicks(self, counts: DataFrame, batch_id: int) -> None:
        table = self.table("ad_user_click_count")
        _commit_counts(table, counts, batch_id)
        listed = table.written(batch_id).where("newly_listed AND user_id IS NOT NULL")
        self.table("ad_blacklist").commit(listed.select("user_id").distinct(), batch_id)
        self._tidy(self._newest(), "ad_user_click_count", "ad_blacklist")

    def _write_ad_stat(self, counts: DataFrame, batch_id: int) -> None:
        _commit_counts(self.table("ad_stat"), counts, batch_id)
        self._tidy(self._newest(), "ad_stat")

    def _write_province_top(self, counts: DataFrame, batch_id: int) -> None:
        """Merge the ads counted anew into the best ads of their days.

        Counts only grow, so an ad neither among the best nor counted anew cannot enter: the
        earlier best and the batch are all there is to rank.
        """
        counted, top = self.table("ad_province_click_count"), self.table("ad_province_top3")
        _commit_counts(counted, counts, batch_id)
        new = counted.written(batch_id)
        earlier = top.read().join(new.select("date").distinct(), "date", "left_semi")
        top.commit(ads.province_top(_newer(earlier, new, ["date", "province", "ad_id"]),
                                    self.top_size), batch_id)
        self._tidy(self._newest(), "ad_province_click_count")

    def _write_trend(self, trend: DataFrame, batch_id: int) -> None:
        """Publish the minutes counted anew, and move the last hour on by them."""
        counted, recent = self.table("ad_click_trend"), self.table("ad_recent_hour")
        _commit_counts(counted, trend, batch_id)
        time = F.to_timestamp(F.concat("date", "hour", "minute"), "yyyyMMddHHmm")
        rows = _newer(recent.read(), counted.written(batch_id), ["date", "hour", "minute", "ad_id"])
        newest = rows.agg(F.max(time)).scalar()
        since = newest - F.make_dt_interval(mins=F.lit(self.recent_minutes - 1))
        recent.commit(rows.where(time >= since), batch_id)
        self._tidy(self._newest(), "ad_click_trend")

    def _newest(self) -> int | None:
        return self.table("clean").manifest().note.get("newest")

    def _tidy(self, newest: int | None, *names: str) -> None:
        """Merge what is due in tables of the query at hand.

        A day gets no more rows once it is closed for the filter, and all that was let through before
        is counted: a further `day_late_by` is left for that.
        """
        closed = ""
        if newest is not None:
            delay = _micros(self.spark, self.day_late_by)
            closed = f"{EPOCH + timedelta(microseconds=newest - 2 * delay):%Y%m%d}"
        for name in names:
            self.table(name).compact(lambda day: day < closed)

    def _inbox(self, name: str) -> str:
        return self.path(f"inbox/{name}")

    def _inbox_stream(self, name: str) -> DataFrame:
        """What the filter hands to a query; files that a batch has taken are deleted after it."""
        return (self.spark.readStream.schema(f"{_inbox_schema(name)}, batch_id BIGINT")
                .option("cleanSource", "delete").parquet(self._inbox(name)).drop("batch_id"))

    def _start(self, name: str, rows: DataFrame, write_batch: Callable[[DataFrame, int], None],
               trigger: dict, mode: str = "update") -> StreamingQuery:
        with _conf(self.spark, STORE):
            return (rows.writeStream.foreachBatch(write_batch).outputMode(mode).queryName(name)
                    .trigger(**trigger)
                    .option("checkpointLocation", self.path(f"checkpoints/{name}")).start())


def _commit_counts(table: BatchTable, counts: DataFrame, batch_id: int) -> None:
    """Publish what a stateful plan returns. A batch that is published already runs it all the same,
    as the state has to follow."""
    if not table.commit(counts, batch_id):
        counts.write.format("noop").mode("overwrite").save()


@lru_cache
def _micros(spark: SparkSession, interval: str) -> int:
    end = f"TIMESTAMP'1970-01-01 00:00:00Z' + INTERVAL {interval}"
    return spark.sql(f"SELECT unix_micros({end})").first()[0]


def _inbox_schema(name: str) -> str:
    if name == "user_clicks":
        return user_state.INPUT
    time, keys = INBOXES[name]
    return ", ".join([f"{time} TIMESTAMP", *(f"{k} {_TYPES[k]}" for k in keys), "clicks BIGINT"])


def _newer(earlier: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of both; of a key in both, the new one."""
    rows = earlier.withColumn("batch_id", F.lit(0)).unionByName(new.withColumn("batch_id", F.lit(1)))
    return batch_table.latest(*keys)(rows)


@contextmanager
def _conf(spark: SparkSession, settings: dict[str, str]):
    """Settings that a query takes with it when it starts; the session has its own again after."""
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
