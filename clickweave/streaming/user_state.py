"""Clicks per day, user and ad as keyed state, with the listing of users above the threshold.

One operator holds all there is to know of a user: the counts of the open days, and whether the user
is listed. It counts, tells when the threshold is passed, and drops days by a timer once the
watermark has closed them.

A call to the state store, and a row handed to Python or back, cost far more than a count does. So a
user is one row of lists per batch each way, is read once and written once, and has a timer for the
first open day only.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from clickweave.functions.dates import day_key

# What comes in: `day` is the newest of `days`, which are milliseconds since 1970.
INPUT = "day TIMESTAMP, user_id BIGINT, days ARRAY<BIGINT>, ads ARRAY<BIGINT>, clicks ARRAY<BIGINT>"
STATE = "days ARRAY<BIGINT>, ads ARRAY<BIGINT>, counts ARRAY<BIGINT>, listed BOOLEAN"
OUTPUT = """user_id BIGINT, days ARRAY<BIGINT>, ads ARRAY<BIGINT>, counts ARRAY<BIGINT>,
    newly_listed BOOLEAN"""


class UserCounts(StatefulProcessor):
    """Of a user. Takes rows with days, ads and clicks; returns the counts that have changed.

    `newly_listed` is set in the batch in which a count first passes the threshold. The mark stays when
    the days are gone, so a user is listed once. While there are counts, there is a timer on the first
    of their days.
    """

    def __init__(self, threshold: int):
        self.threshold = threshold

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.user = handle.getValueState("user", STATE)

    def _read(self) -> tuple[Counter, bool]:
        state = self.user.get()
        if state is None:
            return Counter(), False
        days, ads, counts, listed = state
        return Counter(dict(zip(zip(days, ads, strict=True), counts, strict=True))), listed

    def _write(self, counts: Counter, listed: bool) -> None:
        if not counts and not listed:
            self.user.clear()
            return
        self.user.update((*_columns(counts), listed))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        counts, listed = self._read()
        first = _first_day(counts)
        added: Counter = Counter()
        for row in rows:
            for day, ad, clicks in zip(row.days, row.ads, row.clicks, strict=True):
                added[day, ad] += clicks
        counts.update(added)
        if _first_day(counts) != first:
            self.handle.registerTimer(_first_day(counts))
        newly = not listed and any(counts[k] > self.threshold for k in added)
        self._write(counts, listed or newly)
        days, ads, changed = _columns({k: counts[k] for k in added})
        yield Row(user_id=key[0], days=days, ads=ads, counts=changed, newly_listed=newly)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        """Drop all days that are closed, and wait for the first of the others."""
        counts, listed = self._read()
        closed = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs() - 1)
        left = Counter({k: n for k, n in counts.items() if k[0] > closed})
        if left:
            self.handle.registerTimer(_first_day(left))
        self._write(left, listed)
        return iter(())

    def close(self) -> None:
        pass


def _first_day(counts: Counter) -> int | None:
    return min((day for day, _ in counts), default=None)


def _columns(counts: dict[tuple[int, int], int]) -> tuple[list, list, list]:
    """Days, ads and counts beside each other."""
    return [day for day, _ in counts], [ad for _, ad in counts], list(counts.values())


def per_user(partial: DataFrame) -> DataFrame:
    """Rows of day, user_id, ad_id and clicks as one row for each user.

    They are counts of many clicks already, so a user with very many is one row of as many as there
    are days and ads.
    """
    count = F.struct(F.unix_millis("day").alias("day"), "ad_id", "clicks")
    rows = partial.groupBy("user_id").agg(F.max("day").alias("day"), F.collect_list(count).alias("all"))
    return rows.select("day", "user_id", F.col("all.day").alias("days"),
                       F.col("all.ad_id").alias("ads"), F.col("all.clicks").alias("clicks"))


def user_counts(users: DataFrame, threshold: int, late_by: str) -> DataFrame:
    """date, user_id, ad_id, click_count and newly_listed from a stream of the rows of `per_user`.

    A null user or ad is a key like any other, but a null user is never listed. The watermark goes by
    a row's newest day; a row's other days must not be closed either, which the filter sees to.
    """
    counted = users.withWatermark("day", late_by).groupBy("user_id").transformWithState(
        UserCounts(threshold), OUTPUT, "Update", "EventTime")
    changed = counted.select("user_id", "newly_listed",
                             F.inline(F.arrays_zip("days", "ads", "counts")))
    return changed.select(day_key(F.timestamp_millis("days")).alias("date"), "user_id",
                          F.col("ads").alias("ad_id"), F.col("counts").alias("click_count"),
                          "newly_listed")
