"""Totals by key in a state of their own: a value, its last click, and a timer or a time to live.

The state of a key can end, unlike that of a plain running count: with `idle`, an event-time timer lets a
key go once the stream has passed its last click by that time; with `ttl`, the state store lets a value go
that has not changed for that long by the clock.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

KEYS = ("date", "province", "city", "ad_id")
TOTALS = "date date, province string, city string, ad_id bigint, click_count bigint"


def _millis(period: timedelta) -> int:
    return int(period.total_seconds() * 1000)


def running_total(idle: timedelta | None = None, ttl: timedelta | None = None) -> StatefulProcessor:
    """The clicks of one key so far, given out whenever it has new ones.

    The class is made in here so that it is sent with its code: the process in which Spark first asks a
    processor for its state variables, unlike the workers, is not given `--py-files`.
    """
    idle_millis, ttl_millis = (_millis(period) if period else None for period in (idle, ttl))

    class RunningTotal(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            self.total = handle.getValueState("total", "click_count bigint, last_millis bigint", ttl_millis)

        def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
            count, last = self.total.get() if self.total.exists() else (0, 0)
            for row in rows:
                count, last = count + row.click_count, max(last, int(row.click_time.timestamp() * 1000))
            self.total.update((count, last))
            if idle_millis is not None:
                for timer in list(self.handle.listTimers()):
                    self.handle.deleteTimer(timer)
                self.handle.registerTimer(last + idle_millis)
            yield Row(**dict(zip(KEYS, key, strict=True)), click_count=count)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
            self.total.clear()
            return iter(())

        def close(self) -> None:
            pass

    return RunningTotal()


def combined(clicks: DataFrame) -> DataFrame:
    """Clicks counted per key within every Arrow batch, before they are shuffled to their state."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = pa.Table.from_batches([batch]).group_by(list(KEYS)).aggregate([("click_time", "max"), ("click_time", "count")])
            table = counts.rename_columns([*KEYS, "click_time", "click_count"])
            yield from table.set_column(5, "click_count", pc.cast(table["click_count"], pa.int64())).to_batches()

    schema = "date date, province string, city string, ad_id bigint, click_time timestamp, click_count bigint"
    return clicks.select(*KEYS, "click_time").mapInArrow(run, schema)


def totals_by_state(
    clicks: DataFrame, idle: timedelta | None = None, ttl: timedelta | None = None, lateness: str = "0 seconds"
) -> DataFrame:
    """Totals per day, province, city and ad, a row whenever a key's total changes (update mode).

    With `idle`, clicks older than the watermark (`lateness` behind the newest click) are left out,
    and a key that comes back after its timer starts from zero.
    """
    if idle is not None and ttl is not None:
        raise ValueError("idle is by event time and ttl by the clock: give one of them")
    counted, mode = combined(clicks), "None" if idle is None and ttl is None else "ProcessingTime"
    if idle is not None:
        counted, mode = counted.withWatermark("click_time", lateness), "EventTime"
    return counted.groupBy(*KEYS).transformWithState(running_total(idle, ttl), TOTALS, "Update", mode)
