"""The ad click job as three streaming queries, each with its own checkpoint.

1. `filter_clicks`: raw lines -> blacklist filter -> per-user counts -> new blacklist entries,
   with the surviving clicks published as the clean log.
2. `running_totals`: clean log -> totals per day, province, city and ad -> top ads per province.
3. `click_trends`: raw lines -> clicks per minute and ad.

The order inside a micro-batch of the first query is fixed: read the blacklist as of the previous
batch, filter, count, extend the blacklist. A new entry acts from the next batch on, and a replayed
batch repeats the same decisions.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from clickloom import schemas
from clickloom.operators import ads
from clickloom.session import rocksdb_state
from clickloom.sinks.dated import BATCH, AppendedTable, DatedTable, glob, make_folder, publish_batch
from clickloom.streaming.state import totals_by_state

BATCH_INTERVAL = "5 seconds"


@dataclass(frozen=True)
class AdClickJob:
    """Where the job keeps its tables, and its settings.

    `lateness` bounds the state: keys older than the newest click by more than that are let go, and
    later clicks for them are not counted. None keeps every key, so every click counts.
    """

    root: str
    threshold: int = ads.BLACKLIST_THRESHOLD
    top: int = 3
    lateness: str | None = None
    trigger: dict = field(default_factory=lambda: {"processingTime": BATCH_INTERVAL})
    keep: int = 2

    def _table(self, name: str, schema: str, *keys: str, adds: str | None = None) -> DatedTable:
        return DatedTable(f"{self.root}/{name}", schema, keys, adds, self.keep)

    @property
    def clean_log(self) -> str:
        return f"{self.root}/clean_log"

    @property
    def blacklist(self) -> AppendedTable:
        return AppendedTable(f"{self.root}/ad_blacklist", schemas.AD_BLACKLIST)

    @property
    def user_clicks(self) -> DatedTable:
        return self._table("ad_user_click_count", schemas.AD_USER_CLICK_COUNT, "date", "user_id", "ad_id", adds="click_count")

    @property
    def stat(self) -> DatedTable:
        return self._table("ad_stat", schemas.AD_STAT, "date", "province", "city", "ad_id")

    @property
    def province_top(self) -> DatedTable:
        return self._table("ad_province_top3", schemas.AD_PROVINCE_TOP3, "date", "province", "ad_id")

    @property
    def trend(self) -> DatedTable:
        return self._table("ad_click_trend", schemas.AD_CLICK_TREND, "date", "hour", "minute", "ad_id")

    @property
    def barred_by_hand(self) -> str:
        """Folder of users barred from outside the job; anyone may add parquet files with a user_id."""
        return f"{self.root}/ad_blacklist_given"

    def bar_users(self, user_ids: DataFrame) -> None:
        """Bar users from the next micro-batch on, before the job starts or while it runs."""
        user_ids.select(F.col("user_id").cast("bigint")).write.mode("append").parquet(self.barred_by_hand)

    def blacklisted(self, spark: SparkSession, upto: int | None = None) -> DataFrame:
        """Users barred by hand and by the micro-batches before `upto` (default: all)."""
        found = self.blacklist.read(spark, None if upto is None else upto - 1)
        if glob(spark, f"{self.barred_by_hand}/_SUCCESS"):
            found = found.union(spark.read.schema(schemas.AD_BLACKLIST).parquet(self.barred_by_hand))
        return found.distinct()

    def filter_batch(self, lines: DataFrame, batch_id: int) -> None:
        """One micro-batch of the first query."""
        spark = lines.sparkSession
        known = self.blacklisted(spark, batch_id)
        clicks = ads.without_blacklisted(ads.parse_ad_log(lines), known)
        clean = publish_batch(clicks, self.clean_log, batch_id)
        publish_batch(ads.malformed_ad_log(lines), f"{self.root}/malformed-log", batch_id)

        counts = ads.user_ad_counts(clean)
        self.user_clicks.update(counts, batch_id)
        counted = self.user_clicks.touched(counts, batch_id)
        barred = ads.users_to_blacklist(counted, self.threshold).join(known, "user_id", "left_anti")
        self.blacklist.append(barred, batch_id)

    def totals_batch(self, totals: DataFrame, batch_id: int) -> None:
        """One micro-batch of the second query: changed totals, then the top ads of the days they touch."""
        self.stat.update(totals, batch_id)
        written = self.stat.batch(totals.sparkSession, batch_id)
        self.province_top.replace(ads.province_top_ads(written, self.top), batch_id)

    def trend_batch(self, minutes: DataFrame, batch_id: int) -> None:
        self.trend.update(ads.click_trend(minutes), batch_id)

    def _start(self, writer: DataStreamWriter, name: str) -> StreamingQuery:
        return (
            writer.queryName(name)
            .option("checkpointLocation", f"{self.root}/checkpoints/{name}")
            .trigger(**self.trigger)
            .start()
        )

    def _bounded(self, clicks: DataFrame) -> DataFrame:
        return clicks.withWatermark("click_time", self.lateness) if self.lateness else clicks

    def filter_clicks(self, lines: DataFrame) -> StreamingQuery:
        return self._start(lines.writeStream.foreachBatch(self.filter_batch), "filter_clicks")

    def clean_clicks(self, spark: SparkSession, files_per_batch: int | None = None) -> DataFrame:
        """The clean log as a stream."""
        make_folder(spark, self.clean_log)
        reader = spark.readStream.schema(f"{schemas.AD_CLICK}, {BATCH} bigint")
        if files_per_batch:
            reader = reader.option("maxFilesPerTrigger", files_per_batch)
        return reader.parquet(self.clean_log).drop(BATCH)

    def running_totals(self, clicks: DataFrame) -> StreamingQuery:
        """Totals kept in the state store; a micro-batch writes only the keys it changed."""
        day = F.window("click_time", "1 day")
        totals = (
            self._bounded(clicks)
            .groupBy(day.alias("day"), "province", "city", "ad_id")
            .agg(F.count("*").alias("click_count"))
            .select(F.to_date("day.start").alias("date"), "province", "city", "ad_id", "click_count")
        )
        return self._start(
            totals.writeStream.outputMode("update").foreachBatch(self.totals_batch), "running_totals"
        )

    def totals_by_state(self, clicks: DataFrame, idle: timedelta | None = None, ttl: timedelta | None = None) -> StreamingQuery:
        """`running_totals` by a state that a key leaves after `idle` event time or `ttl` clock time.

        By the clock there is always another micro-batch, so `ttl` needs a trigger that goes on.
        Only RocksDB holds such a state, so the stream runs on it.
        """
        if ttl is not None and "processingTime" not in self.trigger:
            raise ValueError("ttl is by the clock: give a processingTime trigger")
        totals = totals_by_state(clicks, idle, ttl, self.lateness or "0 seconds")
        with rocksdb_state(clicks.sparkSession):
            return self._start(totals.writeStream.outputMode("update").foreachBatch(self.totals_batch), "totals_by_state")

    @property
    def sliding_log(self) -> str:
        return f"{self.root}/ad_sliding_clicks"

    def sliding_clicks(self, lines: DataFrame, length: str = "60 minutes", slide: str = "10 seconds") -> StreamingQuery:
        """Clicks per ad in sliding windows, each appended once when the watermark has passed its end.

        Needs `lateness`: it decides when a window is complete and how late a click may come.
        """
        if not self.lateness:
            raise ValueError("sliding windows end by the watermark: set lateness")
        windows = ads.sliding_clicks(self._bounded(ads.parse_ad_log(lines)), length, slide)
        writer = windows.writeStream.outputMode("append").format("parquet").option("path", self.sliding_log)
        return self._start(writer, "sliding_clicks")

    def click_trends(self, lines: DataFrame) -> StreamingQuery:
        """Full count of every minute; the blacklist does not apply here."""
        minute = F.window("click_time", "1 minute")
        minutes = (
            self._bounded(ads.parse_ad_log(lines))
            .groupBy(minute.alias("_minute"), "ad_id")
            .agg(F.count("*").alias("click_count"))
            .select(F.col("_minute.start").alias("minute_start"), "ad_id", "click_count")
        )
        return self._start(minutes.writeStream.outputMode("update").foreachBatch(self.trend_batch), "click_trends")

    def start(self, lines: DataFrame) -> list[StreamingQuery]:
        """Start all three queries; on restart each resumes from its checkpoint."""
        clean = self.clean_clicks(lines.sparkSession)
        return [self.filter_clicks(lines), self.running_totals(clean), self.click_trends(lines)]

    def run(self, lines: DataFrame, once: bool = False) -> None:
        """Run until a query ends; with `once`, until all that is there is processed.

        Once, the totals begin after the filter has written the whole clean log. A query that fails
        ends the others and the job.
        """
        spark = lines.sparkSession
        if once:
            self.filter_clicks(lines).awaitTermination()
            self.click_trends(lines).awaitTermination()
            self.running_totals(self.clean_clicks(spark)).awaitTermination()
            return
        queries = self.start(lines)
        try:
            spark.streams.awaitAnyTermination()
        finally:
            for query in queries:
                query.stop()
