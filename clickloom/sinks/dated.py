"""Result tables that micro-batches update: Parquet partitioned by date and by the batch that last wrote the date.

A micro-batch writes the dates it touches whole, into partitions of its own number, by dynamic partition
overwrite: a replay writes the same partitions again, and no file that a reader may be using is replaced.
The newest batch of every date is the table. Older ones of the dates a batch writes are deleted, but for
the last `keep`, so a date has a bounded number of folders however long the stream runs.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BATCH = "batch_id"
#: A batch that touches more dates reads the table without naming them.
MOST_DATES = 400


def write_partitions(rows: DataFrame, path: str, *by: str) -> None:
    """Write the partitions that `rows` has; others stay as they are.

    Rebalanced: a small partition is one file, a large one several of about the advised size.
    """
    rows.hint("rebalance", *by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


@dataclass(frozen=True)
class DatedTable:
    """`schema` has a `date`; `keys` name a row. `adds`: a key's new value is added to the one it had."""

    path: str
    schema: str
    keys: Sequence[str]
    adds: str | None = None
    keep: int = 2

    def read(self, spark: SparkSession, upto: int | None = None) -> DataFrame:
        """The table after batch `upto` (default: the newest)."""
        return self._of(spark, upto).select(*self._names())

    def update(self, changed: DataFrame, batch_id: int) -> None:
        """Put in the changed keys of a batch; the other keys of their dates stay."""
        changed = changed.persist()  # a stream's micro-batch is computed once
        try:
            names = self._names()
            dates = self._dates(changed)
            earlier = self._of(changed.sparkSession, batch_id - 1, dates).select(*names)
            if self.adds:
                rows = earlier.union(changed.select(*names)).groupBy(*self.keys).agg(F.sum(self.adds).alias(self.adds))
            else:
                rows = earlier.join(changed.select(*self.keys), list(self.keys), "left_anti").select(*names).union(changed.select(*names))
            # Dates that the batch doesn't touch need no new version.
            self._store(rows.join(changed.select("date").distinct(), "date", "left_semi"), batch_id, dates)
        finally:
            changed.unpersist()

    def replace(self, rows: DataFrame, batch_id: int) -> None:
        """Put in whole dates: what `rows` has of a date is all it has from now on."""
        self._store(rows, batch_id, self._dates(rows))

    def touched(self, changed: DataFrame, batch_id: int) -> DataFrame:
        """The table's rows after batch `batch_id` of the dates in `changed`."""
        found = self._of(changed.sparkSession, batch_id, self._dates(changed)).select(*self._names())
        return found.join(changed.select("date").distinct(), "date", "left_semi")

    def batch(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """What one batch has written."""
        return self._stored(spark).where(F.col(BATCH) == batch_id).select(*self._names())

    def _store(self, rows: DataFrame, batch_id: int, dates: list[str] | None) -> None:
        numbered = rows.select(*self._names(), F.lit(batch_id).cast("bigint").alias(BATCH))
        write_partitions(numbered, self.path, "date", BATCH)
        self._tidy(rows.sparkSession, batch_id, dates)

    def _tidy(self, spark: SparkSession, batch_id: int, dates: list[str] | None) -> None:
        """Delete what the last `keep` versions of the dates just written have replaced."""
        stored: dict[str, list[int]] = {}
        for date, batch in self._versions(spark, dates):
            stored.setdefault(date, []).append(batch)
        for date, batches in stored.items():
            if batch_id in batches:
                for batch in sorted(x for x in batches if x < batch_id)[: -self.keep]:
                    delete_folder(spark, f"{self.path}/date={date}/{BATCH}={batch}")

    def _versions(self, spark: SparkSession, dates: list[str] | None = None) -> list[tuple[str, int]]:
        """(date, batch) of the stored partitions, of some dates or all; a partition appears whole, by a rename."""
        some = "*" if dates is None else "{" + ",".join(dates) + "}"
        found = [] if dates == [] else glob(spark, f"{self.path}/date={some}/{BATCH}=*")
        parts = [x.rsplit("/", 2)[1:] for x in found]
        return [(day.split("=")[1], int(batch.split("=")[1])) for day, batch in parts]

    def _dates(self, changed: DataFrame) -> list[str] | None:
        """The dates of a batch, or None where they are too many to name."""
        found = changed.select(F.col("date").cast("string")).distinct().limit(MOST_DATES + 1).collect()
        return [x["date"] for x in found] if len(found) <= MOST_DATES else None

    def _of(self, spark: SparkSession, upto: int | None, dates: list[str] | None = None) -> DataFrame:
        newest: dict[str, int] = {}
        for date, batch in self._versions(spark, dates):
            if upto is None or batch <= upto:
                newest[date] = max(batch, newest.get(date, -1))
        if not newest:
            return spark.createDataFrame([], self._fields())
        folders = [f"{self.path}/date={date}/{BATCH}={batch}" for date, batch in newest.items()]
        return spark.read.schema(self._fields()).option("basePath", self.path).parquet(*folders)

    def _stored(self, spark: SparkSession) -> DataFrame:
        make_folder(spark, self.path)
        return spark.read.schema(self._fields()).parquet(self.path)

    def _names(self) -> list[str]:
        return T._parse_datatype_string(self.schema).names

    def _fields(self) -> T.StructType:
        return T.StructType([*T._parse_datatype_string(self.schema).fields, T.StructField(BATCH, T.LongType())])


@dataclass(frozen=True)
class AppendedTable:
    """Rows that batches only add to; a replayed batch writes its own partition again."""

    path: str
    schema: str

    def append(self, rows: DataFrame, batch_id: int) -> None:
        names = T._parse_datatype_string(self.schema).names
        write_partitions(rows.select(*names, F.lit(batch_id).cast("bigint").alias(BATCH)), self.path, BATCH)

    def read(self, spark: SparkSession, upto: int | None = None) -> DataFrame:
        """Distinct rows of the batches up to `upto` (default: all)."""
        make_folder(spark, self.path)
        found = spark.read.schema(f"{self.schema}, {BATCH} bigint").parquet(self.path)
        return (found if upto is None else found.where(F.col(BATCH) <= upto)).drop(BATCH).distinct()


def publish_batch(rows: DataFrame, path: str, batch_id: int) -> DataFrame:
    """Make one batch of rows visible as `<path>/batch_id=<n>`, and return what is there.

    A stream may be reading `path`, so it must see no part of a batch, nor a batch twice: the partition
    appears by a rename, and one that is there is kept. A batch without rows has no partition.
    """
    spark, folder = rows.sparkSession, f"{path}/{BATCH}={batch_id}"
    if not glob(spark, folder):
        write_partitions(rows.withColumn(BATCH, F.lit(batch_id).cast("bigint")), path, BATCH)
    if not glob(spark, folder):
        return spark.createDataFrame([], rows.schema)
    return spark.read.schema(rows.schema).parquet(folder)


def make_folder(spark: SparkSession, path: str) -> None:
    fs, folder = _file_system(spark, path)
    fs.mkdirs(folder)


def delete_folder(spark: SparkSession, path: str) -> None:
    fs, folder = _file_system(spark, path)
    fs.delete(folder, True)


def glob(spark: SparkSession, pattern: str) -> list[str]:
    fs, path = _file_system(spark, pattern)
    return [str(status.getPath()) for status in fs.globStatus(path) or []]


def _file_system(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path
