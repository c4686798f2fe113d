"""Joins and counts that hold up when a few keys carry much of the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.session import shared_table

_SALT = "_salt"
_HOT = "_hot"
LEFT_DRIVEN_JOINS = ("inner", "left", "left_semi", "left_anti")


def row_salt(columns: Sequence[str], salts: int) -> Column:
    """Salt from the row's own content, so a recomputed task sends each row the same way."""
    return F.pmod(F.xxhash64(*columns), F.lit(salts)).cast("int")


def hot_keys(df: DataFrame, keys: Sequence[str], share: float = 0.01, sample: float | None = None) -> DataFrame:
    """Keys holding at least `share` of the rows; at most 1/share of them can exist.

    `sample` estimates the shares from a fraction of the rows, which is enough to pick the keys
    worth splitting: results never depend on the choice.
    """
    rows = df.select(*keys).dropna()
    if sample:
        rows = rows.sample(sample, seed=17)
    counts = rows.groupBy(*keys).agg(F.count("*").alias("row_count"))
    total = counts.agg(F.sum("row_count").alias("total")).scalar()
    return counts.where(F.col("row_count") >= F.lit(share) * total).select(*keys)


def frequent_keys(df: DataFrame, keys: Sequence[str], share: float = 0.01) -> DataFrame:
    """`hot_keys` without a shuffle by key: a sketch names at most 2/share candidates, which alone are counted.

    The frequent-items sketch holds every key above its share (and some below), in memory bounded by
    the share; a second pass counts the candidates exactly, one group each and one for all the rest.
    """
    rows = df.select(F.struct(*keys).alias("key")).where(" AND ".join(f"key.`{k}` IS NOT NULL" for k in keys))
    sketch = rows.stat.freqItems(["key"], max(share / 2, 1e-4))
    candidates = shared_table(sketch.select(F.explode("key_freqItems").alias("key")).distinct(), "candidates")
    marked = rows.join(F.broadcast(candidates.withColumn(_HOT, F.lit(True))), "key", "left")
    counts = marked.groupBy(F.when(F.col(_HOT), F.col("key")).alias("key")).agg(F.count("*").alias("row_count"))
    counts = shared_table(counts, "candidate-counts")
    total = counts.agg(F.sum("row_count").alias("total")).scalar()
    return counts.where(F.col("key").isNotNull() & (F.col("row_count") >= F.lit(share) * total)).select("key.*")


def skew_join(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str],
    how: str = "inner",
    salts: int = 16,
    share: float = 0.01,
    sample: float | None = None,
    salt_by: Sequence[str] | None = None,
    sketch: bool = False,
) -> DataFrame:
    """Equi join that spreads the hot keys of `left` over `salts` reducers.

    Only hot keys are salted on the left and repeated on the right; all other rows join as usual.
    The hot-key list is written once, so both sides agree on it, and has at most 1/share rows,
    which bounds its broadcast; `sketch` finds it by `frequent_keys`. Give `salt_by` a row id when `left` holds many identical rows.
    """
    if how not in LEFT_DRIVEN_JOINS:
        raise ValueError(f"how must be one of {LEFT_DRIVEN_JOINS}")
    keys = [on] if isinstance(on, str) else list(on)
    found = frequent_keys(left, keys, share) if sketch else hot_keys(left, keys, share, sample)
    hot = shared_table(found, "hot-keys").withColumn(_HOT, F.lit(True))
    hot = F.broadcast(hot)

    salt = row_salt(salt_by or left.columns, salts)
    salted_left = left.join(hot, keys, "left").withColumn(
        _SALT, F.when(F.col(_HOT), salt).otherwise(F.lit(0))
    )
    every_salt = F.sequence(F.lit(0), F.lit(salts - 1))
    repeated_right = right.join(hot, keys, "left").withColumn(
        _SALT, F.explode(F.when(F.col(_HOT), every_salt).otherwise(F.array(F.lit(0))))
    )
    joined = salted_left.drop(_HOT).join(repeated_right.drop(_HOT), [*keys, _SALT], how)
    return joined.drop(_SALT)


#: Largest table that `map_join` ships to every task, by the plan's own estimate.
MOST_BROADCAST_BYTES = 64 << 20


def estimated_bytes(df: DataFrame) -> int:
    """Size of a frame by the statistics of its optimised plan; no job runs."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def map_join(
    left: DataFrame, right: DataFrame, on: str | Sequence[str], how: str = "inner", most_bytes: int = MOST_BROADCAST_BYTES
) -> DataFrame:
    """Join with a small table that every task gets whole, so `left` is neither shuffled nor sorted.

    Raises a ValueError if the plan's statistics put `right` above `most_bytes`. They are an upper
    bound for files and filters and a product for joins: store a joined table first.
    """
    size = estimated_bytes(right)
    if size > most_bytes:
        raise ValueError(f"the table to ship is estimated at {size} bytes, more than {most_bytes}: use a plain join or skew_join")
    return left.join(F.broadcast(right), on, how)


def filter_by_keys(left: DataFrame, keys: DataFrame, on: str, how: str) -> DataFrame:
    """Keep (`left_semi`) or drop (`left_anti`) the rows of `left` whose key is listed.

    Adaptive execution picks the join and splits hot keys; `skew_join` is there to be asked for.
    """
    return left.join(keys.select(on), on, how).select(*left.columns)


def salted_count(
    df: DataFrame, keys: Sequence[str], salts: int = 16, salt_by: Sequence[str] | None = None
) -> DataFrame:
    """Count per key in two stages, first per (key, salt), then per key.

    Spark already combines before the shuffle; the first stage also splits keys whose partial
    counts alone would load one reducer.
    """
    salt = row_salt(salt_by or df.columns, salts)
    partial = df.groupBy(*keys, salt.alias(_SALT)).agg(F.count("*").alias("partial_count"))
    return partial.groupBy(*keys).agg(F.sum("partial_count").alias("row_count"))
