"""Connected components of a link table, as rounds of joins over stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.session import shared_table


def components(links: DataFrame) -> DataFrame:
    """`id`, `component` (smallest id reachable) of every id in `links` (`a`, `b`).

    Each round takes the smallest label among the neighbours and then follows labels of labels, so
    stars settle at once and chains shorten by more than half. Counts and minima combine before
    the shuffle; a hub's links meet in a plain equi join, which adaptive execution can split.
    Nulls and self links are ignored; an empty table gives an empty one.
    """
    links = links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select("a", "b")
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = shared_table(both.distinct(), "links")
    labels = both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.col("a")).alias("component"))
    labels = shared_table(labels, "labels")
    while True:
        near = both.join(labels, F.col("b") == F.col("id")).groupBy("a").agg(F.min("component").alias("near"))
        moved = labels.join(near, labels["id"] == near["a"], "left").select(
            "id", F.col("component").alias("was"), F.least("component", "near").alias("component")
        )
        moved = shared_table(moved, "labels")
        onward = moved.select(F.col("id").alias("via"), F.col("component").alias("onward"))
        labels = moved.join(onward, moved["component"] == onward["via"], "left").select(
            "id", "was", F.least("component", "onward").alias("component")
        )
        labels = shared_table(labels, "labels")
        if labels.where("component < was").isEmpty():
            return labels.select("id", "component")
