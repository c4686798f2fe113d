"""Steps from page to page and the conversion rate along a page flow."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.functions.numbers import ratio


# Length of the time blocks a session is cut into.
BLOCK_SECONDS = 600


def _block_steps(actions: DataFrame, tie_break: Sequence[str], block_seconds: int) -> DataFrame:
    """Actions with their predecessor inside a time block of the session.

    Cutting sessions into blocks lets many tasks order a session of any size. `_follows` and
    `_leads` tell whether a row has a neighbour in its block. `_hop_page` is the page as far as hops
    count it: actions at the same second are ordered by `tie_break`; without one their order is not
    known, and it is NULL for them. Actions without a session belong to no visit and are left out.
    """
    order = list(dict.fromkeys(["action_time", *tie_break]))
    rows = actions.where(F.col("session_id").isNotNull()).select(
        "session_id",
        "page_id",
        *[c for c in order if c != "page_id"],
        F.floor(F.unix_timestamp("action_time") / block_seconds).alias("_block"),
    )
    in_block = Window.partitionBy("session_id", "_block").orderBy(*order)
    page, time = F.col("page_id"), F.col("action_time")
    if not tie_break:
        alone = ~(F.lag(time).over(in_block).eqNullSafe(time) | F.lead(time).over(in_block).eqNullSafe(time))
        page = F.when(alone, page)
    rows = rows.withColumn("_hop_page", page)
    before = F.lag("_hop_page").over(in_block)
    return rows.select(
        "*",
        F.when(F.col("_hop_page").isNotNull(), before).alias("prev_page_id"),
        F.lag(F.lit(True), 1, False).over(in_block).alias("_follows"),
        F.lead(F.lit(True), 1, False).over(in_block).alias("_leads"),
    )


def page_steps(
    actions: DataFrame, tie_break: Sequence[str] = (), block_seconds: int = BLOCK_SECONDS
) -> DataFrame:
    """Every action with the page visited just before it in its session (NULL for the first).

    The first row of a block continues from the last row of the session's previous block, found
    among first and last rows alone.
    """
    rows = _block_steps(actions, tie_break, block_seconds)
    inner = rows.where(F.col("_follows"))
    # At most two rows per block and session.
    ends = rows.where(~F.col("_follows") | ~F.col("_leads"))
    in_session = Window.partitionBy("session_id").orderBy("_block", F.asc("_follows"))
    before = F.when(F.col("_hop_page").isNotNull(), F.lag("_hop_page").over(in_session))
    firsts = ends.withColumn("prev_page_id", before).where(~F.col("_follows"))
    wanted = ["session_id", "prev_page_id", "page_id"]
    return inner.select(*wanted).unionByName(firsts.select(*wanted))


def page_pairs(steps: DataFrame) -> DataFrame:
    """Consecutive page pairs."""
    return steps.where(F.col("prev_page_id").isNotNull())


def hops(flow: Sequence[int]) -> list[str]:
    """`[1, 2, 3]` -> `["1_2", "2_3"]`."""
    return [f"{a}_{b}" for a, b in zip(flow, flow[1:])]


def _hop() -> Column:
    return F.concat_ws("_", F.col("prev_page_id").cast("string"), F.col("page_id").cast("string"))


def flow_hops(pairs: DataFrame, flow: Sequence[int]) -> DataFrame:
    """Page pairs that are a hop of the flow, each once."""
    matched = page_pairs(pairs).withColumn("hop", _hop())
    return matched.where(F.col("hop").isin(hops(flow))).select("session_id", "hop")


def hop_counts(matched: DataFrame) -> DataFrame:
    return matched.groupBy("hop").agg(F.count("*").alias("hop_count"))


def start_page_views(actions: DataFrame, flow: Sequence[int]) -> DataFrame:
    """One row: views of the flow's first page, over all sessions."""
    return actions.where(F.col("page_id") == flow[0]).agg(F.count("*").alias("start_page_views"))


def flow_counts(
    actions: DataFrame,
    flow: Sequence[int],
    tie_break: Sequence[str] = (),
    block_seconds: int = BLOCK_SECONDS,
) -> DataFrame:
    """One row: views of the start page (`_c0`) and the count of every hop (`_c1`, ...).

    Counts are taken inside the time blocks, where the rows already lie together, which leaves one
    row per block. Those are few enough to order per session and add the hops between blocks.
    """
    pairs = list(enumerate(zip(flow, flow[1:]), 1))

    def hit(before: Column, after: Column, pair: tuple[int, int]) -> Column:
        return F.when((before == pair[0]) & (after == pair[1]), 1)

    prev, page = F.col("prev_page_id"), F.col("_hop_page")
    blocks = _block_steps(actions, tie_break, block_seconds).groupBy("session_id", "_block").agg(
        F.max(F.when(~F.col("_follows"), page)).alias("_first"),
        F.max(F.when(~F.col("_leads"), page)).alias("_last"),
        F.count(F.when(F.col("page_id") == flow[0], 1)).alias("_c0"),
        *[F.count(hit(prev, page, pair)).alias(f"_c{i}") for i, pair in pairs],
    )
    before = F.lag("_last").over(Window.partitionBy("session_id").orderBy("_block"))
    blocks = blocks.withColumn("_before", before)
    totals = [F.coalesce(F.sum("_c0"), F.lit(0)).alias("_c0")]
    for i, pair in pairs:
        across = F.count(hit(F.col("_before"), F.col("_first"), pair))
        totals.append((F.coalesce(F.sum(f"_c{i}"), F.lit(0)) + across).alias(f"_c{i}"))
    return blocks.agg(*totals)


def conversion_rates(
    actions: DataFrame,
    flow: Sequence[int],
    tie_break: Sequence[str] = (),
    block_seconds: int = BLOCK_SECONDS,
) -> DataFrame:
    """One row per hop in flow order: its count, the count it is measured against, their ratio.

    The first hop is measured against the views of the start page, every other one against the
    hop before it. The flow's length bounds the columns of the one-row count.
    """
    names = hops(flow)
    counts = flow_counts(actions, flow, tie_break, block_seconds)
    lines = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(name).alias("hop"),
            F.col(f"_c{i}").alias("hop_count"),
            F.col(f"_c{i - 1}").alias("base_count"),
        )
        for i, name in enumerate(names, 1)
    ]
    rates = counts.select(F.inline(F.array(*lines)))
    return rates.withColumn("rate", ratio(F.col("hop_count"), F.col("base_count")))


def packed_rates(rates: DataFrame) -> DataFrame:
    """One row `hop=rate|hop=rate` in flow order; a hop that occurs twice keeps its last rate."""
    last = rates.groupBy("hop").agg(F.max(F.struct("position", "rate")).alias("last"))
    entry = F.struct(
        F.col("last.position").alias("position"),
        F.concat_ws("=", F.col("hop"), F.coalesce(F.col("last.rate").cast("string"), F.lit("null"))).alias("text"),
    )
    ordered = last.agg(F.array_sort(F.collect_list(entry)).alias("entries"))
    return ordered.select(F.array_join(F.col("entries.text"), "|").alias("convert_rate"))
