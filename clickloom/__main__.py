"""Run a job: `spark-submit --py-files ... clickloom session --task 3 --tables /in --out /out`.

`--tables` holds the input tables as parquet folders named like the tables; with `--catalog` it is
the catalog database that holds them. The ad job reads Kafka topics, or text files with `--files`,
and runs until it is stopped.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from clickloom.operators.ads import BLACKLIST_THRESHOLD
from clickloom.plans.jobs import run_page_job, run_product_job, run_session_job
from clickloom.session import build_session, clear_shared
from clickloom.sinks.append import folder_sink
from clickloom.sources import tables
from clickloom.sources.ad_log import file_lines, kafka_lines
from clickloom.streaming.ad_clicks import BATCH_INTERVAL, AdClickJob


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="clickloom", description=__doc__)
    jobs = parser.add_subparsers(dest="job", required=True)
    for name in ("session", "page", "product"):
        job = jobs.add_parser(name)
        job.add_argument("--task", type=int, required=True)
        job.add_argument("--tables", required=True)
        job.add_argument("--catalog", action="store_true", help="--tables names a database of the catalog")
        job.add_argument("--out", required=True)
        if name == "page":
            job.add_argument("--row-id", help="column that orders the actions of one second")
    bad = jobs.add_parser("unreadable", help="set aside the actions whose times or ids the jobs cannot read")
    bad.add_argument("--tables", required=True)
    bad.add_argument("--catalog", action="store_true")
    bad.add_argument("--out", required=True)
    ads = jobs.add_parser("ads")
    ads.add_argument("--root", required=True, help="folder for the job's tables and checkpoints")
    source = ads.add_mutually_exclusive_group(required=True)
    source.add_argument("--files", help="folder of text files")
    source.add_argument("--topics", help="comma list of Kafka topics")
    ads.add_argument("--servers", help="Kafka bootstrap servers")
    ads.add_argument("--kafka", action="append", default=[], metavar="KEY=VALUE", help="option of the Kafka source")
    ads.add_argument("--once", action="store_true", help="process what is there and stop")
    ads.add_argument("--interval", default=BATCH_INTERVAL, help="time between micro-batches")
    ads.add_argument("--lateness", default="1 day", help="how late clicks may come; 'none' keeps all state for ever")
    ads.add_argument("--threshold", type=int, default=BLACKLIST_THRESHOLD, help="clicks that put a user on the blacklist")
    return parser.parse_args(argv)


def ad_job(args: argparse.Namespace) -> AdClickJob:
    trigger = {"availableNow": True} if args.once else {"processingTime": args.interval}
    lateness = None if args.lateness == "none" else args.lateness
    return AdClickJob(args.root, threshold=args.threshold, lateness=lateness, trigger=trigger)


def ad_lines(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    if args.files:
        return file_lines(spark, args.files)
    return kafka_lines(spark, args.servers, args.topics, **dict(x.split("=", 1) for x in args.kafka))


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    spark = build_session(f"clickloom-{args.job}")
    if args.job == "ads":
        ad_job(args).run(ad_lines(spark, args), args.once)
        return

    def table(name: str):
        if args.catalog:
            return tables.read_table(spark, f"{args.tables}.{name}", "table")
        return tables.read_table(spark, f"{args.tables}/{name}")

    actions = table("user_visit_action")
    if args.job == "unreadable":
        tables.unreadable_actions(actions).write.mode("overwrite").parquet(f"{args.out}/unreadable_actions")
        return
    try:
        tasks, sink = table("task"), folder_sink(args.out)
        if args.job == "session":
            run_session_job(actions, tables.user_info(table("user_info")), tasks, args.task, sink)
        elif args.job == "page":
            run_page_job(actions, tasks, args.task, sink, (args.row_id,) if args.row_id else ())
        else:
            cities, products = tables.city_info(table("city_info")), tables.product_info(table("product_info"))
            run_product_job(actions, cities, products, tasks, args.task, sink)
    finally:
        clear_shared(spark)


if __name__ == "__main__":
    main()
