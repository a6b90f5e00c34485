"""Command line: `python -m clickweave session|page|region|ads ...`, or through spark-submit."""

from __future__ import annotations

import argparse
import json
import uuid

from clickweave.params import TaskParams
from clickweave.plans import batch
from clickweave.plans.results import Writer, to_folder, to_jdbc
from clickweave.session import build_session
from clickweave.sources import tables
from clickweave.sources.streams import kafka_lines
from clickweave.streaming.ad_monitor import AdMonitor


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="clickweave")
    jobs = parser.add_subparsers(dest="job", required=True)
    for job, dimension in (("session", "users"), ("page", None), ("region", "products")):
        sub = jobs.add_parser(job)
        sub.add_argument("--params", required=True, help="task parameters as JSON")
        sub.add_argument("--actions", default="user_visit_action", help="table or parquet folder")
        if dimension:
            sub.add_argument(f"--{dimension}", default=f"{dimension[:-1]}_info")
        sub.add_argument("--task-id", default=str(uuid.uuid4()))
        target = sub.add_mutually_exclusive_group(required=True)
        target.add_argument("--out", help="folder of the result tables")
        target.add_argument("--jdbc", help="database URL of the result tables")
        sub.add_argument("--jdbc-properties", type=json.loads, default={})
        if job == "session":
            sub.add_argument("--sample-size", type=int, default=100)
            sub.add_argument("--seed", default="0", help="which sample is drawn")
    ads = jobs.add_parser("ads")
    ads.add_argument("--brokers", required=True)
    ads.add_argument("--topic", required=True)
    ads.add_argument("--root", required=True, help="shared folder of tables and checkpoints")
    ads.add_argument("--threshold", type=int, default=AdMonitor.threshold)
    ads.add_argument("--top-size", type=int, default=AdMonitor.top_size)
    ads.add_argument("--day-late-by", default=AdMonitor.day_late_by)
    ads.add_argument("--minute-late-by", default=AdMonitor.minute_late_by)
    ads.add_argument("--ahead-by", default=AdMonitor.ahead_by)
    ads.add_argument("--starting-offsets", default="latest", help="where the first start begins")
    ads.add_argument("--max-offsets", help="messages read by a batch at most")
    for sub in jobs.choices.values():
        sub.add_argument("--shuffle-partitions", type=int,
                         help="before AQE merges small ones; of the ad counts, fixed at first start")
    return parser


def _writer(args: argparse.Namespace) -> Writer:
    if args.out:
        return to_folder(args.out, args.task_id)
    return to_jdbc(args.jdbc, args.jdbc_properties, args.task_id)


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    parts = args.shuffle_partitions
    conf = {"spark.sql.shuffle.partitions": str(parts)} if parts else None
    spark = build_session(f"clickweave-{args.job}", conf=conf)
    if args.job == "ads":
        monitor = AdMonitor(spark, args.root, args.threshold, args.top_size, args.day_late_by,
                            args.minute_late_by, args.ahead_by).create_tables()
        options = {"maxOffsetsPerTrigger": args.max_offsets} if args.max_offsets else {}
        monitor.start_all(kafka_lines(spark, args.brokers, args.topic, args.starting_offsets,
                                      **options))
        spark.streams.awaitAnyTermination()
        return
    params = TaskParams.from_json(args.params)
    actions = tables.read_actions(spark, args.actions)
    write = _writer(args)
    if args.job == "session":
        batch.session_job(actions, tables.read_table(spark, args.users), params, write,
                          sample_size=args.sample_size, seed=args.seed)
    elif args.job == "page":
        batch.page_job(actions, params, write)
    else:
        batch.region_job(actions, tables.read_table(spark, args.products),
                         tables.city_dimension(spark), params, write)


if __name__ == "__main__":
    main()
