"""Command line: ``python -m sessionloom etl|daily|visits|repair|flow|sessions|events|bad-records|landing …`` (or through spark-submit)."""

from __future__ import annotations

import argparse

from .plans.daily import run_daily
from .plans.etl import run_etl
from .plans.visits import run_first_visits, run_sessions
from .session import build_session
from .sources.ip_rules import read_ip_rules
from .sources.streams import kafka_lines, text_lines
from .streaming.events import start_bad_records, start_event_load
from .streaming.flow import OPEN_DAYS, repair_flow, start_flow
from .streaming.landing import start_landing
from .streaming.sessions import start_sessions
from .streaming.start import FLOW_EVERY


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="sessionloom")
    jobs = parser.add_subparsers(dest="job", required=True)
    etl = jobs.add_parser("etl", help="store the log lines of one day as events")
    etl.add_argument("date")
    etl.add_argument("--logs", required=True)
    etl.add_argument("--ip-rules", required=True)
    etl.add_argument("--warehouse", required=True)
    etl.add_argument("--landed", action="store_true", help="the logs are those the landing stream wrote")
    daily = jobs.add_parser("daily", help="write the facts of one day")
    daily.add_argument("date")
    daily.add_argument("--warehouse", required=True)
    visits = jobs.add_parser("visits", help="write the sessions that ended on a day and its new users")
    visits.add_argument("date")
    visits.add_argument("--warehouse", required=True)
    repair = jobs.add_parser("repair", help="build closed days of the live flow anew where late events came")
    repair.add_argument("--warehouse", required=True)
    repair.add_argument("--open-days", type=int, default=OPEN_DAYS)
    live = {
        "flow": "keep the flow per place up to date from a stream of log lines",
        "sessions": "keep the sessions of users right, however late a line comes",
        "events": "append events from a stream of log lines to the event store",
        "bad-records": "store the lines of a stream that cannot become events, with the reason",
        "landing": "store the lines of a stream as they are, by the hour they came in",
    }
    for name, purpose in live.items():
        job = jobs.add_parser(name, help=purpose)
        source = job.add_mutually_exclusive_group(required=True)
        source.add_argument("--path", help="folder that receives text files")
        source.add_argument("--servers", help="Kafka bootstrap servers (needs the connector)")
        job.add_argument("--topics", nargs="+", default=["event_log"])
        job.add_argument("--reset", default="latest", help="where to begin without a checkpoint")
        job.add_argument("--max-offsets", type=int)
        if name in ("flow", "events"):
            job.add_argument("--ip-rules", required=True)
        job.add_argument("--warehouse", required=True)
        job.add_argument("--checkpoint", required=True)
        job.add_argument("--every", default=FLOW_EVERY, help="micro-batch interval")
        job.add_argument("--once", action="store_true", help="take what is there and stop")
    args = parser.parse_args(argv)
    spark = build_session(f"sessionloom-{args.job}")
    if args.job == "etl":
        run_etl(spark, args.date, args.logs, args.ip_rules, args.warehouse, args.landed)
    elif args.job == "daily":
        run_daily(spark, args.date, args.warehouse)
    elif args.job == "visits":
        run_sessions(spark, args.date, args.warehouse)
        run_first_visits(spark, args.date, args.warehouse)
    elif args.job == "repair":
        for note in repair_flow(spark, f"{args.warehouse}/flow_log", args.warehouse, args.open_days):
            print({k: note[k] for k in ("day", "live", "counted", "dropped")})
    else:
        lines = text_lines(spark, args.path) if args.path else kafka_lines(
            spark, args.servers, args.topics, reset=args.reset, max_offsets_per_trigger=args.max_offsets)
        every = None if args.once else args.every
        if args.job == "flow":
            query = start_flow(lines, read_ip_rules(spark, args.ip_rules), f"{args.warehouse}/flow_log",
                               args.checkpoint, warehouse=args.warehouse, every=every)
        elif args.job == "events":
            query = start_event_load(lines, read_ip_rules(spark, args.ip_rules), f"{args.warehouse}/events",
                                     args.checkpoint, every)
        elif args.job == "sessions":
            query = start_sessions(lines, f"{args.warehouse}/live_sessions", args.checkpoint, every=every)
        elif args.job == "bad-records":
            query = start_bad_records(lines, f"{args.warehouse}/bad_lines", args.checkpoint, every)
        else:
            query = start_landing(lines, f"{args.warehouse}/landing", args.checkpoint, every=every)
        query.awaitTermination()


if __name__ == "__main__":
    main()
