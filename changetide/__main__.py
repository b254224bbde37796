"""Command line: `python -m changetide <job> ...`, or with `spark-submit`."""

from __future__ import annotations

import argparse
import datetime as dt

from changetide.operators.bursts import peak_burst
from changetide.operators.retention import expired_dumps
from changetide.operators.rollups import refresh_rollups
from changetide.operators.status import db_stats
from changetide.operators.trends import top_pages
from changetide.plans.load import load_batch
from changetide.schema import BURST_SECONDS, DEFAULT_MAX_AGE_DAYS
from changetide.session import build_session
from changetide.sources.dumps import list_dumps
from changetide.sources.tables import read_changes
from changetide.streaming.jobs import stream_load


def _arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="changetide")
    jobs = parser.add_subparsers(dest="job", required=True)

    load = jobs.add_parser("load", help="load dumps as one batch")
    load.add_argument("table")
    load.add_argument("files", nargs="+")
    stream = jobs.add_parser("stream", help="load the dumps of a folder not loaded before")
    stream.add_argument("table")
    stream.add_argument("folder")
    stream.add_argument("checkpoint")
    for job in (load, stream):
        job.add_argument("--registry")
        job.add_argument("--rollups")

    refresh = jobs.add_parser("refresh", help="recompute the rollups")
    refresh.add_argument("table")
    refresh.add_argument("rollups")

    expired = jobs.add_parser("expired", help="report dumps past their age (nothing is removed)")
    expired.add_argument("folder")
    expired.add_argument("--max-age-in-days", type=int, default=DEFAULT_MAX_AGE_DAYS)

    stats = jobs.add_parser("stats", help="range, age and size of the table, and its top pages")
    stats.add_argument("table")
    stats.add_argument("--wiki", default="enwiki")
    stats.add_argument("--since")

    burst = jobs.add_parser("burst", help="the interval with most events")
    burst.add_argument("table")
    burst.add_argument("--seconds", type=int, default=BURST_SECONDS)
    return parser.parse_args()


def main() -> None:
    args = _arguments()
    spark = build_session()
    now = dt.datetime.now(dt.timezone.utc)
    if args.job == "load":
        load_batch(spark, args.files, args.table, args.registry, args.rollups).show(truncate=False)
    elif args.job == "stream":
        stream_load(
            spark, args.folder, args.table, args.checkpoint, args.registry, args.rollups
        ).awaitTermination()
    elif args.job == "refresh":
        refresh_rollups(spark, args.table, args.rollups)
    elif args.job == "expired":
        # `show` prints the first ones only; a report is whole.
        for row in expired_dumps(list_dumps(spark, args.folder), now, args.max_age_in_days).toLocalIterator():
            print(row["path"])
    elif args.job == "stats":
        changes = read_changes(spark, args.table)
        top_pages(changes, args.wiki, args.since).show(truncate=False)
        db_stats(changes, now).show(truncate=False)
    else:
        peak_burst(read_changes(spark, args.table), seconds=args.seconds).show(truncate=False)
    spark.stop()


if __name__ == "__main__":
    main()
