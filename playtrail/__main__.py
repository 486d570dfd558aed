"""Command line for the end-to-end jobs.

    python -m playtrail attribution --clicks P --videos P --out P --rules R4 --from D --to D [--map-date D]
    python -m playtrail reload      --clicks P --videos P --table P [--day D] [--rules R3] [--map-date D]
    python -m playtrail delete-day  --table P --day D
    python -m playtrail prune       --table P
    python -m playtrail ordered     --table P --out P [--rules R4]
    python -m playtrail monitor     --attribution P --videos P --out P --from D --to D
    python -m playtrail funnel      --attribution P --videos P --source T --reached T --from D --to D

P is a path or the name of a catalog table. The session is taken from the environment (spark-submit); on a cluster
``spark.checkpoint.dir`` must name shared storage.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from .plans import jobs
from .plans.session import JOB_CONF


def main(argv=None) -> None:
    parser = argparse.ArgumentParser(prog="playtrail")
    sub = parser.add_subparsers(dest="job", required=True)

    a = sub.add_parser("attribution")
    a.add_argument("--clicks", required=True)
    a.add_argument("--videos", required=True)
    a.add_argument("--out", required=True)
    a.add_argument("--rules", default="R4")
    a.add_argument("--from", dest="from_date", required=True)
    a.add_argument("--to", dest="to_date", required=True)
    a.add_argument("--map-date")
    a.add_argument("--details-page", required=True, help="page-name prefix of the app's details pages")

    r = sub.add_parser("reload")
    r.add_argument("--clicks", required=True)
    r.add_argument("--videos", required=True)
    r.add_argument("--table", required=True)
    r.add_argument("--day")
    r.add_argument("--rules", default="R3")
    r.add_argument("--map-date")
    r.add_argument("--details-page", required=True, help="page-name prefix of the app's details pages")

    d = sub.add_parser("delete-day")
    d.add_argument("--table", required=True)
    d.add_argument("--day", required=True)

    p = sub.add_parser("prune")
    p.add_argument("--table", required=True)

    o = sub.add_parser("ordered")
    o.add_argument("--table", required=True)
    o.add_argument("--out", required=True)
    o.add_argument("--rules", default="R4")

    m = sub.add_parser("monitor")
    m.add_argument("--attribution", required=True)
    m.add_argument("--videos", required=True)
    m.add_argument("--out", required=True)
    m.add_argument("--from", dest="from_date", required=True)
    m.add_argument("--to", dest="to_date", required=True)

    f = sub.add_parser("funnel")
    f.add_argument("--attribution", required=True)
    f.add_argument("--videos", required=True)
    f.add_argument("--source", required=True)
    f.add_argument("--reached", required=True)
    f.add_argument("--from", dest="from_date", required=True)
    f.add_argument("--to", dest="to_date", required=True)

    args = parser.parse_args(argv)
    builder = SparkSession.builder.appName(f"playtrail-{args.job}")
    for key, value in JOB_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()

    if args.job == "attribution":
        jobs.attribution_job(
            spark, args.clicks, args.videos, args.out, args.rules,
            from_date=args.from_date, to_date=args.to_date, map_date=args.map_date, details_page=args.details_page,
        )
    elif args.job == "reload":
        day = jobs.daily_reload_job(
            spark, args.clicks, args.videos, args.table, args.day, args.rules,
            map_date=args.map_date, details_page=args.details_page,
        )
        print(f"reloaded {day}")
    elif args.job == "delete-day":
        jobs.delete_day_job(spark, args.table, args.day)
    elif args.job == "prune":
        jobs.prune_job(spark, args.table)
    elif args.job == "ordered":
        jobs.ordered_job(spark, args.table, args.out, args.rules)
    elif args.job == "monitor":
        jobs.monitor_job(spark, args.attribution, args.videos, args.out, from_date=args.from_date, to_date=args.to_date)
    else:
        jobs.funnel_job(
            spark, args.attribution, args.videos, args.source, args.reached,
            from_date=args.from_date, to_date=args.to_date,
        ).show(truncate=False)


if __name__ == "__main__":
    main()
