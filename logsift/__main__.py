"""Command line: ``python -m logsift <job> ...`` (e.g. under spark-submit).

The session comes from ``SparkSession.builder.getOrCreate()``, so master,
executors and ``spark.checkpoint.dir`` are whatever the launcher configured.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from logsift import jobs


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="logsift")
    sub = ap.add_subparsers(dest="job", required=True)

    p = sub.add_parser("ingest", help="live pipeline: log files -> events and alerts tables")
    p.add_argument("logs")
    p.add_argument("events")
    p.add_argument("alerts")
    p.add_argument("checkpoint")
    p.add_argument("--continuous", action="store_true", help="keep running (default: process what is there)")
    p.add_argument("--max-files-per-trigger", type=int)
    p.add_argument("--max-bytes-per-trigger", default=jobs.MAX_BYTES_PER_TRIGGER)
    p.add_argument("--progress", help="table of a row per micro-batch")
    p.add_argument("--rejects", help="folder for lines that match no format")

    p = sub.add_parser("compact", help="finished days of the live events table in few files")
    p.add_argument("events")
    p.add_argument("archive")
    p.add_argument("before", help="first day to leave out")

    p = sub.add_parser("summary", help="end-of-run report")
    p.add_argument("events")
    p.add_argument("alerts")
    p.add_argument("--out")

    p = sub.add_parser("metrics", help="metrics series of a stored run")
    p.add_argument("events")
    p.add_argument("alerts")
    p.add_argument("out")
    p.add_argument("--interval", type=int, default=jobs.T.INTERVAL_SEC)

    p = sub.add_parser("alerts", help="alert rule over a stored events table")
    p.add_argument("events")
    p.add_argument("alerts")
    p.add_argument("--clock", choices=jobs.CLOCKS, default="timestamp")
    p.add_argument("--rule", choices=list(jobs.RULES), default="event")
    p.add_argument("--start", help="first indexed_at")
    p.add_argument("--end", help="indexed_at limit, exclusive")

    p = sub.add_parser("preprocess", help="keep suspicious lines, sample normal ones, shuffle")
    p.add_argument("logs")
    p.add_argument("out")
    p.add_argument("--sample", type=int, default=0)

    p = sub.add_parser("latency", help="latency statistics of an events table")
    p.add_argument("events")
    p.add_argument("--out")

    p = sub.add_parser("export", help="events, alerts and summary as CSV")
    p.add_argument("events")
    p.add_argument("alerts")
    p.add_argument("out")
    p.add_argument("--limit", type=int, default=0)

    p = sub.add_parser("analyze", help="run-comparison tables from metric CSVs and latency JSON")
    p.add_argument("metrics")
    p.add_argument("out")
    p.add_argument("--latency")
    p.add_argument("--records")

    a = ap.parse_args(argv)
    spark = SparkSession.builder.appName(f"logsift-{a.job}").getOrCreate()
    if a.job == "ingest":
        qs = jobs.ingest(spark, a.logs, a.events, a.alerts, a.checkpoint, available_now=not a.continuous,
                         max_files_per_trigger=a.max_files_per_trigger, max_bytes_per_trigger=a.max_bytes_per_trigger,
                         progress_path=a.progress, rejects_path=a.rejects)
        for q in qs:
            q.awaitTermination()
    elif a.job == "alerts":
        jobs.batch_alerts(spark, a.events, a.alerts, a.clock, a.start, a.end, a.rule)
    elif a.job == "compact":
        jobs.compact(spark, a.events, a.archive, a.before)
    elif a.job == "summary":
        for name, df in jobs.summary(spark, a.events, a.alerts, a.out).items():
            print(name)
            df.show(50, truncate=False)
    elif a.job == "metrics":
        jobs.metrics(spark, a.events, a.alerts, a.out, a.interval)
    elif a.job == "preprocess":
        print(json.dumps(jobs.preprocess(spark, a.logs, a.out, a.sample)))
    elif a.job == "latency":
        print(json.dumps(jobs.latency_report(spark, a.events, a.out).collect()[0].asDict()))
    elif a.job == "export":
        jobs.export(spark, a.events, a.alerts, a.out, a.limit)
    elif a.job == "analyze":
        for name, df in jobs.analyze_runs(spark, a.metrics, a.latency, a.records).items():
            df.write.mode("overwrite").parquet(f"{a.out}/{name}")


if __name__ == "__main__":
    main()
