"""Run the production job: spark-submit run_job.py --history ... --checkpoints ...

Reads the bus named by --servers (with the Kafka connector on the class path), or Parquet
files of bus rows under --files. Results go to --results, or to the console without it. With
--compact-before it merges the closed days of the histories instead; the job may go on meanwhile.
"""

import argparse
import datetime as dt

from tidewatch.session import build_session
from tidewatch.sources import kafka_records, record_files
from tidewatch.streaming import jobs, sinks


def main() -> None:
    args = argparse.ArgumentParser(description=__doc__)
    feed = args.add_mutually_exclusive_group(required=True)
    feed.add_argument("--servers", help="bus addresses, host:port[,host:port]")
    feed.add_argument("--files", help="folder of bus rows")
    args.add_argument("--history", required=True)
    args.add_argument("--checkpoints", required=True)
    args.add_argument("--results")
    args.add_argument("--starting", default="latest", help="first offsets: latest or earliest")
    args.add_argument("--max-per-trigger", type=int, help="messages, or files, per trigger")
    args.add_argument("--min-partitions", type=int, help="tasks to spread hot topics over")
    args.add_argument("--arrival-time", action="store_true")
    args.add_argument("--complete", action="store_true")
    args.add_argument("--watermark-policy", choices=("min", "max"), default="min",
                      help="max: the deviation does not wait for a silent feed")
    args.add_argument("--separate-windows", action="store_true",
                      help="each indicator reads the ticks itself instead of sharing their panes")
    args.add_argument("--compact-before", type=dt.date.fromisoformat, metavar="YYYY-MM-DD",
                      help="merge the histories' days before this one, and end")
    args.add_argument("--alerts", action="store_true", help="also run the alert rules")
    args.add_argument("--once", action="store_true", help="process what is there, then end")
    given = args.parse_args()

    spark = build_session("tidewatch-job")

    def source(topics):
        if given.files:
            return record_files(
                spark, given.files, topics=topics, streaming=True,
                files_per_trigger=given.max_per_trigger,
            )
        return kafka_records(
            spark, given.servers, topics, starting=given.starting,
            max_per_trigger=given.max_per_trigger, min_partitions=given.min_partitions,
        )

    job = jobs.Job(
        given.history,
        given.checkpoints,
        given.results,
        arrival_time=given.arrival_time,
        complete=given.complete,
        watermark_policy=given.watermark_policy,
        shared_panes=not given.separate_windows,
        trigger=sinks.ONCE if given.once else None,
    )
    if given.compact_before:
        print(jobs.compact_histories(spark, job, given.compact_before))
        return
    queries = jobs.start(spark, source, job)
    if given.alerts:
        queries |= jobs.start_alerting(spark, source, job)
    if given.once:
        for query in queries.values():
            query.awaitTermination()
    else:
        spark.streams.awaitAnyTermination()


if __name__ == "__main__":
    main()
