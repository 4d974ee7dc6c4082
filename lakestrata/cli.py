"""Command-line jobs: what the reference runs as scripts, as spark-submit-able jobs.

    python -m lakestrata.cli daily    --ods PATH --out ROOT [--since D] [--until D] [--tz Z] [--concurrency N]
    python -m lakestrata.cli clicks   --out ROOT_OR_DATABASE (--path DIR | --bootstrap H --topic T) [--trigger "1 minute"]
    python -m lakestrata.cli listings --target PATH [--rejects PATH] (--path DIR | --bootstrap H --topic T)
    python -m lakestrata.cli ingest   --target PATH --rejects PATH [--delivered PATH] (--path DIR | --bootstrap H --topic T)
    python -m lakestrata.cli publish  --csv PATH (--out DIR | --bootstrap H --topic T) [--partitions 2] [--tz Z]
    python -m lakestrata.cli compact  --path PATH_OR_TABLE [--partition dt] [--target-bytes N] [--key C --order C ...]

Checkpoints go under ``spark.checkpoint.dir`` (``--checkpoint`` overrides).
Streaming jobs run until stopped, or drain what is available and stop with
``--available-now``; ``--max-files`` / ``--max-offsets`` pace the intake of a batch.
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import SparkSession

from .functions import constants as K


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="lakestrata")
    sub = p.add_subparsers(dest="job", required=True)

    d = sub.add_parser("daily", help="ODS -> DWD -> DWS/ADS daily warehouse")
    d.add_argument("--ods", required=True, help="flat ODS listing table (Parquet folder or name)")
    d.add_argument("--out", required=True, help="root folder of the warehouse tables")
    d.add_argument("--since"), d.add_argument("--until")
    d.add_argument("--tz", default=None, help="zone of the ds key (default: session zone)")
    d.add_argument("--blacklist", default=",".join(K.CITY_BLACKLIST))
    d.add_argument("--concurrency", type=int, default=1,
                   help="run the eight DWS/ADS loads as this many concurrent Spark jobs")

    for name, helptext in (("clicks", "click stream -> ODS/DWD + 10-minute metrics"),
                           ("listings", "listing stream -> validated ODS upsert"),
                           ("ingest", "raw listings -> first valid message per house, rejects")):
        s = sub.add_parser(name, help=helptext)
        s.add_argument("--path", help="folder of JSON-lines messages (file source)")
        s.add_argument("--bootstrap", help="Kafka bootstrap servers")
        s.add_argument("--topic", help="Kafka topic")
        s.add_argument("--checkpoint", help="checkpoint root (default: spark.checkpoint.dir)")
        s.add_argument("--trigger", default="1 minute")
        s.add_argument("--available-now", action="store_true")
        s.add_argument("--max-files", type=int, help="files a batch takes in (file source)")
        s.add_argument("--max-offsets", type=int, help="messages a batch takes in (Kafka)")
        if name == "clicks":
            s.add_argument("--out", required=True, help="root folder or catalog database of the lake tables")
        else:
            s.add_argument("--target", required=True, help="folder of the delivered rows (listings: ODS change log)")
            s.add_argument("--rejects", required=name == "ingest", help="folder of the rejected rows")
        if name == "ingest":
            s.add_argument("--delivered", help="table of houses that were delivered before")

    b = sub.add_parser("publish", help="click CSV -> normalised messages, in order per user")
    b.add_argument("--csv", required=True)
    b.add_argument("--out", help="folder of message files"), b.add_argument("--bootstrap"), b.add_argument("--topic")
    b.add_argument("--partitions", type=int, default=2, help="partitions of the topic")
    b.add_argument("--tz", default=None, help="zone of the readable event time (default: session zone)")

    c = sub.add_parser("compact", help="merge small files of a folder or table into ~target-size files")
    c.add_argument("--path", required=True)
    c.add_argument("--partition", default=[], action="append")
    c.add_argument("--target-bytes", type=int, default=K.TARGET_FILE_BYTES)
    c.add_argument("--key", default=[], action="append", help="fold a change log: keep the latest row per key")
    c.add_argument("--order", default=[], action="append", help="what makes a row the latest")
    return p


def _source(args) -> dict:
    if args.bootstrap:
        return {"source": "kafka", "max_offsets": args.max_offsets,
                "options": {"kafka.bootstrap.servers": args.bootstrap, "subscribe": args.topic}}
    return {"source": "text", "path": args.path, "max_files": args.max_files}


def main(argv: list[str] | None = None, spark: SparkSession | None = None):
    args = _parser().parse_args(argv)
    from .session import build_session, checkpoint_root
    spark = spark or build_session(app=f"lakestrata-{args.job}")

    if args.job == "daily":
        from .operators.aggregate import latest_per_key
        from .plans.listings import run_daily
        from .schemas import ODS_KEYS
        from .sources.batch import read_table
        ods = read_table(spark, args.ods)
        if "load_id" in ods.columns:      # a change log: its latest rows
            ods = latest_per_key(ods.drop("load_id"), list(ODS_KEYS), ["event_time", "trace_id"])
        return run_daily(ods, args.out, tz=args.tz,
                         blacklist=tuple(x for x in args.blacklist.split(",") if x),
                         since=args.since, until=args.until, concurrency=args.concurrency)

    if args.job == "compact":
        from .sinks.compaction import compact
        return compact(spark, args.path, args.partition, args.target_bytes, args.key, args.order)

    if args.job == "publish":
        from .sinks.files import publish_events
        from .sources.batch import normalise_click_log, read_click_csv
        clicks = normalise_click_log(read_click_csv(spark, args.csv), args.tz)
        kafka = {"kafka.bootstrap.servers": args.bootstrap, "topic": args.topic}
        return publish_events(clicks, fmt="kafka" if args.bootstrap else "json", path=args.out,
                              options=kafka if args.bootstrap else None, partitions=args.partitions)

    from .streaming import jobs
    from .streaming.sinks import LateRows
    from .streaming.sources import read_click_stream, read_listing_stream
    late = LateRows()
    spark.streams.addListener(late)
    trigger = {"availableNow": True} if args.available_now else {"processingTime": args.trigger}
    ckpt = args.checkpoint or os.path.join(checkpoint_root(spark), f"lakestrata-{args.job}")
    if args.job == "clicks":
        queries = jobs.run_click_pipeline(read_click_stream(spark, **_source(args)), args.out, ckpt, trigger)
    elif args.job == "ingest":
        from .sources.batch import read_table
        delivered = read_table(spark, args.delivered) if args.delivered else None
        queries = jobs.listing_ingest_stream(read_listing_stream(spark, **_source(args)), args.target, args.rejects, ckpt,
                                             delivered, trigger)
    else:
        queries = [jobs.run_listing_pipeline(read_listing_stream(spark, **_source(args)), args.target, ckpt, trigger,
                                             args.rejects)]
    for q in queries:
        q.awaitTermination()
    spark.streams.removeListener(late)
    for query, rows in late.dropped.items():
        if rows:
            print(f"query {query}: {rows} rows dropped behind the watermark")
    return queries


if __name__ == "__main__":
    main()
