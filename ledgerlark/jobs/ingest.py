"""Ingest a topic into bronze and silver tables, until stopped."""

import argparse

from ledgerlark.jobs.common import add_topic_arguments, topic_from
from ledgerlark.operators.dedup import FOREVER, TABLE, WATERMARK
from ledgerlark.plans.ingest import WATERMARK_MINUTES
from ledgerlark.session import job_session
from ledgerlark.sources.streams import LandingFolder
from ledgerlark.streaming.ingest import configure_state, start_ingest, wait


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--tables", required=True, help="root folder of bronze and silver")
    parser.add_argument("--checkpoints", required=True, help="root folder of the checkpoints")
    parser.add_argument("--landing", help="read message files from here instead of the topic")
    parser.add_argument("--watermark-minutes", type=int, default=WATERMARK_MINUTES)
    parser.add_argument("--dedup", choices=[FOREVER, WATERMARK, TABLE], default=FOREVER)
    parser.add_argument("--state-partitions", type=int, help="fixed by the first start")
    parser.add_argument("--keep-bad", action="store_true")
    parser.add_argument("--silver-from-topic", action="store_true", help="read the topic per query")
    parser.add_argument("--drain", action="store_true", help="stop at the end of the input")
    add_topic_arguments(parser)
    args = parser.parse_args(argv)
    spark = job_session("ingest")
    configure_state(spark, args.state_partitions)
    queries = start_ingest(
        spark,
        LandingFolder(args.landing) if args.landing else topic_from(args),
        args.tables,
        args.checkpoints,
        args.watermark_minutes,
        args.dedup,
        args.keep_bad,
        not args.silver_from_topic,
        drain=args.drain,
    )
    if args.drain:
        for query in queries:
            query.awaitTermination()
    else:
        wait(spark)


if __name__ == "__main__":
    main()
