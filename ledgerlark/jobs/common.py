"""Command-line arguments shared by the jobs."""

import argparse
import os

from ledgerlark.sources.streams import KafkaTopic


def add_topic_arguments(parser: argparse.ArgumentParser) -> None:
    parser.add_argument("--servers", default="localhost:9092")
    parser.add_argument("--topic", default="transactions")
    parser.add_argument("--starting-offsets", default="earliest")
    parser.add_argument("--security-protocol")
    parser.add_argument("--sasl-mechanism")
    parser.add_argument("--username", help="the password comes from KAFKA_PASSWORD")
    parser.add_argument("--max-offsets-per-trigger", type=int)
    parser.add_argument(
        "--kafka-option",
        action="append",
        default=[],
        metavar="NAME=VALUE",
        help="further client setting, e.g. kafka.compression.type=gzip",
    )


def topic_from(args: argparse.Namespace) -> KafkaTopic:
    return KafkaTopic(
        servers=args.servers,
        topic=args.topic,
        starting_offsets=args.starting_offsets,
        security_protocol=args.security_protocol,
        sasl_mechanism=args.sasl_mechanism,
        username=args.username,
        password=os.environ.get("KAFKA_PASSWORD"),
        max_offsets_per_trigger=args.max_offsets_per_trigger,
        options=dict(o.split("=", 1) for o in args.kafka_option),
    )
