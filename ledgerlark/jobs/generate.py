"""Generate transactions into a topic or a Parquet folder of messages."""

import argparse

from pyspark.sql import functions as F

from ledgerlark.jobs.common import add_topic_arguments, topic_from
from ledgerlark.schema import PAYLOAD
from ledgerlark.session import job_session
from ledgerlark.sinks.publish import encode, publish
from ledgerlark.sources.synthetic import Params, generate


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--rows", type=int, required=True)
    parser.add_argument("--seed", type=int, default=42)
    parser.add_argument("--high-risk-share", type=float, default=0.0)
    parser.add_argument("--output", help="folder for the encoded messages; default: the topic")
    add_topic_arguments(parser)
    args = parser.parse_args(argv)
    # A row takes many expressions. As one generated method they exceed the 8000 bytes up to
    # which the JVM compiles; beyond this limit Spark runs them as several methods.
    spark = job_session("generate", **{"spark.sql.codegen.hugeMethodLimit": "8000"})
    params = Params(seed=args.seed, high_risk_share=args.high_risk_share)
    rows = generate(spark, args.rows, params=params).select(*PAYLOAD)
    if args.output:
        stamped = encode(rows).withColumn("timestamp", F.current_timestamp())
        stamped.write.mode("append").parquet(args.output)
    else:
        publish(rows, topic_from(args))


if __name__ == "__main__":
    main()
