"""Build the feature table of a run date from silver."""

import argparse
import datetime as dt

from ledgerlark.plans.features import run
from ledgerlark.session import job_session


def main(argv: list[str] | None = None) -> str:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--input", required=True)
    parser.add_argument("--output", required=True)
    parser.add_argument("--date", help="run date, default: today in UTC")
    day = dt.date.fromisoformat
    parser.add_argument("--from-date", type=day, help="first event date to emit")
    parser.add_argument("--to-date", type=day, help="last event date to emit")
    parser.add_argument("--files", type=int, help="number of output files")
    args = parser.parse_args(argv)
    if (args.from_date is None) != (args.to_date is None):
        parser.error("--from-date and --to-date go together")
    dates = (args.from_date, args.to_date) if args.from_date else None
    spark = job_session("build_features")
    path = run(spark, args.input, args.output, args.date, dates, args.files)
    print(f"features written to {path}")
    return path


if __name__ == "__main__":
    main()
