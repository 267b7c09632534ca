"""Train and evaluate a model on a stored feature table."""

import argparse

from ledgerlark.plans.training import TrainSpec, run
from ledgerlark.session import job_session


def main(argv: list[str] | None = None) -> dict:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--input", required=True)
    parser.add_argument("--model", default="gbt")
    parser.add_argument("--run_name")
    parser.add_argument("--seed", type=int, default=42)
    parser.add_argument("--split", default="hash")
    parser.add_argument("--max-iter", type=int)
    parser.add_argument("--ledger", help="Parquet folder of run records")
    parser.add_argument("--models", help="folder for fitted models")
    args = parser.parse_args(argv)
    spec = TrainSpec(model=args.model, seed=args.seed, split=args.split)
    if args.max_iter is not None:
        spec = spec.with_trees(max_iter=args.max_iter)
    spark = job_session(f"train_{args.model.lower()}")
    found = run(spark, args.input, spec, args.run_name, args.ledger, args.models)
    print(found)
    return found


if __name__ == "__main__":
    main()
