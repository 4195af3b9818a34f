"""Command line for the three jobs (run under spark-submit or plain python).

    python -m faultline etl   --csv RAW.csv --out COLLECTION
    python -m faultline train --source COLLECTION --work DIR --registry DIR
    python -m faultline score --input CSV_DIR --registry DIR --out DIR

The truck-sensor column layout is the default spec.  Paths are URIs; the Spark master
comes from spark-submit (or ``--master`` for local runs).
"""

from __future__ import annotations

import argparse
import json

from faultline.operators import training
from faultline.plans import jobs
from faultline.session import get_session
from faultline.spec import TRUCK_SPEC


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="faultline")
    ap.add_argument("--master", default=None)
    sub = ap.add_subparsers(dest="cmd", required=True)
    e = sub.add_parser("etl", help="preamble CSV -> downsampled document collection")
    e.add_argument("--csv", required=True)
    e.add_argument("--out", required=True)
    e.add_argument("--ratio", type=float, default=0.3)
    e.add_argument("--seed", type=int, default=42)
    e.add_argument("--header-line", type=int, default=14)
    t = sub.add_parser("train", help="ingest, validate, transform, train, evaluate, promote")
    t.add_argument("--source", required=True)
    t.add_argument("--work", required=True)
    t.add_argument("--registry", required=True)
    t.add_argument("--reference-grid", action="store_true", help="search the reference's tree sizes")
    t.add_argument("--resample-test", action="store_true")
    t.add_argument("--nan-policy", choices=["omit", "propagate"], default="omit")
    s = sub.add_parser("score", help="batch scoring with the latest registered model")
    s.add_argument("--input", required=True)
    s.add_argument("--registry", required=True)
    s.add_argument("--out", required=True)
    args = ap.parse_args(argv)

    spark = get_session(args.master)
    if args.cmd == "etl":
        n = jobs.run_etl(spark, args.csv, args.out, ratio=args.ratio, seed=args.seed, header_line=args.header_line)
        print(json.dumps({"rows_loaded": n}))
    elif args.cmd == "train":
        res = jobs.run_training(
            spark, args.source, TRUCK_SPEC, args.work, args.registry,
            grid=training.REFERENCE_GRID if args.reference_grid else None,
            resample_test=args.resample_test, nan_policy=args.nan_policy,
        )
        print(json.dumps({"run_dir": res.run_dir, "no_drift": res.no_drift, "accepted": res.accepted, "version": res.version}))
    else:
        out = jobs.run_scoring(spark, args.input, TRUCK_SPEC, args.registry, args.out)
        print(json.dumps({"rows_scored": out.count()}))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
