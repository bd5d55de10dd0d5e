"""Command line: ``python -m costledger <job> ...``.

    ingest  --source ROOT --state ROOT --rates TABLE [--policy drop|legacy] [--rate-policy latest|snapshot]
            [--convention multiply|divide] [--pad-missing] [--target-table T --registry-table R]
    rates   --payloads PATH --rates TABLE [--date YYYY-MM-DD]
    rebuild --source ROOT --rates TABLE --out PATH
    reset   --state ROOT [--target-table T --registry-table R]
"""
from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from .session import SCALE_CONF, ensure_checkpoint_dir


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="costledger")
    sub = ap.add_subparsers(dest="job", required=True)
    a = sub.add_parser("ingest")
    a.add_argument("--source", required=True)
    a.add_argument("--state", required=True)
    a.add_argument("--rates", required=True)
    a.add_argument("--policy", default="drop")
    a.add_argument("--rate-policy", default="latest")
    a.add_argument("--convention", default="multiply")
    a.add_argument("--allow-empty", action="store_true")
    a.add_argument("--pad-missing", action="store_true", help="read files that lack a column with NULLs")
    a.add_argument("--target-table", help="catalog table partitioned by dt (rewrites touched dates only)")
    a.add_argument("--registry-table")
    r = sub.add_parser("rates")
    r.add_argument("--payloads", required=True)
    r.add_argument("--rates", required=True)
    r.add_argument("--date")
    b = sub.add_parser("rebuild")
    b.add_argument("--source", required=True)
    b.add_argument("--rates", required=True)
    b.add_argument("--out", required=True)
    z = sub.add_parser("reset")
    z.add_argument("--state", required=True)
    z.add_argument("--target-table")
    z.add_argument("--registry-table")
    args = ap.parse_args(argv)

    builder = SparkSession.builder.appName(f"costledger-{args.job}")
    for k, v in SCALE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    from .plans import jobs
    tables = (args.target_table, args.registry_table) if getattr(args, "target_table", None) else None
    if args.job == "ingest":
        res = jobs.run_ingest(spark, args.source, args.state, args.rates, rate_policy=args.rate_policy,
                              policy=args.policy, convention=args.convention, allow_empty=args.allow_empty,
                              pad_missing=args.pad_missing, tables=tables)
        print(json.dumps(res.summary.first().asDict()))
    elif args.job == "rates":
        print(json.dumps({"rows": jobs.load_rates(spark, args.payloads, args.rates, args.date)}))
    elif args.job == "rebuild":
        jobs.run_rebuild(spark, args.source, args.rates).write.mode("overwrite").parquet(args.out)
    elif args.job == "reset":
        print(json.dumps(jobs.reset_state(spark, args.state, tables=tables)))


if __name__ == "__main__":
    main()
