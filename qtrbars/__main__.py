"""Command line: run the pipelines on landed folders.

    python -m qtrbars universe --prices P --mapping M --out DIR [--digits leading]
    python -m qtrbars av|fmp --landing DIR --lake DIR
    python -m qtrbars yahoo --landing DIR --lake DIR [--format csv2]
    python -m qtrbars ingest --vendor AV --landing DIR --lake DIR
    python -m qtrbars pending --universe P --lake DIR --source AV --out DIR [--skip N] [--batches 7]
    python -m qtrbars vacuum --lake DIR [--keep 2]

``--lake`` receives ``bars/``, ``not_available/``, ``quarantine/``, ``manifest/``
and ``bars_index/`` as versioned bucket tables; stream checkpoints go to
``<lake>/_checkpoints``. ``pending`` writes the tickers that still need a fetch, in
symbol order with their position and the batch they are dealt to; ``vacuum`` drops
old versions. The session is the one spark-submit provides (or a
local one); nothing is collected to the driver.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession


def _session() -> SparkSession:
    from .session import apply_conf
    spark = SparkSession.builder.appName("qtrbars").getOrCreate()
    apply_conf(spark)
    return spark


def _paths(lake: str) -> dict:
    return {k: f"{lake.rstrip('/')}/{k}" for k in ("bars", "not_available", "quarantine", "manifest")}


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    ap = argparse.ArgumentParser(prog="qtrbars")
    sub = ap.add_subparsers(dest="cmd", required=True)
    u = sub.add_parser("universe")
    u.add_argument("--prices", required=True)
    u.add_argument("--mapping", required=True)
    u.add_argument("--out", required=True)
    u.add_argument("--digits", choices=["any", "leading"], default="any")
    for name in ("av", "fmp", "yahoo"):
        p = sub.add_parser(name)
        p.add_argument("--landing", required=True)
        p.add_argument("--lake", required=True)
        if name == "yahoo":
            p.add_argument("--format", default="parquet")
    g = sub.add_parser("ingest")
    g.add_argument("--vendor", choices=["AV", "FMP"], required=True)
    g.add_argument("--landing", required=True)
    g.add_argument("--lake", required=True)
    g.add_argument("--landing-format", choices=["parquet", "text"], default="parquet")
    q = sub.add_parser("pending")
    q.add_argument("--universe", required=True)
    q.add_argument("--lake", required=True)
    q.add_argument("--source", required=True)
    q.add_argument("--out", required=True)
    q.add_argument("--skip", type=int, default=0)
    q.add_argument("--batches", type=int, default=1)
    v = sub.add_parser("vacuum")
    v.add_argument("--lake", required=True)
    v.add_argument("--keep", type=int, default=2)
    args = ap.parse_args(argv)

    from .plans import pipelines as P
    spark = spark or _session()

    if args.cmd == "universe":
        (P.universe(spark, args.prices, args.mapping, digits=args.digits)
          .write.mode("overwrite").parquet(args.out))
        return 0
    paths = _paths(args.lake)
    if args.cmd == "pending":
        from pyspark.sql import functions as F
        from .sinks.ordered import read_ordered, write_ordered
        work = P.pending_work(spark, spark.read.parquet(args.universe), paths["bars"], args.source)
        write_ordered(work, f"{args.out}/ordered", ["ticker"])
        left = read_ordered(spark, f"{args.out}/ordered", skip=args.skip)
        left.withColumn("batch", F.col("position") % args.batches).write.mode("overwrite").parquet(f"{args.out}/batches")
        return 0
    if args.cmd == "vacuum":
        from .sinks.buckets import vacuum
        for path in [*paths.values(), P.index_path(paths["bars"])]:
            vacuum(spark, path, args.keep)
        return 0
    if args.cmd in ("av", "fmp"):
        run = P.av_quarterly if args.cmd == "av" else P.fmp_quarterly
        out = run(spark, args.landing)
        P.publish(out, paths["bars"], paths["not_available"], paths["quarantine"],
                  manifest_path=paths["manifest"])
        return 0
    if args.cmd == "yahoo":
        bars, rejected = P.yahoo_quarterly_from_wide(spark, args.landing, fmt=args.format)
        P.publish_yahoo(bars, rejected, paths["bars"], paths["quarantine"], paths["manifest"])
        return 0
    from .streaming.ingest import run_ingest
    run_ingest(spark, args.landing, args.vendor, paths["bars"], paths["not_available"],
               paths["quarantine"], f"{args.lake.rstrip('/')}/_checkpoints/{args.vendor}",
               fmt=args.landing_format, manifest_path=paths["manifest"])
    return 0


if __name__ == "__main__":
    sys.exit(main())
