"""Command line: run a job with the session the launcher provides.

    spark-submit affinity/__main__.py report --ratings u.data --target 201 --out out/report
    spark-submit affinity/__main__.py ingest --train t/ --catalogs c/ --item-ratings r/ \\
        --catalog-path p/ --items items/ --out out/graph
    spark-submit affinity/__main__.py recommend --merged out/graph/merged --catalogs c/ \\
        --brothers out/graph/catalog_brothers --items items/ --test-items test/ --out out/rec

with the package importable (``PYTHONPATH`` locally, ``--py-files`` on a
cluster), or ``python -m affinity ...`` for a local run. Paths are read and
written as given; use shared storage on a cluster.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from affinity.plans import jobs


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="affinity")
    sub = ap.add_subparsers(dest="cmd", required=True)
    r = sub.add_parser("report", help="rating report (one JSON document)")
    r.add_argument("--ratings", required=True)
    r.add_argument("--target", type=int, required=True)
    r.add_argument("--out", required=True)
    r.add_argument("--header", action="store_true")
    g = sub.add_parser("ingest", help="merge click edges, persist lookups")
    for a in ("train", "catalogs", "item-ratings", "catalog-path", "items", "out"):
        g.add_argument(f"--{a}", required=True)
    c = sub.add_parser("recommend", help="rank candidates of every target")
    for a in ("merged", "catalogs", "brothers", "items", "test-items", "out"):
        c.add_argument(f"--{a}", required=True)
    args = ap.parse_args(argv)

    spark = SparkSession.builder.appName(f"affinity-{args.cmd}").getOrCreate()
    if args.cmd == "report":
        jobs.rating_report_job(spark, args.ratings, args.target, args.out, header=args.header)
        print(json.dumps({"report": args.out}))
    elif args.cmd == "ingest":
        print(json.dumps(jobs.graph_ingest_job(spark, args.train, args.catalogs, args.item_ratings,
                                               args.catalog_path, args.items, args.out)))
    else:
        print(json.dumps(jobs.recommend_job(spark, args.merged, args.catalogs, args.brothers,
                                            args.items, args.test_items, args.out)))


if __name__ == "__main__":
    main()
