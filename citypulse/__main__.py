"""``spark-submit``-able entry: ``python -m citypulse flow 202501 --source DIR --root DIR`` and the like."""

from __future__ import annotations

import argparse
import datetime as dt

from citypulse.plans import jobs
from citypulse.session import build_session
from citypulse.sources import files

RESIDENT_INPUTS = ["heads", "members", "moves_in", "moves_out", "addresses", "address_grid"]


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="citypulse")
    top.add_argument("--root", required=True, help="folder of the result tables")
    kinds = top.add_subparsers(dest="job", required=True)
    flow = kinds.add_parser("flow", help="load a month of flow and write its reports")
    flow.add_argument("ym", help="month, yyyyMM")
    flow.add_argument("--source", required=True)
    economy = kinds.add_parser("economy", help="business statistics and payments")
    economy.add_argument("target", choices=jobs.ECONOMY_TARGETS)
    economy.add_argument("--source", required=True)
    residents = kinds.add_parser("residents", help="households, movers and residents by cell")
    residents.add_argument("--tables", required=True, help="folder with the parquet inputs")
    residents.add_argument("--as-of-date", type=dt.date.fromisoformat, default=None)
    residents.add_argument("--snapshot", default=None)
    score = kinds.add_parser("score", help="predict people for the newest slot")
    score.add_argument("--summary", required=True)
    score.add_argument("--ap-cells", required=True)
    score.add_argument("--model", required=True)
    presence = kinds.add_parser("presence", help="stay categories, places and paths")
    presence.add_argument("--log", required=True, help="described log, parquet")
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = build_session()
    if args.job == "flow":
        jobs.flow_month(spark, args.source, args.ym, args.root)
    elif args.job == "economy":
        jobs.economy_tables(spark, args.source, args.target, args.root)
    elif args.job == "residents":
        tables = {name: files.read_parquet(spark, f"{args.tables}/{name}") for name in RESIDENT_INPUTS}
        jobs.resident_tables(tables, args.root, args.as_of_date or dt.date.today(), args.snapshot)
    elif args.job == "score":
        summary = files.read_parquet(spark, args.summary)
        jobs.score_newest_slot(summary, files.read_parquet(spark, args.ap_cells), args.model, args.root)
    elif args.job == "presence":
        jobs.presence_tables(files.read_parquet(spark, args.log), args.root)


if __name__ == "__main__":
    main()
