"""Command line: list and run queries, and the arguments batch jobs share."""

from __future__ import annotations

import argparse
import re
from dataclasses import dataclass
from datetime import date, datetime


@dataclass(frozen=True)
class Selection:
    """What a batch job reads."""

    mode: str
    day: str | None


def day(text: str) -> str:
    if not re.fullmatch(r"\d{4}-\d\d-\d\d", text):
        raise argparse.ArgumentTypeError(f"not a YYYY-MM-DD date: {text!r}")
    date.fromisoformat(text)
    return text


def add_selection(p: argparse.ArgumentParser) -> None:
    p.add_argument("--source-mode", choices=["daily", "historical", "all"], default="daily")
    p.add_argument("--ingested-date", type=day)


def selection(p: argparse.ArgumentParser, args: argparse.Namespace) -> Selection:
    """Daily mode needs a date; the others take none."""
    if args.source_mode == "daily" and not args.ingested_date:
        p.error("--ingested-date is required in daily mode")
    if args.source_mode != "daily" and args.ingested_date:
        p.error("--ingested-date goes with daily mode only")
    return Selection(args.source_mode, args.ingested_date)


def window(start: str, end: str, max_days: int | None = None) -> tuple[datetime, datetime]:
    """[start, end) of two ISO times; an empty or too long one raises."""
    a, b = datetime.fromisoformat(start), datetime.fromisoformat(end)
    if b <= a:
        raise ValueError("end must be after start")
    if max_days is not None and (b - a).days > max_days:
        raise ValueError(f"more than {max_days} days")
    return a, b


def main(argv: list[str] | None = None) -> int:
    from tidewell.plans import registry

    p = argparse.ArgumentParser(prog="tidewell")
    sub = p.add_subparsers(dest="command", required=True)
    sub.add_parser("list", help="names of all queries")
    run = sub.add_parser("run", help="run a query over a folder of tables")
    run.add_argument("query", choices=sorted(registry.queries()))
    run.add_argument("--data", required=True)
    run.add_argument("--out", help="folder for Parquet; without it, rows are shown")
    args = p.parse_args(argv)
    if args.command == "list":
        print("\n".join(sorted(registry.queries())))
        return 0
    from tidewell.session import build_session

    df = registry.queries()[args.query](build_session(), args.data)
    if args.out:
        df.write.mode("errorifexists").parquet(args.out)
    else:
        df.show(20, truncate=False)
    return 0
