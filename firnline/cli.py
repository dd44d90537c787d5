"""Command line: list and run registered queries, validate and run declared pipelines."""

from __future__ import annotations

import argparse
import datetime
import sys
from collections.abc import Sequence


def period(text: str) -> tuple[datetime.date, datetime.date]:
    """A day, month or year, or two of them joined by a colon, as first and last day."""

    def ends(part: str) -> tuple[datetime.date, datetime.date]:
        n = [int(x) for x in part.split("-")]
        first = datetime.date(n[0], n[1] if len(n) > 1 else 1, n[2] if len(n) > 2 else 1)
        if len(n) > 2:
            return first, first
        after = datetime.date(n[0] + 1, 1, 1) if len(n) == 1 or n[1] == 12 else datetime.date(n[0], n[1] + 1, 1)
        return first, after - datetime.timedelta(days=1)

    try:
        parts = [ends(p) for p in text.split(":")]
    except ValueError as e:
        raise argparse.ArgumentTypeError(f"not a period: {text!r}") from e
    if len(parts) > 2 or parts[0][0] > parts[-1][1]:
        raise argparse.ArgumentTypeError(f"not a period: {text!r}")
    return parts[0][0], parts[-1][1]


def without_months(first: datetime.date, last: datetime.date, exclude: Sequence[int]) -> list[tuple[datetime.date, datetime.date]]:
    """The period's month segments but those of the excluded months."""
    out, day = [], first
    while day <= last:
        after = datetime.date(day.year + day.month // 12, day.month % 12 + 1, 1)
        if day.month not in exclude:
            out.append((day, min(last, after - datetime.timedelta(days=1))))
        day = after
    return out


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="firnline", description=__doc__)
    sub = p.add_subparsers(dest="command", required=True)
    sub.add_parser("list", help="names of the registered queries")
    run = sub.add_parser("run", help="write a query's result as Parquet")
    run.add_argument("query")
    run.add_argument("input")
    run.add_argument("output")
    steps = sub.add_parser("records", help="run a declared pipeline over Parquet records")
    steps.add_argument("definition", help="YAML file with procsteps")
    steps.add_argument("input")
    steps.add_argument("output")
    steps.add_argument("--period", type=period)
    steps.add_argument("--time", default="time")
    steps.add_argument("--exclude-months", type=int, nargs="*", default=[])
    steps.add_argument("--check", action="store_true", help="validate only")
    return p


def main(argv: Sequence[str] | None = None) -> int:
    a = parser().parse_args(argv)
    from firnline.plans import catalogue

    if a.command == "list":
        print("\n".join(sorted(catalogue.QUERIES)))
        return 0
    from pyspark.sql import functions as F

    from firnline.plans.steps import Pipeline, PipelineError
    from firnline.session import start
    from firnline.sources.records import scan
    from firnline.sources.sinks import write_records

    spark = start()
    if a.command == "run":
        if a.query not in catalogue.QUERIES:
            print(f"unknown query {a.query!r}", file=sys.stderr)
            return 2
        write_records(catalogue.QUERIES[a.query](spark, a.input), a.output)
        return 0
    records = scan(spark, a.input)
    if a.period:
        day = F.to_date(a.time)
        keep = [day.between(F.lit(x), F.lit(y)) for x, y in without_months(*a.period, a.exclude_months)]
        hit = F.lit(False)
        for k in keep:
            hit = hit | k
        records = records.filter(hit)
    try:
        pipeline = Pipeline.from_yaml(a.definition)
        columns = pipeline.validate(records.columns)
    except PipelineError as e:
        print(e, file=sys.stderr)
        return 2
    if a.check:
        print("\n".join(columns))
        return 0
    write_records(pipeline.apply(records), a.output)
    return 0


if __name__ == "__main__":
    sys.exit(main())
