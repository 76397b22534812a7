"""Command line: ingest a catalogue, build a dataset, check one."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from sliceforge.operators import ingest
from sliceforge.plans import build
from sliceforge.schemas import RunConfig
from sliceforge.sources import files


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    top = argparse.ArgumentParser(prog="sliceforge")
    top.add_argument("--log-level", default="WARN")
    sub = top.add_subparsers(dest="command", required=True)
    one = sub.add_parser("ingest")
    one.add_argument("--db", required=True)
    one.add_argument("--out", required=True)
    one.add_argument("--limit", type=int)
    one.add_argument("--ban", action="append", default=[])
    one.add_argument("--no-c-filter", action="store_true")
    two = sub.add_parser("build")
    for name in ("--work-queue", "--diffs", "--graphs", "--out"):
        two.add_argument(name, required=True)
    two.add_argument("--hops", type=int, default=1)
    two.add_argument("--max-hops-slice", type=int, default=10)
    two.add_argument("--proximity-lines", type=int, default=3)
    two.add_argument("--debug-samples", action="store_true")
    three = sub.add_parser("check")
    three.add_argument("--out", required=True)
    return top.parse_args(argv)


def main(argv: list[str] | None = None) -> int:
    """0 if all went well, 1 for a missing table or a red flag."""
    a = _arguments(argv)
    spark = SparkSession.builder.getOrCreate()
    spark.sparkContext.setLogLevel(a.log_level)
    if a.command == "ingest":
        have = files.sqlite_tables(a.db)
        if missing := ingest.missing_tables(have):
            print("missing tables:", ", ".join(missing))
            return 1
        parts = {n: files.read_sqlite(spark, a.db, n) for n in (*ingest.REQUIRED, "repository") if n in have}
        rows = ingest.source_rows(parts["fixes"], parts["commits"], parts["cwe_classification"], parts.get("repository"))
        banned = ingest.banned_projects(a.ban)
        files.write_queue(ingest.work_queue(rows, not a.no_c_filter, banned, a.limit), a.out)
        ingest.reject_counts(rows, not a.no_c_filter, banned).show(truncate=False)
        return 0
    if a.command == "build":
        build.run(spark, a.work_queue, a.diffs, a.graphs, a.out, RunConfig(a.hops, a.max_hops_slice, a.proximity_lines, a.debug_samples)).show(truncate=False)
        return 0
    checks = build.check(spark, a.out)
    checks.show(100, truncate=False)
    return 0 if build.validate.is_sound(checks) else 1


if __name__ == "__main__":
    sys.exit(main())
