"""Command line: build, validate, maintain, diff, profile, publish, job. Exit status 0 is success; failures are 1."""

from __future__ import annotations

import argparse
import json
import sys
from dataclasses import replace
from pathlib import Path

from siltstone.config import PipelineConfig
from siltstone.functions import correlation
from siltstone.operators.gate import GateFailure
from siltstone.plans.layout import open_table, publish
from siltstone.plans.pipeline import print_run_report, run_pipeline
from siltstone.plans.profile_raw import profile_raw
from siltstone.plans.versions import reclassify
from siltstone.schema import GOLD
from siltstone.session import get_spark, stop_spark
from siltstone.store.maintenance import maintenance_report, run_maintenance


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="siltstone", description=__doc__)
    commands = top.add_subparsers(dest="command", required=True)
    for name in ("build", "validate", "maintain", "diff", "profile", "publish", "job"):
        p = commands.add_parser(name)
        p.add_argument("--raw-dir", type=Path)
        p.add_argument("--lakehouse-dir", type=Path)
        p.add_argument("--namespace")
        p.add_argument("--fixtures", action="store_true", help="allow any share of rejected rows")
        if name == "publish":
            p.add_argument("--schema", default="siltstone")
        if name in ("build", "job"):
            p.add_argument("--checkpoint-dir", help="let new files arrive by a stream that keeps its progress here")
            p.add_argument("--full-refresh", action="store_true")
        if name in ("validate", "job"):
            p.add_argument("--strict", action="store_true", help="fail on checks without a verdict too")
        if name in ("maintain", "job"):
            p.add_argument("--retain-hours", type=float, default=168.0)
            p.add_argument("--no-vacuum", action="store_true")
        if name == "profile":
            p.add_argument("--json-out", type=Path)
            p.add_argument("--top-patterns", type=int, default=20)
    return top


def config_of(args: argparse.Namespace) -> PipelineConfig:
    given = {k: v for k in ("raw_dir", "lakehouse_dir", "namespace", "checkpoint_dir") if (v := getattr(args, k, None)) is not None}
    config = replace(PipelineConfig(), **given)
    return config.for_fixtures() if args.fixtures else config


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    config, spark = config_of(args), get_spark()
    try:
        return globals()[f"_{args.command}"](spark, config, args)
    finally:
        stop_spark(spark)


def _build(spark, config, args) -> int:
    try:
        print_run_report(run_pipeline(spark, config, full_refresh=args.full_refresh))
    except GateFailure as e:
        print(f"gate failed: {e}", file=sys.stderr)
        return 1
    return 0


def _validate(spark, config, args) -> int:
    table = open_table(spark, config, GOLD)
    if not table.exists() or table.read().isEmpty():
        print("no gold rows", file=sys.stderr)
        return 1
    found = correlation.checks(table.read())
    print(correlation.report(found))
    correlation.by_axis(table.read()).orderBy("axis").show(100, truncate=False)
    failing = "verdict = 'WRONG SIGN'" if not args.strict else "verdict != 'OK'"
    return int(not found.filter(failing).isEmpty())


def _maintain(spark, config, args) -> int:
    results = run_maintenance(spark, config, args.retain_hours, not args.no_vacuum)
    print(maintenance_report(results))
    return int(any(r.error for r in results))


def _diff(spark, config, args) -> int:
    found = reclassify(spark, config)
    open_table(spark, config, GOLD).history().orderBy("version").show(100, truncate=False)
    print(f"versions {found.before} and {found.after}")
    for frame in (found.rows.groupBy("change").count().orderBy("change"), found.transitions, found.sample(), found.totals):
        frame.show(20, truncate=False)
    return 0


def _profile(spark, config, args) -> int:
    text = json.dumps(profile_raw(spark, config, args.top_patterns), indent=2, default=str)
    print(text)
    if args.json_out:
        args.json_out.write_text(text)
    return 0


def _publish(spark, config, args) -> int:
    publish(spark, config, args.schema).show(100, truncate=False)
    return 0


#: The tasks of the scheduled job, each with those that must have succeeded before it. One run at a time.
JOB = {"build": (), "validate": ("build",), "maintain": ("validate",)}


def _job(spark, config, args) -> int:
    """The tasks of the job in order; what comes after a failure is not run."""
    done: set[str] = set()
    for name, after in JOB.items():
        if done.issuperset(after) and not globals()[f"_{name}"](spark, config, args):
            done.add(name)
    print(f"done: {', '.join(n for n in JOB if n in done) or 'nothing'}")
    return int(len(done) < len(JOB))


def script() -> None:
    if status := main():
        sys.exit(status)


if __name__ == "__main__":
    script()
