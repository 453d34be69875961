"""A run from the command line: exit 0 when all turns were classified, 1 when some failed or none was selected, 2 when it could not start."""

from __future__ import annotations

import argparse
import os
import sys
import time

from pyspark.sql import SparkSession

from convolens import config
from convolens.functions import labels
from convolens.operators import cases, contracts, filters, output, stages, survey, turnlist
from convolens.plans import classify, judging
from convolens.sources import conversation_log, synthetic


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="convolens")
    out.add_argument("--config")
    out.add_argument("--input", dest="input_path")
    out.add_argument("--output-dir")
    which = out.add_mutually_exclusive_group()
    which.add_argument("--filter", dest="filter_path")
    which.add_argument("--turns", dest="turns_path")
    out.add_argument("--labels", dest="labels_path")
    out.add_argument("--limit", type=int)
    out.add_argument("--raw-ids", action="store_true", default=None)
    mode = out.add_mutually_exclusive_group()
    mode.add_argument("--dry-run", action="store_true", help="select only; a synthetic log where no input is given")
    mode.add_argument("--survey", action="store_true")
    return out


def main(argv: list[str] | None = None, judge=None, spark: SparkSession | None = None) -> int:
    """judge: any object of the judge protocol; None takes the configured one."""
    options = vars(parser().parse_args(argv))
    dry, look, path = options.pop("dry_run"), options.pop("survey"), options.pop("config")
    try:
        settings = config.load(path, options)
        if not settings.input_path and not dry:
            raise ValueError("an input is needed")
        if judge is None and settings.judge_backend != "stub":
            raise ValueError("only the stub judge is built in: give main() another one")
    except (OSError, ValueError) as e:
        print(f"cannot start: {e}", file=sys.stderr)
        return 2
    spark = spark or SparkSession.builder.appName("convolens").getOrCreate()
    logs = spark.read.text(settings.input_path, wholetext=True) if settings.input_path else synthetic.log(spark, 20)
    turns = stages.settle(conversation_log.flatten(logs))
    if look:
        for name, frame in survey.report(turns).items():
            print(f"[{name}]")
            frame.show(20, truncate=40)
        return 0
    contracts.report(logs).orderBy("layer", "field", "kind").show(50, truncate=False)
    try:
        table = labels.parse_table(open(settings.labels_path, encoding="utf-8").read()) if settings.labels_path else {}
        if settings.turns_path:
            rows, status = turnlist.select(turns, turnlist.read(spark, settings.turns_path), settings.history_turns)
            status.groupBy("status").count().show()
        else:
            spec = filters.load(settings.filter_path, table, table, not table) if settings.filter_path else filters.FilterSpec()
            rows, steps = filters.select(turns, spec, table, table, settings.limit or None, settings.history_turns)
            steps.orderBy("position").show(truncate=False)
    except (OSError, ValueError) as e:
        print(f"cannot start: {e}", file=sys.stderr)
        return 2
    if not rows.limit(1).count():
        print("no data")
        return 1
    if dry:
        rows.select("case_id", "current_query").show(10, truncate=60)
        return 0
    results = classify.classify(rows, judge or judging.StubJudge(), settings.cache_path or None)
    target = os.path.join(settings.output_dir, time.strftime("%Y%m%d_%H%M%S") + ".json")
    output.write_nested(results, target, settings.raw_ids)
    print(output.render(results))
    return 1 if output.totals(results).first()["n_failed"] else 0
