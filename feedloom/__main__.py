"""Run the jobs with ``spark-submit``: ``feedloom/__main__.py STEP --root ROOT [--batch-id ID]``.

Steps: ``land`` (documents in splittable form), ``clean`` (three feeds), ``star``, ``load``, or ``run`` for all of them; ``changes`` does the same
over what has changed since its last run; ``prune`` removes superseded versions and merges small quarantine segments, while nothing else runs. ROOT, on storage that
every executor can reach, holds the bronze, silver, quarantine, gold and serving folders. Memory, cores
and shuffle settings come from the submit.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from feedloom.plans.clean import CleanCounts
from feedloom.plans.load import load_star
from feedloom.plans.pipeline import Paths, clean_all, land_all, prune, run, run_changed
from feedloom.plans.star import StarOptions, build_star


def main(arguments: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="feedloom")
    parser.add_argument("step", choices=("land", "clean", "star", "load", "run", "changes", "prune"))
    parser.add_argument("--root", required=True)
    parser.add_argument("--batch-id", help="required by run and clean: the quarantine tells bad rows by the batches that saw them")
    parser.add_argument("--week-key", choices=("iso", "calendar"), default="iso")
    parser.add_argument("--key-method", choices=("crc32", "xxhash64"), default="crc32")
    parser.add_argument("--incremental", action="store_true", help="read only new and changed snapshots")
    parser.add_argument("--landed", action="store_true", help="clean landed documents, which split; run lands them first")
    args = parser.parse_args(arguments)
    if args.step in ("run", "clean", "changes") and not args.batch_id:
        parser.error(f"{args.step} needs --batch-id")
    spark = SparkSession.builder.appName(f"feedloom-{args.step}").getOrCreate()
    paths = Paths.under(args.root.rstrip("/"))
    options = StarOptions(week_key=args.week_key, key_method=args.key_method)
    if args.step == "run":
        report(run(spark, paths, args.batch_id, options, args.incremental, args.landed))
    elif args.step == "clean":
        report(clean_all(spark, paths, args.batch_id, args.incremental, args.landed))
    elif args.step == "changes":
        report(run_changed(spark, paths, args.batch_id, options, args.landed))
    elif args.step == "prune":
        for path in prune(spark, paths):
            print(f"removed {path}")
    elif args.step == "land":
        land_all(spark, paths)
    elif args.step == "star":
        build_star(spark, paths.silver, paths.gold, options)
    else:
        load_star(spark, paths.gold, paths.serving)


def report(counts: dict[str, CleanCounts]) -> None:
    """One line per feed: how many of the batch's rows were bad, and by which rule."""
    for feed, n in counts.items():
        rules = "".join(f"; {reason} {share:.1%}" for reason, share in n.shares().items() if share)
        print(f"{feed}: {n.total} rows, {n.bad} bad ({n.bad_share:.1%}){rules}")


if __name__ == "__main__":
    main()
