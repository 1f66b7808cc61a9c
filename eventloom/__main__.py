"""Command line: ``python -m eventloom --preset rtf --log train.xes.gz --out results/rtf``."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from eventloom.operators.abstraction import KINDS
from eventloom.plans.pipeline import STAGES, run_all
from eventloom.plans.versions import Versions
from eventloom.presets import PRESETS
from eventloom.session import build_session
from eventloom.sources.delimited import number_rows, read_all_text
from eventloom.sources.xes import read_log
from eventloom.spec import LogSpec
from eventloom.staging import stage


def read_any(spark: SparkSession, path: str, spec: LogSpec) -> DataFrame:
    """An event table from XES, delimited text (``;``) or Parquet, staged where it lacks a tie-break."""
    if path.endswith((".xes", ".xes.gz")):
        return stage(read_log(spark, path, spec), "raw-log")
    if path.endswith((".csv", ".csv.gz")):
        table = read_all_text(spark, path)
    else:
        table = spark.read.parquet(path)
    if spec.sequence not in table.columns:
        table = stage(number_rows(table, spec.sequence), "raw-log")
    return table


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="eventloom", description=__doc__)
    parser.add_argument("--preset", required=True, choices=sorted(PRESETS))
    parser.add_argument("--log", help="raw log; not needed when preprocess is skipped")
    parser.add_argument("--out", required=True, help="folder of the result tables")
    parser.add_argument("--skip", nargs="*", default=[], choices=STAGES, help="stages whose tables are reused")
    parser.add_argument("--resume", action="store_true", help="reuse the stages that are still valid")
    parser.add_argument("--abstraction", default="partial_k_means", choices=KINDS)
    parser.add_argument("--bucket", help="state attribute of the bucket abstraction")
    parser.add_argument("--attributes", nargs="*", default=None, help="state attributes; the configured ones by default")
    parser.add_argument("--control-flow", nargs="*", default=[], help="state attributes kept apart by bucket and partial k-means")
    parser.add_argument("--hashed", nargs="*", default=[], help="categories that k-means reads as hashed indicators")
    parser.add_argument("--exclude", nargs="*", default=[], help="described columns that are not discretized")
    parser.add_argument("--encode", nargs="*", default=None, help="described columns to encode; all by default")
    parser.add_argument("--no-attributes", action="store_true", help="encode states and actions only")
    parser.add_argument("--max-numeric-values", type=int, default=20)
    parser.add_argument("--k", type=int, default=10)
    parser.add_argument("--quantiles", type=int, default=3)
    parser.add_argument("--init-state", type=int, default=None)
    parser.add_argument("--horizon", type=int, default=20)
    parser.add_argument("--discount", type=float, default=1.0)
    parser.add_argument("--terminal-bonus", type=float, default=10.0)
    return parser.parse_args(argv)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = arguments(argv)
    spec = PRESETS[args.preset]
    spark = spark or build_session()
    raw = source = None
    if args.log and "preprocess" not in args.skip:
        raw = read_any(spark, args.log, spec)
        # the log may have been staged: what counts are its own files
        source = Versions(spark, args.out).input_digest(spark.read.format("binaryFile").load(args.log))
    run_all(
        spark,
        spec,
        args.out,
        raw,
        args.skip,
        args.abstraction,
        args.k,
        args.init_state,
        args.horizon,
        args.discount,
        args.quantiles,
        args.terminal_bonus,
        args.attributes,
        args.control_flow,
        args.bucket,
        args.exclude,
        {n: "hashed" for n in args.hashed},
        clear=True,
        resume=args.resume,
        source=source,
        attributes_to_encode=args.encode,
        max_numeric_values=args.max_numeric_values,
        include_attributes=not args.no_attributes,
    )


if __name__ == "__main__":
    main()
