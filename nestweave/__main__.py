"""The two jobs from the command line: ``python -m nestweave import …`` and ``… enrich …``.

Master, memory, catalogs and credentials come from the Spark configuration and are never printed.
"""

from __future__ import annotations

import argparse
import logging
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from nestweave.plans.organisation import enrich_documents, import_documents
from nestweave.schemas import reference_schema
from nestweave.session import build_session
from nestweave.sources.reference import reference_by_jdbc
from nestweave.streaming.control import ProgressLog, run_to_completion, stop_on_sigterm
from nestweave.streaming.enrichment import replay_safe_folder, replay_safe_table

log = logging.getLogger(__name__)


def parser() -> argparse.ArgumentParser:
    main = argparse.ArgumentParser(prog="nestweave")
    main.add_argument("--app-name", default="nestweave")
    jobs = main.add_subparsers(dest="job", required=True)

    first = jobs.add_parser("import", help="append document files to a table")
    first.add_argument("--source", required=True, help="folder the files arrive in")
    first.add_argument("--glob", default="*", help="pattern of the file names")
    first.add_argument("--format", default="avro", help="format of the files")
    first.add_argument("--path", help="where a new table is kept")
    first.add_argument("--table-format", default="parquet", help="format of a new table")

    second = jobs.add_parser("enrich", help="enrich the documents appended to a table")
    where = second.add_mutually_exclusive_group(required=True)
    where.add_argument("--reference-table")
    where.add_argument("--reference-path", help="folder of Parquet files")
    where.add_argument("--reference-jdbc", metavar="URL")
    second.add_argument("--jdbc-table")
    second.add_argument("--jdbc-driver")
    second.add_argument("--jdbc-partition-column", help="column to split the read of the table by")
    second.add_argument("--jdbc-lower-bound")
    second.add_argument("--jdbc-upper-bound")
    second.add_argument("--jdbc-partitions", type=int)
    second.add_argument(
        "--order", required=True, nargs="+", help="reference columns that say which name is last"
    )
    out = second.add_mutually_exclusive_group(required=True)
    out.add_argument("--output-path", help="folder; a replayed batch changes nothing")
    out.add_argument("--output-table", help="table; a replayed batch changes nothing")
    second.add_argument("--output-format", default="parquet", help="format of a new output table")
    limit = second.add_mutually_exclusive_group()
    limit.add_argument("--max-files", type=int, help="1 unless given; 0 for no limit")
    limit.add_argument("--max-bytes", type=int)

    for job in (first, second):
        job.add_argument("--table", required=True, help="the table of raw documents")
        job.add_argument("--checkpoint", required=True)
        job.add_argument(
            "--source-option", action="append", default=[], metavar="KEY=VALUE", help="for the source"
        )
        job.add_argument("--trigger", default="ONCE", help="ONCE, or anything else to keep running")
    return main


def reference_reader(spark: SparkSession, args: argparse.Namespace) -> Callable[[], DataFrame]:
    """Reads the reference anew on every call."""
    if args.reference_table:
        return lambda: spark.read.table(args.reference_table)
    if args.reference_path:
        return lambda: spark.read.parquet(args.reference_path)
    columns = dict.fromkeys([*reference_schema().names, *args.order])
    options = {"driver": args.jdbc_driver} if args.jdbc_driver else {}
    split = (
        args.jdbc_partition_column,
        args.jdbc_lower_bound,
        args.jdbc_upper_bound,
        args.jdbc_partitions,
    )
    if None in split:
        raise SystemExit(
            "--reference-jdbc needs --jdbc-partition-column, --jdbc-lower-bound, --jdbc-upper-bound "
            "and --jdbc-partitions (1 to read the table in one task)"
        )
    names = ("partition_column", "lower_bound", "upper_bound", "num_partitions")
    return lambda: reference_by_jdbc(
        spark,
        args.reference_jdbc,
        args.jdbc_table,
        list(columns),
        **dict(zip(names, split, strict=True)),
        **options,
    )


def source_options(args: argparse.Namespace) -> dict[str, str]:
    return dict(option.split("=", 1) for option in args.source_option)


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.job == "import":
        query = import_documents(
            spark,
            args.source,
            args.glob,
            args.table,
            args.checkpoint,
            args.trigger,
            args.format,
            args.path,
            args.table_format,
            source_options(args),
        )
    else:
        sink = (
            replay_safe_folder(args.output_path)
            if args.output_path
            else replay_safe_table(args.output_table, args.output_format)
        )
        query = enrich_documents(
            spark,
            args.table,
            reference_reader(spark, args),
            args.order,
            sink,
            args.checkpoint,
            args.trigger,
            args.max_files,
            args.max_bytes,
            lambda batch_id, metrics: log.info("batch %s: %s", batch_id, metrics),
            source_options=source_options(args),
        )
    run_to_completion(query)


def main(argv: Sequence[str] | None = None) -> None:
    logging.basicConfig(level=logging.INFO)
    args = parser().parse_args(argv)
    stop_on_sigterm()
    spark = build_session(args.app_name)
    spark.streams.addListener(ProgressLog())
    try:
        run(spark, args)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
