"""The batch job: grid or hourly table in, retrospective and index tables out.

``spark-submit --py-files freshet.zip freshet/plans/job.py --input ... --retro-out ...``
"""

import argparse
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from freshet.operators.daily import daily_means
from freshet.operators.ingest import retrospective
from freshet.operators.selection import select_positions, select_reaches, select_reaches_in
from freshet.plans.indices import indices_table
from freshet.session import build_session
from freshet.sources import sinks, tables, zarr
from freshet.sources.runs import Attempt, RunStore


def read_input(spark: SparkSession, path: str, fmt: str, **options) -> DataFrame:
    if fmt == "zarr_grid":
        zarr.register(spark)
        return spark.read.format("zarr_grid").options(**options).load(path)
    if fmt == "csv":
        return tables.read_hourly_csv(spark, path)
    return spark.read.format(fmt).options(**options).load(path)


def run(
    rows: DataFrame,
    retro_target: str,
    indices_target: str,
    mode: str = "append",
    run_id: str | None = None,
    empty_year: str = "skip",
) -> str:
    """Write both tables from one read of the input; returns the run id.

    Targets are paths or table names. ``overwrite`` with a run id repeats that run in both
    tables and leaves all others.

    The hourly rows are written first, without a shuffle. The indices are then built
    from the three columns they need of this run's files, so the grid is read once and
    rows of earlier runs stay out. The written files also cut the lineage: a lost
    executor repeats work from there, not from the grid.
    """
    run_id = run_id or uuid.uuid4().hex
    sinks.write_retrospective(retrospective(rows), retro_target, mode, run_id)
    written = sinks.read_retrospective(rows.sparkSession, retro_target, run_id)
    sinks.write_indices(indices_table(daily_means(written), empty_year), indices_target, mode, run_id)
    return run_id


def _stage(rows: DataFrame, attempt: Attempt, empty_year: str) -> None:
    """Both tables, and that of the broken blocks where the rows mark them, from one read of the input."""
    sinks.stage_retrospective(retrospective(rows, *[c for c in rows.columns if c == zarr.MARK]), attempt)
    if zarr.MARK in rows.columns:
        sinks.stage_broken_blocks(attempt)
    written = sinks.staged_retrospective(attempt)
    sinks.stage_indices(indices_table(daily_means(written), empty_year), attempt)


def run_in_store(rows: DataFrame, root: str, mode: str = "append", run_id: str | None = None, empty_year: str = "skip") -> str:
    """As ``run``, into a run store: both tables appear at once, or neither if the job fails."""
    attempt = RunStore(rows.sparkSession, root).attempt(run_id or uuid.uuid4().hex, mode)
    _stage(rows, attempt, empty_year)
    attempt.commit()
    return attempt.run_id


def run_slices(
    spark: SparkSession,
    read: Callable[[int, int], DataFrame],
    slices: list[tuple[int, int]],
    root: str,
    run_id: str,
    mode: str = "overwrite",
    empty_year: str = "skip",
) -> list[str]:
    """A run in slices of the reaches, ``read(start, stop)`` giving the rows of each.

    A slice is staged by itself and noted when both its tables are written. A restart with the
    same run id and slices does only the rest. The whole run appears at its end. Returns the
    slices done, as ``start-stop``.
    """
    spans = {f"{start}-{stop}": (start, stop) for start, stop in slices}
    return RunStore(spark, root).run_parts(run_id, spans, lambda attempt, part: _stage(read(*spans[part]), attempt, empty_year), mode)


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Streamflow indices from hourly grids")
    parser.add_argument("--input", required=True)
    parser.add_argument("--format", default="zarr_grid", help="zarr_grid, parquet or csv")
    parser.add_argument("--select", choices=["slice", "reach_list"], default=None)
    parser.add_argument("--start", type=int, default=0)
    parser.add_argument("--stop", type=int, default=None)
    parser.add_argument("--time-start", type=int, default=0, help="position of the first time")
    parser.add_argument("--time-stop", type=int, default=None)
    parser.add_argument("--reaches", type=int, nargs="*", default=[])
    parser.add_argument("--on-missing", choices=["raise", "ignore"], default="raise", help="reaches that the input lacks")
    parser.add_argument("--reach-table", default=None, help="Parquet table whose feature_id names the reaches")
    parser.add_argument("--on-bad-block", choices=["raise", "skip", "mark"], default="raise",
                        help="broken blocks of a grid; mark, with --store, lists them in the table broken_blocks")
    parser.add_argument("--empty-year", choices=["skip", "first_date"], default="skip", help="years without a flood season mean")
    parser.add_argument("--option", action="append", default=[], metavar="KEY=VALUE", help="further reader option")
    parser.add_argument("--retro-out", default=None, help="path or table name")
    parser.add_argument("--indices-out", default=None, help="path or table name")
    parser.add_argument("--store", default=None, help="run store for both tables, in place of the two targets")
    parser.add_argument("--slice-features", type=int, default=None,
                        help="with --store and --run-id: reaches of a grid done at once, a multiple of its block; a restart does the rest")
    parser.add_argument("--mode", choices=["append", "overwrite"], default="append")
    parser.add_argument("--run-id", default=None)
    parser.add_argument("--shuffle-partitions", type=int, default=None,
                        help="upper bound; adaptive execution merges small ones")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> str:
    args = parse(argv)
    conf = {}
    if args.shuffle_partitions:
        conf["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(args.shuffle_partitions)
    spark = build_session("freshet-indices", **conf)
    options = dict(option.split("=", 1) for option in args.option)
    if args.select == "reach_list" and not args.reaches:
        raise ValueError("--select reach_list needs --reaches")
    sliced = args.select == "slice"
    if args.store is None and None in (args.retro_out, args.indices_out):
        raise ValueError("name --store, or both --retro-out and --indices-out")
    if args.slice_features and (args.store is None or args.run_id is None or args.format != "zarr_grid" or args.select == "reach_list"):
        raise ValueError("--slice-features needs --store, --run-id and a grid, and no reach list")
    if args.on_bad_block == "mark" and args.store is None:
        raise ValueError("--on-bad-block mark needs --store")
    if args.reach_table and (args.select == "reach_list" or args.slice_features):
        raise ValueError("--reach-table goes with neither a reach list nor --slice-features")
    if args.format == "zarr_grid":
        # A grid knows its positions: slices are cut from the block list.
        options["on_bad_block"] = args.on_bad_block
        spans = {"time": (args.time_start, args.time_stop)} | ({"feature": (args.start, args.stop)} if sliced else {})
        for name, (start, stop) in spans.items():
            options |= {f"{name}_start": start} | ({} if stop is None else {f"{name}_stop": stop})
    if args.slice_features:
        spans = zarr.feature_slices(args.input, args.slice_features, options.get("feature_start", 0), options.get("feature_stop"))
        read = lambda start, stop: read_input(spark, args.input, args.format, **options | {"feature_start": start, "feature_stop": stop})
        run_slices(spark, read, spans, args.store, args.run_id, args.mode, args.empty_year)
        return args.run_id
    if args.reach_table and args.format == "zarr_grid":
        rows = zarr.read_reaches_in(spark, args.input, spark.read.parquet(args.reach_table), on_missing=args.on_missing, **options)
    else:
        rows = read_input(spark, args.input, args.format, **options)
        if args.reach_table:
            rows = select_reaches_in(rows, spark.read.parquet(args.reach_table), on_missing=args.on_missing)
    if args.format != "zarr_grid":
        if (args.time_start, args.time_stop) != (0, None):
            rows = select_positions(rows, "time", args.time_start, args.time_stop)
        if sliced:
            rows = select_positions(rows, "feature_id", args.start, args.stop)
    if args.select == "reach_list":
        if args.format == "zarr_grid" and args.on_missing == "raise":
            zarr.check_reaches(args.input, args.reaches)
            args.on_missing = "ignore"
        rows = select_reaches(rows, args.reaches, on_missing=args.on_missing)
    if args.store is not None:
        return run_in_store(rows, args.store, args.mode, args.run_id, args.empty_year)
    return run(rows, args.retro_out, args.indices_out, args.mode, args.run_id, args.empty_year)


if __name__ == "__main__":
    main()
