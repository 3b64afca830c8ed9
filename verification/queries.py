"""One query per operator, on whole driver tables."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from freshet.functions import calendar
from freshet.operators import baseflow, daily, duration_curve, flood, grid, ingest, monthly, selection, yearly
from freshet.operators.sanitize import sanitize_records
from freshet.operators.water_years import reach_status, tag_water_years, trim_water_years
from freshet.operators.yearly_state import year_states
from freshet.plans import job
from freshet.plans.indices import indices_of_states, indices_of_store, indices_table
from freshet.session import scratch_path
from freshet.sources import sinks, tables, zarr
from freshet.sources.daily_store import read_daily_store, write_daily_store
from freshet.sources.runs import RunStore
from freshet.sources.text_shards import read_shards, write_shards
from verification import views
from verification.zarr_files import write_grid

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def r6(value: Column | str, name: str | None = None) -> Column:
    """Six digits; the billionth settles half-way values, see ``oracles``."""
    column = F.col(value) if isinstance(value, str) else value
    return F.round(column.cast("double") + 1e-9, 6).alias(name or value)


def trimmed(view, spark: SparkSession, sf_dir: str) -> DataFrame:
    return trim_water_years(view(spark, sf_dir))


def per_year(view, spark: SparkSession, sf_dir: str) -> DataFrame:
    return yearly.water_year_frame(trimmed(view, spark, sf_dir))


def by_position(frame: DataFrame, array: str, name: str) -> DataFrame:
    exploded = frame.select("reach_id", F.posexplode(array).alias("position", "_value"))
    return exploded.select("reach_id", "position", r6("_value", name))


# Ingest, selection, daily means.


@query
def daily_mean(spark, sf_dir):
    return daily.daily_means(views.hourly(spark, sf_dir)).select("reach_id", "date", r6("streamflow"))


@query
def daily_mean_with_missing(spark, sf_dir):
    hours = views.hourly(spark, sf_dir)
    marked = hours.withColumn("streamflow", F.when(F.col("streamflow") < 1, F.lit(-999900.0)).otherwise(F.col("streamflow")))
    return daily.daily_means(ingest.fills_to_null(marked)).select("reach_id", "date", r6("streamflow"))


@query
def daily_mean_unnamed(spark, sf_dir):
    """Rows without a reach id form one series of their own."""
    return daily.daily_means(views.hourly_some_unnamed(spark, sf_dir)).select("reach_id", "date", r6("streamflow"))


@query
def memory_rows(spark, sf_dir):
    """Row dicts of a short report, the five highest flows of each kind of event, as a frame with absent fields null."""
    best = Window.partitionBy("event_type").orderBy(F.desc("value"), "event_id")
    top = views.table(spark, sf_dir, "events").withColumn("place", F.row_number().over(best)).where("place <= 5")
    records = [{"feature_id": r["user_id"], "time": r["ts"], "streamflow": r["value"]} for r in top.collect()]
    return _four_digits(tables.from_records(spark, records)).select("feature_id", "time", "streamflow", "velocity")


def _raw_rows(spark, sf_dir):
    value = F.col("value")
    return views.table(spark, sf_dir, "events").select(
        F.col("user_id").cast("int").alias("feature_id"),
        F.col("ts").alias("time"),
        F.when(value >= 1, value).otherwise(-999900.0).alias("streamflow"),
        F.when(value < 100, value / 100).otherwise(float("nan")).alias("velocity"),
        F.when(value < 300, value).otherwise(-999900000.0).alias("qBucket"),
        "event_type",
    )


def _four_digits(rows):
    return rows.select("feature_id", "time", *[F.round(F.col(c).cast("double"), 4).alias(c) for c in rows.columns[2:]])


@query
def retrospective_rows(spark, sf_dir):
    return _four_digits(ingest.retrospective(_raw_rows(spark, sf_dir)))


@query
def reach_list_select(spark, sf_dir):
    """A list of twenty reaches, here the suppliers with the highest balance."""
    best = views.table(spark, sf_dir, "supplier").orderBy(F.desc("s_acctbal"), "s_suppkey")
    ids = [row["s_suppkey"] for row in best.select("s_suppkey").take(20)]
    return selection.select(views.hourly(spark, sf_dir), "reach_list", ids=ids, on_missing="ignore")


@query
def reach_list_checked(spark, sf_dir):
    """Twenty reaches that are there, with the default check of the labels."""
    hours = views.hourly(spark, sf_dir)
    best = hours.groupBy("feature_id").agg(F.sum("streamflow").alias("total")).orderBy(F.desc(F.round("total", 3)), "feature_id")
    return selection.select(hours, "reach_list", ids=[row["feature_id"] for row in best.take(20)])


@query
def reach_table_select(spark, sf_dir):
    wanted = views.table(spark, sf_dir, "customer").where(F.col("c_acctbal") > 0)
    ids = wanted.select(F.col("c_custkey").alias("feature_id"))
    return selection.select_reaches_in(views.hourly(spark, sf_dir), ids, on_missing="ignore")


@query
def reach_table_absent(spark, sf_dir):
    """Customers that are no reach of the hourly rows."""
    wanted = views.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("feature_id"))
    return selection.absent_reaches(views.hourly(spark, sf_dir), wanted)


@query
def reach_slice_select(spark, sf_dir):
    return selection.select(views.hourly(spark, sf_dir), "slice", start=5)


@query
def time_slice_select(spark, sf_dir):
    return selection.select_positions(views.cells(spark, sf_dir), "time", stop=15)


@query
def first_rows_per_reach(spark, sf_dir):
    return daily.first_rows(views.hourly(spark, sf_dir), 40, "streamflow")


@query
def series_union(spark, sf_dir):
    return views.daily_dense(spark, sf_dir).unionByName(views.daily_gappy(spark, sf_dir))


# Sinks and sources: written below the scratch folder and read back.


@query
def retrospective_table(spark, sf_dir):
    path = scratch_path(spark, "retrospective")
    rows = ingest.retrospective(_raw_rows(spark, sf_dir))
    sinks.write_retrospective(rows, path, run_id="first")
    sinks.write_retrospective(rows, path, run_id="second")
    return _four_digits(sinks.read_retrospective(spark, path, "second"))


@query
def retrospective_overwrite(spark, sf_dir):
    """Two runs; the first is repeated with fewer months, and both are read back."""
    path = scratch_path(spark, "retrospective")
    rows = ingest.retrospective(_raw_rows(spark, sf_dir))
    stretched = rows.withColumn("time", F.timestamp_add("YEAR", (F.col("feature_id") % 3).cast("int"), "time").cast("timestamp_ntz"))
    for run_id in ("first", "second"):
        sinks.write_retrospective(stretched, path, mode="overwrite", run_id=run_id)
    sinks.write_retrospective(stretched.where("feature_id % 3 = 1"), path, mode="overwrite", run_id="first")
    runs = [sinks.read_retrospective(spark, path, r).select(F.lit(r).alias("run"), "feature_id", "time") for r in ("first", "second")]
    return runs[0].unionByName(runs[1])


@query
def indices_overwrite(spark, sf_dir):
    """Two runs of index records; the first is repeated with fewer reaches."""
    path = scratch_path(spark, "indices")
    source = scratch_path(spark, "records")
    indices_table(views.daily_gappy(spark, sf_dir)).write.parquet(source)
    records = spark.read.parquet(source)
    for run_id in ("first", "second"):
        sinks.write_indices(records, path, mode="overwrite", run_id=run_id)
    sinks.write_indices(records.where("reach_id < 3"), path, mode="overwrite", run_id="first")
    runs = [_long_record(sinks.read_indices(spark, path, r)).select(F.lit(r).alias("run"), "*") for r in ("first", "second")]
    return runs[0].unionByName(runs[1])


@query
def job_tables(spark, sf_dir):
    """The whole job from rows at midnight to both tables; its records, and the hours of each reach beside them."""
    retro, indices = scratch_path(spark, "retro"), scratch_path(spark, "indices")
    days = views.daily_gappy(spark, sf_dir)
    rows = days.select(F.col("reach_id").alias("feature_id"), F.col("date").cast("timestamp_ntz").alias("time"), "streamflow")
    run_id = job.run(rows, retro, indices)
    hours = sinks.read_retrospective(spark, retro, run_id).groupBy("feature_id").agg(F.count("*").alias("hours"))
    records = _long_record(sinks.read_indices(spark, indices, run_id))
    return records.join(hours, records["reach_id"] == hours["feature_id"]).drop("feature_id")


@query
def run_commit_log(spark, sf_dir):
    """Both tables of three runs: one repeated with fewer reaches, one added to, and attempts that never committed."""
    root = scratch_path(spark, "store")
    rows, reach = views.hourly(spark, sf_dir), F.col("feature_id")
    for run_id, mode, kept in (
        ("first", "append", reach % 2 == 0),
        ("second", "append", reach % 3 == 0),
        ("first", "overwrite", reach % 5 == 0),
        ("second", "append", reach % 3 == 1),
    ):
        job.run_in_store(rows.where(kept), root, mode, run_id)
    store = RunStore(spark, root)
    for run_id in ("first", "third"):
        sinks.stage_retrospective(ingest.retrospective(rows), store.attempt(run_id, "overwrite"))
    snapshot = store.snapshot()
    hours = sinks.retrospective_of(snapshot).groupBy("run_id", F.col("feature_id").alias("reach_id")).agg(
        F.count("*").alias("hours"), F.round(F.sum(F.col("streamflow").cast("double")), 1).alias("total"))
    records = sinks.indices_of(snapshot).groupBy("run_id", "reach_id").agg(F.count("*").alias("records"))
    return hours.join(records, ["run_id", "reach_id"], "full")


@query
def daily_csv(spark, sf_dir):
    """Daily series, one file group per reach and with headers in different order."""
    path = scratch_path(spark, "daily")
    days = views.daily_dense(spark, sf_dir)
    sinks.write_text(days.where("reach_id < 80").select(F.lit(0).alias("index"), "date", "streamflow", "reach_id"), path, fmt="csv")
    sinks.write_text(days.where("reach_id >= 80").select("streamflow", "reach_id", "date"), path, fmt="csv")
    return tables.read_daily_csv(spark, path).select("reach_id", "date", r6("streamflow"))


@query
def hourly_csv(spark, sf_dir):
    path = scratch_path(spark, "hourly")
    rows = views.hourly(spark, sf_dir).withColumn("time", F.date_format("time", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    sinks.write_text(rows.select(F.lit(0).alias("index"), "*"), path, fmt="csv")
    return _four_digits(tables.read_hourly_csv(spark, path)).select("feature_id", "time", "streamflow")


@query
def text_records(spark, sf_dir):
    path = scratch_path(spark, "records")
    stats = monthly.monthwise_stats(trimmed(views.daily_gappy, spark, sf_dir))
    sinks.write_text(stats, path, shards=4)
    return spark.read.schema(stats.schema).json(path)


@query
def text_shards(spark, sf_dir):
    """Records in five named shards, first in seven, which the second write replaces."""
    prefix = scratch_path(spark, "shards") + "/stats"
    stats = monthly.monthwise_stats(trimmed(views.daily_gappy, spark, sf_dir))
    write_shards(stats.limit(2), prefix, shards=7, suffix=".json")
    write_shards(stats, prefix, shards=5, suffix=".json", mode="overwrite")
    return read_shards(spark, prefix, ".json", stats.schema)


@query
def indices_records_table(spark, sf_dir):
    path = scratch_path(spark, "indices")
    sinks.write_indices(indices_table(views.daily_gappy(spark, sf_dir)), path)
    return _long_record(sinks.read_indices(spark, path))


@query
def zarr_scan(spark, sf_dir):
    path = scratch_path(spark, "grid.zarr")
    write_grid(views.cells(spark, sf_dir), path, time_size=168, feature_size=50)
    zarr.register(spark)
    return spark.read.format("zarr_grid").load(path)


@query
def zarr_blosc_scan(spark, sf_dir):
    """A store with Blosc containers of several kinds and with filters."""
    path = scratch_path(spark, "grid.zarr")
    storage = {
        "streamflow": {"compressor": {"id": "blosc", "cname": "lz4", "shuffle": 1, "block_size": 8192}, "filters": None},
        "velocity": {
            "compressor": {"id": "blosc", "cname": "zstd", "shuffle": 2, "block_size": 10_000},
            "filters": [{"id": "fixedscaleoffset", "dtype": "<f8", "astype": "<i8", "scale": 100, "offset": -3}],
        },
        "time": {"compressor": {"id": "blosc", "cname": "zlib", "shuffle": 1}, "filters": [{"id": "delta", "dtype": "<i8"}]},
        "feature_id": {"compressor": None, "filters": [{"id": "delta", "dtype": "<i8", "astype": "<i4"}, {"id": "shuffle", "elementsize": 4}]},
    }
    write_grid(views.cells(spark, sf_dir), path, time_size=168, feature_size=50, storage=storage)
    zarr.register(spark)
    grid_rows = spark.read.format("zarr_grid").load(path)
    return grid_rows.select("feature_id", "time", "streamflow", F.round("velocity", 2).alias("velocity"))


def _grid(spark, sf_dir, time_size=168, feature_size=50, view=views.cells):
    path = scratch_path(spark, "grid.zarr")
    write_grid(view(spark, sf_dir), path, time_size, feature_size)
    zarr.register(spark)
    return path


@query
def daily_mean_from_blocks(spark, sf_dir):
    """Day sums made inside the blocks; blocks of 100 hours cut days in two, missing hours poison theirs."""
    path = _grid(spark, sf_dir, 100, 2, views.coarse_cells)
    sums = spark.read.format("zarr_grid").option("layout", "day_sums").load(path)
    return daily.daily_means_from_sums(sums).select("reach_id", "date", r6("streamflow"))


@query
def reach_table_blocks(spark, sf_dir):
    """Reaches in a table, here every customer's with a balance and one in twenty; other blocks stay unread."""
    path = _grid(spark, sf_dir, feature_size=7)
    wanted = views.table(spark, sf_dir, "customer").where((F.col("c_acctbal") > 0) & (F.col("c_custkey") % 20 == 3))
    return zarr.read_reaches_in(spark, path, wanted, key="c_custkey", on_missing="ignore")


@query
def broken_blocks(spark, sf_dir):
    """A store with cut and undecodable blocks through the job: cells and broken blocks by reach of ten."""
    path, root = _grid(spark, sf_dir, feature_size=10), scratch_path(spark, "store")
    system, folder = zarr.file_system(path)
    for name, block, content in (("streamflow", "0.3", b"not compressed"), ("velocity", "2.5", b""), ("streamflow", "3.7", b"x\x9c")):
        with system.open_output_stream(f"{folder}/{name}/{block}", compression=None) as stream:
            stream.write(content)
    rows = spark.read.format("zarr_grid").option("on_bad_block", "mark").load(path)
    job.run_in_store(rows, root, run_id="a")
    snapshot = RunStore(spark, root).snapshot()
    # Positions of the reaches, as the marks have them. Cells meet them counted by reach, and both sides are
    # shuffled: from files of mostly missing flows Spark takes the cells for few and would send them to the driver.
    axis = spark.read.format("zarr_grid").option("layout", "axis").load(path).hint("merge")
    reaches = sinks.retrospective_of(snapshot).groupBy("feature_id").agg(F.count("*").alias("cells"))
    cells = reaches.join(axis, "feature_id").groupBy(F.floor(F.col("position") / 10).alias("part"))
    marks = sinks.broken_blocks_of(snapshot).groupBy(F.floor(F.col("feature_start") / 10).alias("part"))
    lost = (F.col("time_stop") - F.col("time_start")) * (F.col("feature_stop") - F.col("feature_start"))
    return cells.agg(F.sum("cells").alias("cells")).join(
        marks.agg(F.count("*").alias("blocks"), F.sum(lost).alias("lost")), "part", "full")


# Grid chunks.


@query
def rechunk_blocks(spark, sf_dir):
    """Production blocks cut to two other sizes, the second from the first."""
    chunks = grid.to_chunks(views.cells(spark, sf_dir))
    fine = grid.rechunk(chunks, (grid.TIME_SIZE, grid.FEATURE_SIZE), (100, 37))
    coarse = grid.rechunk(fine, (100, 37), (250, 64))
    cells = [grid.flatten_chunks(c).select(F.lit(n).alias("size"), "*") for n, c in ((100, fine), (250, coarse))]
    return cells[0].unionByName(cells[1])


@query
def chunk_roundtrip(spark, sf_dir):
    chunks = grid.to_chunks(views.cells(spark, sf_dir), time_size=168, feature_size=50)
    return grid.flatten_chunks(chunks)


def _sparse_roundtrip(spark, sf_dir, time_size, feature_size):
    return grid.flatten_chunks(grid.to_chunks(views.sparse_cells(spark, sf_dir), time_size, feature_size))


@query
def chunk_roundtrip_small_blocks(spark, sf_dir):
    return _sparse_roundtrip(spark, sf_dir, 5, 4)


@query
def chunk_roundtrip_large_blocks(spark, sf_dir):
    return _sparse_roundtrip(spark, sf_dir, 300, 40)


@query
def chunk_roundtrip_with_empty(spark, sf_dir):
    """Chunks without times or without reaches among the others give no rows and no error."""
    chunks = grid.to_chunks(views.cells(spark, sf_dir), time_size=168, feature_size=50)
    none = lambda *names: {n: F.slice(n, 1, 0) for n in names}
    lists = ("streamflow", "velocity")
    timeless = chunks.withColumns(none("times", *lists))
    bare = chunks.withColumns(none("feature_ids", *lists))
    return grid.flatten_chunks(chunks.unionByName(timeless).unionByName(bare))


@query
def broken_chunks(spark, sf_dir):
    """Chunks of every other block row broken: the good cells, and the broken chunks as rows without cells."""
    chunks = grid.to_chunks(views.cells(spark, sf_dir), time_size=48, feature_size=20)
    cut = F.when(F.col("time_chunk") % 2 == 1, F.slice("velocity", 1, 3)).otherwise(F.col("velocity"))
    good, bad = grid.split_chunks(chunks.withColumn("velocity", cut))
    cells = grid.flatten_chunks(good).groupBy((F.col("feature_id") % 10).alias("part")).agg(
        F.count("*").alias("cells"), F.count("streamflow").alias("filled"), F.lit(0).cast("long").alias("broken"))
    broken = bad.select(F.explode("feature_ids").alias("f"), F.size("times").alias("n")).groupBy((F.col("f") % 10).alias("part")).agg(
        F.lit(0).cast("long").alias("cells"), F.lit(0).cast("long").alias("filled"), F.sum("n").alias("broken"))
    parts = cells.unionByName(broken).groupBy("part")
    return parts.agg(*[F.sum(c).alias(c) for c in ("cells", "filled", "broken")])


@query
def grid_summary(spark, sf_dir):
    summary = grid.grid_summary(views.cells_missing(spark, sf_dir))
    return summary.select(*[r6(c) if c.endswith("_missing") else F.col(c) for c in summary.columns])


# Water years and months.


@query
def water_years(spark, sf_dir):
    return views.daily_dense(spark, sf_dir).select(
        "reach_id",
        "date",
        calendar.water_year(F.col("date")).alias("water_year"),
        calendar.water_year(F.col("date"), 4).alias("april_year"),
    )


@query
def water_year_trim(spark, sf_dir):
    rows = trimmed(views.daily_gappy, spark, sf_dir)
    return rows.select("reach_id", "date", "water_year", r6("streamflow"))


@query
def reach_status_sparse(spark, sf_dir):
    return reach_status(views.daily_sparse(spark, sf_dir))


@query
def reach_status_blank(spark, sf_dir):
    return reach_status(views.daily_blank(spark, sf_dir))


@query
def monthwise_stats(spark, sf_dir):
    return monthly.monthwise_stats(trimmed(views.daily_missing, spark, sf_dir))


# Flow-duration curve.


@query
def weibull_percentiles(spark, sf_dir):
    rows = duration_curve.flow_percentiles(trimmed(views.daily_sparse, spark, sf_dir))
    levels = F.array(*[F.lit(p) for p in duration_curve.LEVELS])
    pairs = rows.select("reach_id", F.explode(F.arrays_zip(levels.alias("level"), "percentiles")).alias("p"))
    return pairs.select("reach_id", "p.level", r6(F.col("p.percentiles"), "flow"))


@query
def fdc_vector(spark, sf_dir):
    curve = duration_curve.duration_curve(trimmed(views.daily_sparse, spark, sf_dir))
    return by_position(curve, "nth_percentile_flows", "flow")


@query
def variability_index(spark, sf_dir):
    curve = duration_curve.duration_curve(trimmed(views.daily_intermittent, spark, sf_dir))
    return curve.select("reach_id", r6("variability_index"))


@query
def fdc_slope(spark, sf_dir):
    curve = duration_curve.duration_curve(trimmed(views.daily_sparse, spark, sf_dir))
    return curve.select("reach_id", r6("slope_fdc"))


# Flashiness.


@query
def flashiness_yearly(spark, sf_dir):
    years = per_year(views.daily_gappy, spark, sf_dir)
    return years.select("reach_id", "water_year", r6(yearly.flashiness(), "flashiness"))


@query
def flashiness_yearly_missing(spark, sf_dir):
    years = per_year(views.daily_missing_early, spark, sf_dir)
    return years.select("reach_id", "water_year", r6(yearly.flashiness(), "flashiness"))


def _periods(spark, sf_dir, periods):
    years = per_year(views.daily_gappy, spark, sf_dir)
    reaches = years.groupBy("reach_id").agg(yearly.flashiness_by_period(periods).alias("index"))
    return by_position(reaches, "index", "value")


@query
def flashiness_periods(spark, sf_dir):
    return _periods(spark, sf_dir, yearly.FLASHINESS_PERIODS)


@query
def flashiness_periods_late(spark, sf_dir):
    return _periods(spark, sf_dir, [(1980, 1989), (1996, 2001)])


# Low flow.


@query
def seven_day_mean(spark, sf_dir):
    rows = yearly.seven_day_means(trimmed(views.daily_missing, spark, sf_dir))
    return rows.select("reach_id", "date", r6("mean_7"))


@query
def seven_day_min(spark, sf_dir):
    years = per_year(views.daily_missing, spark, sf_dir)
    return years.select("reach_id", "water_year", "days", "null_7", r6("min_7"))


@query
def mam7(spark, sf_dir):
    years = per_year(views.daily_missing_early, spark, sf_dir)
    return years.groupBy("reach_id").agg(r6(F.avg(yearly.usable_minimum()), "mean_annual_7_day_min"))


def _probability(spark, sf_dir, target):
    years = per_year(views.daily_rare_zero, spark, sf_dir)
    return years.groupBy("reach_id").agg(r6(yearly.zero_adjusted_probability(target), "probability"))


@query
def zero_year_probability(spark, sf_dir):
    return _probability(spark, sf_dir, 0.1)


@query
def zero_year_probability_wide(spark, sf_dir):
    return _probability(spark, sf_dir, 0.9)


@query
def zero_year_probability_mixed(spark, sf_dir):
    """A target that some reaches' share of zero years is above and others' below."""
    return _probability(spark, sf_dir, 0.6)


@query
def lp3_moments(spark, sf_dir):
    moments = per_year(views.daily_gappy, spark, sf_dir).groupBy("reach_id").agg(*yearly.log_moments())
    return moments.select("reach_id", "n", r6("mean_log"), r6("sd_log"), r6("skew_log"))


@query
def seven_q10(spark, sf_dir):
    indices = yearly.yearly_indices(trimmed(views.daily_gappy, spark, sf_dir))
    return indices.select("reach_id", r6("sevenQ10", "seven_q10"))


# Zero-, low- and high-flow days and events.


@query
def zero_flow_days(spark, sf_dir):
    years = per_year(views.daily_intermittent, spark, sf_dir)
    return years.groupBy("reach_id").agg(r6(F.avg("zero_days"), "zero_flow_days_n"))


def _events(spark, sf_dir, kind):
    reaches = per_year(views.daily_intermittent, spark, sf_dir).groupBy("reach_id").agg(
        r6(F.avg(f"{kind}_days"), f"{kind}_flow_days_n"),
        r6(yearly.mean_event_duration(f"{kind}_days", f"{kind}_events"), f"duration_{kind}_flow_event"),
    )
    return reaches


@query
def low_flow_events(spark, sf_dir):
    return _events(spark, sf_dir, "low")


@query
def high_flow_events(spark, sf_dir):
    return _events(spark, sf_dir, "high")


def _durations(spark, sf_dir, flag):
    marks = yearly.flow_marks(trimmed(views.daily_intermittent, spark, sf_dir))
    return yearly.event_durations(marks, flag).select("reach_id", "start_date", "duration")


@query
def low_flow_durations(spark, sf_dir):
    return _durations(spark, sf_dir, "is_low")


@query
def high_flow_durations(spark, sf_dir):
    return _durations(spark, sf_dir, "is_high")


# Half-flow date.


@query
def half_flow_date_yearly(spark, sf_dir):
    years = per_year(views.daily_missing, spark, sf_dir)
    return years.select("reach_id", "water_year", "half_flow_date", yearly.half_flow_day().alias("day"))


@query
def half_flow_summary(spark, sf_dir):
    years = per_year(views.daily_gappy, spark, sf_dir)
    reaches = years.groupBy("reach_id").agg(yearly.half_flow_summary().alias("h"))
    return reaches.select("reach_id", r6(F.col("h")[0], "mean_day"), r6(F.col("h")[1], "cov"))


# Flood season.


@query
def calendar_fill(spark, sf_dir):
    days = flood.fill_calendar(trimmed(views.daily_sparse, spark, sf_dir))
    return days.select("reach_id", "date", r6("streamflow"))


@query
def season_means(spark, sf_dir):
    means = flood.season_means(trimmed(views.daily_missing, spark, sf_dir))
    return means.select("reach_id", "date", r6("season_mean"))


@query
def season_gap_years(spark, sf_dir):
    return flood.gap_years(flood.season_means(trimmed(views.daily_missing, spark, sf_dir)))


@query
def season_starts(spark, sf_dir):
    return flood.season_starts(trimmed(views.daily_gappy, spark, sf_dir)).select("reach_id", "year", "start_date")


@query
def flood_season_start(spark, sf_dir):
    return flood.flood_season_start(trimmed(views.daily_dense, spark, sf_dir))


@query
def flood_season_first_date(spark, sf_dir):
    starts = flood.flood_season_start(trimmed(views.daily_missing, spark, sf_dir), "first_date")
    return starts.withColumn("mode", F.lit("first_date")).unionByName(
        flood.flood_season_start(trimmed(views.daily_missing, spark, sf_dir)).withColumn("mode", F.lit("skip"))
    )


# Baseflow.


@query
def strict_baseflow(spark, sf_dir):
    days = baseflow.strict_baseflow(trimmed(views.daily_missing, spark, sf_dir))
    return days.select("reach_id", "date", r6("slope"), "strict")


@query
def recession_constant(spark, sf_dir):
    constants = baseflow.recession_constant(baseflow.strict_baseflow(trimmed(views.daily_gappy, spark, sf_dir)))
    return constants.select("reach_id", r6("recession"))


@query
def recession_spells(spark, sf_dir):
    return baseflow.recession_spells(trimmed(views.daily_smooth, spark, sf_dir)).select("reach_id", "date", "recedes")


@query
def lyne_hollick(spark, sf_dir):
    days = baseflow.lyne_hollick(trimmed(views.daily_dense, spark, sf_dir))
    return days.select("reach_id", "date", r6("baseflow"))


@query
def eckhardt_fixed(spark, sf_dir):
    days = baseflow.eckhardt(trimmed(views.daily_dense, spark, sf_dir), recession=0.98, maximum=0.8)
    return days.select("reach_id", "date", r6("baseflow"))


@query
def baseflow_index(spark, sf_dir):
    return baseflow.baseflow_index(trimmed(views.daily_smooth, spark, sf_dir)).select("reach_id", r6("baseflow_index"))


# Records.


@query
def sanitize_record(spark, sf_dir):
    flow = F.coalesce(F.col("streamflow"), F.lit(float("nan")))
    nested = F.array(F.struct(flow.alias("value")))
    records = sanitize_records(
        views.daily_missing(spark, sf_dir).select(
            "reach_id", "date", flow.alias("scalar"), F.array(flow).alias("list"), nested.alias("records"),
            F.col("date").cast("timestamp").alias("moment"),
        )
    )
    return records.select(
        "reach_id", "date", "scalar", F.col("list")[0].alias("element"), F.col("records")[0]["value"].alias("nested"), "moment"
    )


def _long_record(records: DataFrame) -> DataFrame:
    """One row per reach, index and position."""
    parts = []
    for field in records.schema.fields[1:]:
        value = F.col(field.name)
        values = value if field.dataType.typeName() == "array" else F.array(value.cast("double"))
        parts.append(F.struct(F.lit(field.name).alias("name"), values.alias("values")))
    named = records.select("reach_id", F.explode(F.array(*parts)).alias("p"))
    placed = named.select("reach_id", "p.name", F.posexplode("p.values").alias("position", "value"))
    return placed.where(F.col("value").isNotNull()).select(
        "reach_id", "name", F.col("position").cast("long").alias("position"), r6("value")
    )


def _rounded_records(records):
    """One row per reach, with arrays as arrays; values at six digits."""
    def rounded(field):
        if field.dataType.typeName() == "array":
            return F.transform(field.name, lambda v: r6(v, "v")).alias(field.name)
        return F.col(field.name) if field.dataType.typeName() in ("long", "integer") else r6(field.name)

    return records.select(*[rounded(f) for f in records.schema.fields])


@query
def indices_record(spark, sf_dir):
    return _rounded_records(indices_table(views.daily_gappy(spark, sf_dir)))


@query
def indices_record_from_store(spark, sf_dir):
    """The same records from a daily table that is laid out by reach."""
    path = scratch_path(spark, "daily")
    name = "daily_" + path.rsplit("-", 1)[1]
    write_daily_store(views.daily_gappy(spark, sf_dir), name, 8, path)
    return _rounded_records(indices_of_store(read_daily_store(spark, name)))


@query
def indices_appended_years(spark, sf_dir):
    """States of the years up to 1999 as a table, later years appended one by one; the record is merged from them."""
    path = scratch_path(spark, "states")
    days = tag_water_years(views.daily_gappy(spark, sf_dir))
    last = days.agg(F.max("water_year")).first()[0]
    for kept in (F.col("water_year") < 2000, *[F.col("water_year") == y for y in range(2000, last + 1)]):
        year_states(days.where(kept).drop("water_year")).write.mode("append").parquet(path)
    return _rounded_records(indices_of_states(spark.read.parquet(path)))


@query
def indices_record_long(spark, sf_dir):
    return _long_record(indices_table(views.daily_gappy(spark, sf_dir)))


@query
def indices_record_sparse_long(spark, sf_dir):
    return _long_record(indices_table(views.daily_sparse(spark, sf_dir)))


@query
def indices_record_blank_long(spark, sf_dir):
    return _long_record(indices_table(views.daily_blank(spark, sf_dir)))
