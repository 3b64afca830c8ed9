import json
import os
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from freshet.operators.daily import daily_means, first_rows
from freshet.operators.grid import flatten_chunks, grid_summary, split_chunks, to_chunks
from freshet.operators.ingest import retrospective
from freshet.operators.sanitize import sanitize_records
from freshet.operators.selection import select
from freshet.plans import job
from freshet.schemas import FLOW_VARIABLES, INDICES_SCHEMA, RETRO_SCHEMA
from freshet.sources import sinks, tables, zarr
from verification.zarr_files import write_grid

NAN = float("nan")


def hours(spark, rows):
    return spark.createDataFrame(rows, "feature_id long, time timestamp_ntz, streamflow double")


def grid_rows(spark, times=9, features=5):
    return spark.range(times * features).select(
        (F.col("id") % features * 10 + 7).alias("feature_id"),
        F.timestamp_add("HOUR", (F.col("id") / features).cast("int"), F.lit(datetime(1979, 2, 1, 1))).cast("timestamp_ntz").alias("time"),
        (F.col("id") * 1.5).alias("streamflow"),
        F.when(F.col("id") % 4 != 0, F.col("id") / 8).alias("velocity"),
    )


def as_set(frame):
    return {tuple(r) for r in frame.collect()}


def test_fill_numbers_compare_before_narrowing(spark):
    raw = spark.createDataFrame(
        [(1, datetime(2000, 1, 1), -999900.0, -999900000.0, -99990.0), (1, datetime(2000, 1, 1, 1), 2.5, NAN, 0.0)],
        "feature_id int, time timestamp_ntz, streamflow double, qBucket double, q_lateral double",
    )
    rows = retrospective(raw)
    assert rows.schema == RETRO_SCHEMA
    first, second = rows.orderBy("time").collect()
    assert first["streamflow"] is None and first["qBucket"] is None and first["q_lateral"] is None
    assert second["streamflow"] == 2.5 and second["qBucket"] is None and second["q_lateral"] == 0.0
    assert first["velocity"] is None


def test_fill_numbers_stored_as_float(spark):
    raw = spark.createDataFrame([(1, datetime(2000, 1, 1), -999900.0)], "feature_id int, time timestamp_ntz, streamflow float")
    assert retrospective(raw).first()["streamflow"] is None


def test_daily_means_and_missing_hour(spark):
    rows = hours(spark, [
        (101, datetime(2000, 1, 1), 100.0), (101, datetime(2000, 1, 1, 1), 110.0), (102, datetime(2000, 2, 28, 23), 120.0),
        (103, datetime(2000, 1, 1), 1.0), (103, datetime(2000, 1, 1, 1), NAN), (None, datetime(2000, 1, 1), 4.0),
    ])
    got = {(r["reach_id"], str(r["date"])): r["streamflow"] for r in daily_means(rows).collect()}
    assert got == {(101, "2000-01-01"): 105.0, (102, "2000-02-28"): 120.0, (103, "2000-01-01"): None, (None, "2000-01-01"): 4.0}


def test_first_rows(spark):
    rows = hours(spark, [(f, datetime(2000, 1, 1, h), float(h)) for f in (1, 2) for h in range(10)])
    assert as_set(first_rows(rows, 3).select("feature_id", "streamflow")) == {(f, float(h)) for f in (1, 2) for h in range(3)}


def test_hot_series_stays_small_after_partial_means(spark):
    """A third of all rows in one reach and day ends as one daily row."""
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).cast("long").alias("feature_id"),
        F.lit(datetime(2000, 1, 1)).cast("timestamp_ntz").alias("time"),
        F.lit(2.0).alias("streamflow"),
    )
    daily = daily_means(rows)
    assert daily.where("reach_id = 1").collect()[0]["streamflow"] == 2.0
    plan = daily._jdf.queryExecution().executedPlan().toString()
    assert "partial_avg" in plan


def test_chunks_roundtrip_with_uneven_edges(spark):
    rows = grid_rows(spark)
    chunks = to_chunks(rows, time_size=4, feature_size=2)
    assert chunks.count() == 3 * 3
    assert as_set(flatten_chunks(chunks)) == as_set(rows)


def test_chunk_cells_without_rows_are_null(spark):
    rows = grid_rows(spark).where("feature_id <> 17 or streamflow > 20")
    back = flatten_chunks(to_chunks(rows, 4, 2))
    assert back.count() == 45
    assert as_set(back.where("streamflow is not null")) == as_set(rows)


def test_repeated_cell_is_an_error(spark):
    rows = grid_rows(spark)
    with pytest.raises(Exception, match="repeated grid cell"):
        to_chunks(rows.union(rows.limit(1)), 4, 2).collect()


def test_broken_chunks_are_set_aside(spark):
    chunks = to_chunks(grid_rows(spark), 4, 2)
    broken = chunks.withColumn(
        "velocity", F.when(F.col("time_chunk") == 1, F.slice("velocity", 1, 2)).otherwise(F.col("velocity"))
    )
    good, bad = split_chunks(broken)
    assert (good.count(), bad.count()) == (6, 3)
    with pytest.raises(Exception, match="broken chunk 1"):
        flatten_chunks(broken).collect()
    left_out = Observation()
    assert flatten_chunks(broken, "skip", left_out).count() == 45 - 4 * 5
    assert left_out.get["chunks"] == 3


@pytest.mark.parametrize("size", [1, 2, 3])
def test_cells_do_not_depend_on_the_block_size(spark, size):
    rows = grid_rows(spark).where("(hour(time) + feature_id) % 3 = 0")
    want = rows.select("time").distinct().count() * rows.select("feature_id").distinct().count()
    assert flatten_chunks(to_chunks(rows, size, size)).count() == want


@pytest.mark.parametrize("column", ["time", "feature_id"])
def test_cell_without_coordinate_is_an_error(spark, column):
    rows = grid_rows(spark)
    lost = rows.limit(1).withColumn(column, F.lit(None).cast(rows.schema[column].dataType))
    with pytest.raises(Exception, match=f"without {column}"):
        to_chunks(rows.union(lost), 4, 2).collect()


def test_grid_summary(spark):
    row = grid_summary(grid_rows(spark)).first()
    assert (row["feature_count"], row["time_count"], row["first_feature"], row["last_feature"]) == (5, 9, 7, 47)
    assert row["streamflow_missing"] == 0 and row["velocity_missing"] == pytest.approx(12 / 45)


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("grid") / "chrtout.zarr")
    write_grid(grid_rows(spark), path, time_size=4, feature_size=2)
    return path


def load(spark, path, **options):
    zarr.register(spark)
    return spark.read.format("zarr_grid").options(**options).load(path)


def test_zarr_equals_its_rows(spark, store):
    assert as_set(load(spark, store)) == as_set(grid_rows(spark))
    assert load(spark, store).rdd.getNumPartitions() == 9


def test_zarr_positions_and_filters(spark, store):
    part = load(spark, store, feature_start=1, feature_stop=4, time_stop=5)
    assert as_set(part.select("feature_id").distinct()) == {(17,), (27,), (37,)}
    assert part.count() == 15
    picked = load(spark, store).where("feature_id in (7, 47)")
    assert as_set(picked) == as_set(grid_rows(spark).where("feature_id in (7, 47)"))
    assert load(spark, store, variables="velocity").columns == ["feature_id", "time", "velocity"]
    assert load(spark, store, feature_start=-1).count() == 9


def blocks_read(monkeypatch, frame):
    """Block files that the reader's tasks open for a frame, run in this process."""
    opened = []
    read = zarr._content
    monkeypatch.setattr(zarr, "_content", lambda system, path: opened.append(path) or read(system, path))
    reader = frame
    for partition in reader.partitions():
        list(reader.read(partition))
    return [p for p in opened if "streamflow/" in p or "velocity/" in p]


def test_zarr_reads_only_the_blocks_it_needs(spark, store, monkeypatch):
    from pyspark.sql.datasource import EqualTo, In, LessThan

    source = zarr.ZarrGridSource({"path": store, "variables": "streamflow"})
    reader = source.reader(source.schema())
    list(reader.pushFilters([In(("feature_id",), (7, 17)), LessThan(("time",), datetime(1979, 2, 1, 3))]))
    assert [p.rsplit("/", 2)[1:] for p in blocks_read(monkeypatch, reader)] == [["streamflow", "0.0"]]
    reader = source.reader(source.schema())
    list(reader.pushFilters([EqualTo(("feature_id",), 99)]))
    assert blocks_read(monkeypatch, reader) == []


def test_zarr_time_filters(spark, store):
    for where in ("time < '1979-02-01 03:00:00'", "time = timestamp_ntz'1979-02-01 05:00:00' and feature_id > 20", "time in (timestamp_ntz'1979-02-01 04:00:00') or feature_id = 7"):
        assert as_set(load(spark, store).where(where)) == as_set(grid_rows(spark).where(where))
    assert load(spark, store).where("feature_id = 12345").count() == 0


def test_zarr_by_uri_and_absent_parts(spark, tmp_path):
    path = str(tmp_path / "shared.zarr")
    write_grid(grid_rows(spark), f"file://{path}", time_size=4, feature_size=2)
    assert as_set(load(spark, f"file://{path}")) == as_set(grid_rows(spark))
    assert zarr.grid_sizes(path) == {"time": 9, "feature_id": 5}
    zarr.check_reaches(path, [7, 47])
    with pytest.raises(KeyError):
        zarr.check_reaches(path, [7, 8])
    os.rename(os.path.join(path, "velocity"), os.path.join(path, "unmounted"))
    with pytest.raises(Exception, match="velocity is not there"):
        load(spark, path).count()
    os.rename(os.path.join(path, "unmounted"), os.path.join(path, "velocity"))
    os.remove(os.path.join(path, "time", "1"))
    with pytest.raises(Exception, match="coordinate block"):
        load(spark, path).count()


def test_zarr_other_block_sizes(spark, store):
    assert as_set(load(spark, store, time_size=3, feature_size=5)) == as_set(grid_rows(spark))
    assert load(spark, store, blocks_per_task=3).count() == 45


def test_zarr_scale_offset_and_missing_block(spark, tmp_path):
    path = tmp_path / "g.zarr"
    layouts = {
        "time": ({"shape": [2], "chunks": [2], "dtype": "<i4", "fill_value": 0}, {"_ARRAY_DIMENSIONS": ["time"], "units": "days since 2000-01-01"}),
        "feature_id": ({"shape": [2], "chunks": [2], "dtype": "<i8", "fill_value": 0}, {"_ARRAY_DIMENSIONS": ["feature_id"]}),
        "streamflow": (
            {"shape": [2, 2], "chunks": [1, 2], "dtype": "<i4", "fill_value": -9},
            {"_ARRAY_DIMENSIONS": ["time", "feature_id"], "_FillValue": -9, "scale_factor": 0.5, "add_offset": 1.0},
        ),
    }
    for name, (layout, attributes) in layouts.items():
        (path / name).mkdir(parents=True)
        base = {"zarr_format": 2, "order": "C", "compressor": None, "filters": None}
        (path / name / ".zarray").write_text(json.dumps(base | layout))
        (path / name / ".zattrs").write_text(json.dumps(attributes))
    (path / "time" / "0").write_bytes(np.array([0, 1], "<i4").tobytes())
    (path / "feature_id" / "0").write_bytes(np.array([5, 6], "<i8").tobytes())
    (path / "streamflow" / "0.0").write_bytes(np.array([4, -9], "<i4").tobytes())
    got = {(r["feature_id"], r["time"].day): r["streamflow"] for r in load(spark, str(path)).collect()}
    assert got == {(5, 1): 3.0, (6, 1): None, (5, 2): None, (6, 2): None}


def test_zarr_bad_block_raises_or_is_left_out(spark, tmp_path):
    path = str(tmp_path / "bad.zarr")
    write_grid(grid_rows(spark), path, time_size=4, feature_size=2)
    with open(os.path.join(path, "velocity", "0.0"), "wb") as handle:
        handle.write(b"not compressed")
    with pytest.raises(Exception):
        load(spark, path).count()
    assert load(spark, path, on_bad_block="skip").count() == 45 - 8


def test_retrospective_append_and_repeat(spark, tmp_path):
    path = str(tmp_path / "retro")
    rows = retrospective(grid_rows(spark))
    sinks.write_retrospective(rows, path, run_id="1e5")
    sinks.write_retrospective(rows, path, run_id="b")
    assert sinks.read_retrospective(spark, path).count() == 90
    assert sinks.read_retrospective(spark, path, "1e5").count() == 45
    sinks.write_retrospective(rows, path, mode="overwrite", run_id="b")
    assert sinks.read_retrospective(spark, path).count() == 90


def test_overwrite_replaces_one_run_with_all_its_years(spark, tmp_path):
    path = str(tmp_path / "retro")
    two_years = retrospective(grid_rows(spark).unionByName(grid_rows(spark).withColumn("time", F.timestamp_add("YEAR", F.lit(1), "time").cast("timestamp_ntz"))))
    for run_id in ("a", "b"):
        sinks.write_retrospective(two_years, path, mode="overwrite", run_id=run_id)
    sinks.write_retrospective(two_years.where("year(time) = 1980"), path, mode="overwrite", run_id="a")
    assert as_set(sinks.read_retrospective(spark, path, "a").select(F.year("time")).distinct()) == {(1980,)}
    assert sinks.read_retrospective(spark, path, "b").count() == 90
    with pytest.raises(ValueError):
        sinks.write_retrospective(two_years, path, run_id="a/b")
    with pytest.raises(ValueError):
        sinks.write_retrospective(two_years, path, mode="replace")


def test_named_tables(spark):
    rows = retrospective(grid_rows(spark))
    name = f"retro_{os.getpid()}"
    try:
        sinks.write_retrospective(rows, name, run_id="a")
        sinks.write_retrospective(rows, name, run_id="a")
        sinks.write_retrospective(rows, name, mode="overwrite", run_id="b")
        assert (sinks.read_retrospective(spark, name).count(), sinks.read_retrospective(spark, name, "a").count()) == (135, 90)
        sinks.write_retrospective(rows.where("feature_id = 7"), name, mode="overwrite", run_id="a")
        assert as_set(sinks.read_retrospective(spark, name, "a")) == as_set(rows.where("feature_id = 7"))
        assert as_set(sinks.read_retrospective(spark, name, "b")) == as_set(rows)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_required_reach_id(spark, tmp_path):
    record = spark.createDataFrame([(None,) * len(INDICES_SCHEMA)], ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in INDICES_SCHEMA))
    with pytest.raises(Exception, match="reach_id is required"):
        sinks.write_indices(record, str(tmp_path / "i"))


def test_csv_with_index_column(spark, tmp_path):
    (tmp_path / "d.csv").write_text(",date,streamflow\n0,2000-01-01,1.5\n1,2000-01-02,\n")
    days = tables.read_daily_csv(spark, str(tmp_path / "d.csv"), reach_id=9)
    assert [(r["reach_id"], str(r["date"]), r["streamflow"]) for r in days.orderBy("date").collect()] == [
        (9, "2000-01-01", 1.5), (9, "2000-01-02", None)
    ]
    (tmp_path / "h.csv").write_text(",feature_id,time,streamflow\n0,3,2000-01-01 05:00:00,2.5\n")
    row = tables.read_hourly_csv(spark, str(tmp_path / "h.csv")).first()
    assert row["time"] == datetime(2000, 1, 1, 5) and row["streamflow"] == 2.5 and row["velocity"] is None


def test_csv_files_with_their_own_headers(spark, tmp_path):
    folder = tmp_path / "csv"
    folder.mkdir()
    (folder / "a.csv").write_text("feature_id,time,streamflow,velocity\n3,2000-01-01 05:00:00,2.5,0.5\n")
    (folder / "b.csv").write_text(",velocity,time,streamflow,feature_id\n0,0.25,2000-01-01 06:00:00,1.5,4\n")
    (folder / "c.csv").write_text("feature_id,time,qBucket\n5,2000-01-01 07:00:00,9\n")
    rows = {r["feature_id"]: (r["streamflow"], r["velocity"], r["qBucket"]) for r in tables.read_hourly_csv(spark, str(folder)).collect()}
    assert rows == {3: (2.5, 0.5, None), 4: (1.5, 0.25, None), 5: (None, None, 9.0)}


def test_records_in_memory(spark):
    rows = tables.from_records(spark, [{"feature_id": 1, "time": datetime(2000, 1, 1), "streamflow": 2.0}, {"feature_id": 2}])
    assert rows.schema == RETRO_SCHEMA and [r["streamflow"] for r in rows.orderBy("feature_id").collect()] == [2.0, None]


def test_null_ids_have_no_position(spark):
    rows = hours(spark, [(None, datetime(2000, 1, 1), 1.0), (1, datetime(2000, 1, 1), 2.0), (2, datetime(2000, 1, 1), 3.0)])
    for start, stop, want in ((0, None, {1, 2}), (0, 5, {1, 2}), (0, 1, {1}), (1, None, {2}), (-1, None, {2})):
        assert {r["feature_id"] for r in select(rows, "slice", start=start, stop=stop).collect()} == want
    for ids in (None, []):
        with pytest.raises(ValueError):
            select(rows, "reach_list", ids=ids)


def test_days_are_utc_days_in_any_session_zone(spark):
    rows = spark.createDataFrame([(1, 946_684_800 - 1800, 1.0), (1, 946_684_800 + 1800, 3.0)], "feature_id long, s long, streamflow double")
    rows = rows.select("feature_id", F.timestamp_seconds("s").alias("time"), "streamflow")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        got = {str(r["date"]): r["streamflow"] for r in daily_means(rows).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got == {"1999-12-31": 1.0, "2000-01-01": 3.0}


def test_text_shards(spark, tmp_path):
    path = tmp_path / "text"
    sinks.write_text(grid_rows(spark), str(path), shards=2)
    assert len([p for p in path.iterdir() if p.name.startswith("part-")]) == 2


def test_sanitize_scalars_lists_and_records(spark):
    frame = spark.sql("""
        SELECT CAST('NaN' AS DOUBLE) AS a, array(1D, NULL, CAST('NaN' AS DOUBLE)) AS b, array(1, NULL) AS c,
               named_struct('x', CAST('NaN' AS FLOAT), 'y', array(CAST('NaN' AS FLOAT))) AS d,
               array(named_struct('x', CAST('NaN' AS DOUBLE))) AS e, timestamp_ntz'1979-02-01 01:00:00' AS f,
               timestamp_ntz'1979-02-01 01:00:00.25' AS g, interval '1 02:03:04' day to second AS h,
               interval '-1 02:00:00' day to second AS i, map('k', CAST('NaN' AS DOUBLE)) AS j, CAST(NULL AS ARRAY<DOUBLE>) AS k, 7 AS l
    """)
    row = sanitize_records(frame).first()
    assert row["a"] is None and row["b"] == [1.0, -99.0, -99.0] and row["c"] == [1, -99]
    assert row["d"]["x"] is None and row["d"]["y"] == [-99.0] and row["e"][0]["x"] is None
    assert (row["f"], row["g"]) == ("1979-02-01T01:00:00", "1979-02-01T01:00:00.250000")
    assert (row["h"], row["i"]) == ("1 days 02:03:04", "-2 days +22:00:00")
    assert row["j"] == {"k": None} and row["k"] is None and row["l"] == 7


def test_job_end_to_end(spark, tmp_path):
    """Two water years of six-hourly rows for three reaches through both tables."""
    rows = spark.range(3 * 4 * 730).select(
        (F.col("id") % 3 + 1).alias("feature_id"),
        F.timestamp_add("HOUR", (F.floor(F.col("id") / 3) * 6).cast("int"), F.lit(datetime(2000, 10, 1))).cast("timestamp_ntz").alias("time"),
        F.when((F.col("id") % 3 == 2) & (F.col("id") < 1460 * 3), -999900.0).otherwise(F.col("id") % 97 + 1.0).alias("streamflow"),
    )
    source = str(tmp_path / "in")
    rows.write.parquet(source)
    out = [str(tmp_path / "retro"), str(tmp_path / "indices")]
    args = ["--input", source, "--format", "parquet", "--retro-out", out[0], "--indices-out", out[1], "--select", "slice", "--start", "1"]
    run_id = job.main(args)
    assert sinks.read_retrospective(spark, out[0], run_id).count() == 2 * 4 * 730
    records = {r["reach_id"]: r for r in sinks.read_indices(spark, out[1]).collect()}
    assert set(records) == {2, 3}
    assert records[2]["monthwise_mean"][0] > 0 and len(records[2]["nth_percentile_flows"]) == 13
    assert records[3]["monthwise_mean"] == [-99.0] * 12 and records[3]["zero_flow_days_n"] is None


    # A second slice is a run of its own; repeating the first replaces only the first.
    again = args[:-1] + ["0", "--stop", "1", "--mode", "overwrite", "--run-id", "other"]
    job.main(again)
    job.main(args[:-1] + ["2", "--mode", "overwrite", "--run-id", run_id, "--time-stop", "1460"])
    assert {r["reach_id"] for r in sinks.read_indices(spark, out[1], "other").collect()} == {1}
    assert {r["reach_id"] for r in sinks.read_indices(spark, out[1], run_id).collect()} == {3}
    hours_left = sinks.read_retrospective(spark, out[0], run_id)
    assert hours_left.count() == 1460 and sinks.read_retrospective(spark, out[0], "other").count() == 4 * 730


def test_job_options(spark, tmp_path):
    store = str(tmp_path / "job.zarr")
    write_grid(grid_rows(spark), store, time_size=4, feature_size=2)
    with open(os.path.join(store, "velocity", "0.0"), "wb") as handle:
        handle.write(b"broken")
    args = ["--input", store, "--retro-out", str(tmp_path / "r"), "--indices-out", str(tmp_path / "i"), "--run-id", "x", "--mode", "overwrite"]
    with pytest.raises(Exception):
        job.main(args)
    job.main([*args, "--on-bad-block", "skip", "--time-stop", "5", "--empty-year", "first_date", "--option", "blocks_per_task=1"])
    assert sinks.read_retrospective(spark, str(tmp_path / "r"), "x").count() == 25 - 8
    listed = [*args, "--on-bad-block", "skip", "--select", "reach_list", "--reaches", "7", "999"]
    with pytest.raises(KeyError):
        job.main(listed)
    job.main([*listed, "--on-missing", "ignore"])
    assert sinks.read_retrospective(spark, str(tmp_path / "r"), "x").count() == 5
    with pytest.raises(ValueError):
        job.main([*args, "--select", "reach_list"])
