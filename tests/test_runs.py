import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from freshet.operators.ingest import retrospective
from freshet.plans import job
from freshet.schemas import INDICES_SCHEMA
from freshet.sources import sinks, zarr
from freshet.sources.runs import RunStore
from tests.test_sources import as_set, grid_rows
from verification.zarr_files import write_grid


def days(spark, reaches, years=2, step=1.0):
    """Six-hourly rows of whole water years."""
    return spark.range(reaches * 4 * 365 * years).select(
        (F.col("id") % reaches + 1).alias("feature_id"),
        F.timestamp_add("HOUR", (F.floor(F.col("id") / reaches) * 6).cast("int"), F.lit(datetime(2000, 10, 1))).cast("timestamp_ntz").alias("time"),
        (F.col("id") % 97 + step).alias("streamflow"),
    )


def state(spark, root):
    """Both tables by run, as rows and reaches."""
    snapshot = RunStore(spark, root).snapshot()
    hours = {r["run_id"]: r["count"] for r in sinks.retrospective_of(snapshot).groupBy("run_id").count().collect()}
    records = {}
    for r in sinks.indices_of(snapshot).collect():
        records.setdefault(r["run_id"], set()).add(r["reach_id"])
    return hours, records


def test_both_tables_or_neither(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "store")
    assert state(spark, root) == ({}, {})
    job.run_in_store(days(spark, 3), root, run_id="a")
    before = state(spark, root)
    assert before == ({"a": 3 * 4 * 730}, {"a": {1, 2, 3}})

    def killed(*_):
        raise RuntimeError("killed between the two tables")

    with monkeypatch.context() as patch:
        patch.setattr(job, "indices_table", killed)
        with pytest.raises(RuntimeError):
            job.run_in_store(days(spark, 2), root, mode="overwrite", run_id="a")
        with pytest.raises(RuntimeError):
            job.run_in_store(days(spark, 2), root, run_id="b")
    # The hours of both failed attempts are on disk, and count for nobody.
    written = {p.parent.parent.name + "/" + p.parent.name for p in (tmp_path / "store" / "retrospective").glob("run_id=*/attempt=*/_SUCCESS")}
    assert len(written) == 3 and state(spark, root) == before
    job.run_in_store(days(spark, 2), root, mode="overwrite", run_id="a")
    job.run_in_store(days(spark, 1), root, run_id="b")
    assert state(spark, root) == ({"a": 2 * 4 * 730, "b": 4 * 730}, {"a": {1, 2}, "b": {1}})


def test_crash_while_committing(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "store")
    store = RunStore(spark, root)
    rows = retrospective(grid_rows(spark))
    attempt = store.attempt("a")
    sinks.stage_retrospective(rows, attempt)
    attempt.commit()
    late = store.attempt("a", "overwrite")
    sinks.stage_retrospective(rows.limit(3), late)
    # What a dead driver leaves of a log entry: files that no job commit has renamed.
    leftovers = tmp_path / "store" / "_log" / "_temporary" / "0" / "task" / "part-0.json"
    leftovers.parent.mkdir(parents=True)
    leftovers.write_text('{"version": 9, "kind": "run", "run_id": "a"')
    assert sinks.retrospective_of(store.snapshot(), "a").count() == 45


def test_readers_keep_their_snapshot(spark, tmp_path):
    store = RunStore(spark, str(tmp_path / "store"))
    rows = retrospective(grid_rows(spark))

    def commit(run_id, mode, frame):
        attempt = store.attempt(run_id, mode)
        sinks.stage_retrospective(frame, attempt)
        attempt.commit()

    commit("a", "append", rows)
    held = store.snapshot()
    commit("a", "append", rows)
    commit("b", "append", rows.limit(5))
    commit("a", "overwrite", rows.where("feature_id = 7"))
    count = lambda snapshot, run=None: sinks.retrospective_of(snapshot, run).count()
    assert count(held) == 45 and held.runs == ["a"]
    latest = store.snapshot()
    assert (count(latest), count(latest, "a"), count(latest, "b"), count(latest, "c")) == (14, 9, 5, 0)
    assert as_set(sinks.retrospective_of(latest, "a").drop("run_id")) == as_set(rows.where("feature_id = 7"))
    assert [e["version"] for e in store.entries()] == [1, 2, 3, 4]


def test_entries_of_one_version_have_an_order(spark, tmp_path, monkeypatch):
    store = RunStore(spark, str(tmp_path / "store"))
    rows = retrospective(grid_rows(spark))
    attempts = [store.attempt("a", "overwrite") for _ in range(2)]
    for n, attempt in enumerate(attempts):
        sinks.stage_retrospective(rows.limit(n + 1), attempt)
    with monkeypatch.context() as patch:
        patch.setattr(RunStore, "entries", lambda self: [])  # neither commit sees the other
        for attempt in attempts:
            attempt.commit()
    last = max(range(2), key=lambda n: attempts[n].name)
    assert sinks.retrospective_of(store.snapshot(), "a").count() == last + 1


def test_names_and_modes(spark, tmp_path):
    store = RunStore(spark, str(tmp_path / "store"))
    for bad in ("a/b", "", "a b"):
        with pytest.raises(ValueError):
            store.attempt(bad)
    with pytest.raises(ValueError):
        store.attempt("a", "replace")
    with pytest.raises(ValueError):
        store.run_parts("a", ["x", "x"], lambda *_: None)


def test_slices_go_on_where_they_stopped(spark, tmp_path):
    """Stopped in the third of five slices; the restart does three, and the tables equal one whole run."""
    root, whole = str(tmp_path / "store"), str(tmp_path / "whole")
    rows = days(spark, 10)
    slices = [(i, i + 2) for i in range(0, 10, 2)]
    done = []

    def read(start, stop):
        if len(done) == 2:
            raise RuntimeError("stopped")
        done.append(start)
        return rows.where((F.col("feature_id") > start) & (F.col("feature_id") <= stop))

    with pytest.raises(RuntimeError):
        job.run_slices(spark, read, slices, root, "a")
    assert state(spark, root) == ({}, {}) and list(RunStore(spark, root).finished("a")) == ["0-2", "2-4"]
    done.append(None)
    assert job.run_slices(spark, read, slices, root, "a") == ["4-6", "6-8", "8-10"]
    assert done == [0, 2, None, 4, 6, 8]
    job.run_in_store(rows, whole, run_id="a")
    one, other = RunStore(spark, root).snapshot(), RunStore(spark, whole).snapshot()
    assert as_set(sinks.retrospective_of(one)) == as_set(sinks.retrospective_of(other))
    rounded = lambda frame: {r["reach_id"]: repr([[round(x, 9) if x is not None else None for x in v] if isinstance(v, list) else v for v in r]) for r in frame.select(*INDICES_SCHEMA.names).collect()}
    assert rounded(sinks.indices_of(one)) == rounded(sinks.indices_of(other))
    # The same run again starts afresh, and replaces the first when it is whole.
    done.append(None)
    assert len(job.run_slices(spark, read, slices[:1], root, "a")) == 1
    assert state(spark, root) == ({"a": 2 * 4 * 730}, {"a": {1, 2}})


def test_job_into_a_store(spark, tmp_path):
    grid, root = str(tmp_path / "grid.zarr"), str(tmp_path / "store")
    write_grid(grid_rows(spark), grid, time_size=4, feature_size=2)
    args = ["--input", grid, "--store", root, "--run-id", "x"]
    job.main([*args, "--select", "slice", "--start", "1"])
    assert state(spark, root) == ({"x": 36}, {"x": {17, 27, 37, 47}})
    job.main([*args, "--mode", "overwrite", "--slice-features", "2"])
    assert state(spark, root) == ({"x": 45}, {"x": {7, 17, 27, 37, 47}})
    parts = [e["part"] for e in RunStore(spark, root).entries() if e["kind"] == "part"]
    assert parts == ["0-2", "2-4", "4-5"] and zarr.feature_slices(grid, 2, 1, 4) == [(1, 2), (2, 4)]
    for wrong in (["--input", grid], ["--input", grid, "--store", root, "--slice-features", "2"]):
        with pytest.raises(ValueError):
            job.main(wrong)


def test_overwrite_in_a_dynamic_session(spark, tmp_path):
    """A session that overwrites partitions dynamically leaves no year of the earlier run."""
    rows = retrospective(grid_rows(spark).unionByName(grid_rows(spark).withColumn("time", F.timestamp_add("YEAR", F.lit(1), "time").cast("timestamp_ntz"))))
    name = "dynamic_" + re.sub(r"\W", "_", tmp_path.name)
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        for target in (str(tmp_path / "retro"), name):
            for run_id in ("a", "b"):
                sinks.write_retrospective(rows, target, mode="overwrite", run_id=run_id)
            sinks.write_retrospective(rows.where("year(time) = 1980"), target, mode="overwrite", run_id="a")
            assert as_set(sinks.read_retrospective(spark, target, "a").select(F.year("time")).distinct()) == {(1980,)}
            assert sinks.read_retrospective(spark, target, "b").count() == 90
        assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "dynamic"
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
        spark.sql(f"DROP TABLE IF EXISTS {name}")
