"""Work on whole blocks of a grid: rechunking, day sums, block lists, broken blocks as rows."""

import json
import os
import uuid

import pytest
from pyspark.sql import functions as F

from freshet.operators.daily import daily_means, daily_means_from_sums
from freshet.operators.grid import chunk_pieces, flatten_chunks, rechunk, to_chunks
from freshet.plans import job
from freshet.sources import sinks, zarr
from freshet.sources.runs import RunStore
from tests.test_sources import as_set, blocks_read, grid_rows, load
from verification.queries import QUERIES
from verification.zarr_files import ZLIB, block_files, write_grid


@pytest.mark.parametrize(("source", "target"), [((4, 2), (3, 3)), ((4, 2), (9, 5)), ((9, 5), (1, 1)), ((2, 3), (4, 2)), ((4, 2), (4, 2)), ((3, 2), (672, 2000))])
def test_rechunk_keeps_every_cell(spark, source, target):
    chunks = to_chunks(grid_rows(spark), *source)
    got = rechunk(chunks, source, target)
    want = {(r["time_chunk"], r["feature_chunk"]): r for r in to_chunks(grid_rows(spark), *target).collect()}
    found = {(r["time_chunk"], r["feature_chunk"]): r for r in got.collect()}
    assert found.keys() == want.keys()
    for place, row in want.items():
        assert all(found[place][c] == row[c] for c in ("times", "feature_ids", "streamflow", "velocity"))


def test_pieces_not_cells_are_shuffled(spark):
    """Blocks of 4 x 2 cut for blocks of 3 x 3: rows are pieces, one for each block both have cells in."""
    chunks = to_chunks(grid_rows(spark), 4, 2)
    pieces = chunk_pieces(chunks, (4, 2), (3, 3))
    places = {(t // 4, f // 2, t // 3, f // 3) for t in range(9) for f in range(5)}
    assert pieces.count() == len(places) == 20 < 45
    assert sum(len(r["streamflow"]) for r in pieces.collect()) == 45
    plan = rechunk(chunks, (4, 2), (3, 3))._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan.split("FlatMapGroupsInArrow")[1].split("MapInArrow")[0]


def test_rechunk_of_awkward_chunks(spark):
    chunks = to_chunks(grid_rows(spark), 4, 2).persist()
    # Without one chunk its cells are null; without a row of chunks its times are left out.
    got = flatten_chunks(rechunk(chunks.where("not (time_chunk = 1 and feature_chunk = 0)"), (4, 2), (9, 5)))
    lost = F.hour("time").between(5, 8) & F.col("feature_id").isin(7, 17)
    assert got.count() == 45 and as_set(got.where(~lost)) == as_set(grid_rows(spark).where(~lost))
    assert got.where(lost).where("streamflow is null and velocity is null").count() == 8
    got = flatten_chunks(rechunk(chunks.where("time_chunk <> 1"), (4, 2), (2, 5)))
    assert as_set(got) == as_set(grid_rows(spark).where(~F.hour("time").between(5, 8)))
    assert rechunk(chunks.where("false"), (4, 2)).count() == 0
    with pytest.raises(Exception, match=r"broken chunk \d, \d: velocity"):
        rechunk(chunks.withColumn("velocity", F.slice("velocity", 1, 3)), (4, 2)).collect()
    with pytest.raises(Exception, match="repeated grid cell"):
        rechunk(chunks.union(chunks.limit(1)), (4, 2)).collect()
    nan = chunks.withColumn("velocity", F.transform("velocity", lambda v: F.when(v > 4, float("nan")).otherwise(v)))
    values = [r["velocity"] for r in flatten_chunks(rechunk(nan, (4, 2), (5, 3))).collect()]
    assert any(v is None for v in values) and any(v is not None and v != v for v in values)


@pytest.fixture(scope="module")
def wide(spark, tmp_path_factory):
    """A hundred blocks of 60 reaches, one of times."""
    path = str(tmp_path_factory.mktemp("grid") / "wide.zarr")
    write_grid(grid_rows(spark, times=3, features=6000), path, time_size=4, feature_size=60)
    return path


def test_a_table_of_ids_opens_only_its_blocks(spark, wide, monkeypatch):
    """A thousand reaches in 20 of 100 blocks: 20 block files of each variable are opened."""
    wanted = spark.range(1000).select((F.col("id") % 50 + F.floor(F.col("id") / 50) * 300).alias("at")).select((F.col("at") * 10 + 7).alias("feature_id"))
    frame = zarr.read_reaches_in(spark, wide, wanted)
    assert frame.count() == 3000 and as_set(frame.select("feature_id").distinct()) == as_set(wanted)
    options = {"path": wide, "feature_blocks": zarr._ranges([i * 5 for i in range(20)])}
    source = zarr.ZarrGridSource(options)
    reader = source.reader(source.schema())
    assert len(reader.partitions()) == 20 == frame.rdd.getNumPartitions()
    opened = blocks_read(monkeypatch, reader)
    assert len(opened) == 40 and {int(p.rsplit(".", 1)[1]) % 5 for p in opened} == {0}


def test_small_blocks_share_tasks(spark, tmp_path, monkeypatch):
    """1200 blocks of a reach and four hours: some sixty tasks, in each of them times are read once; every broken block is still told by itself."""
    path = str(tmp_path / "small.zarr")
    write_grid(grid_rows(spark, times=16, features=300), path, time_size=4, feature_size=1)
    for block in ("0.0", "0.1", "3.299"):
        with open(os.path.join(path, "streamflow", block), "wb") as handle:
            handle.write(b"not compressed")
    frame = load(spark, path, on_bad_block="mark")
    assert frame.rdd.getNumPartitions() <= 65 and load(spark, path, layout="axis").rdd.getNumPartitions() <= 65
    good, broken = zarr.split_broken(frame)
    assert {tuple(r)[:4] for r in broken.collect()} == {(0, 4, 0, 1), (0, 4, 1, 2), (12, 16, 299, 300)}
    lost = (F.col("feature_id").isin(7, 17) & (F.hour("time") <= 4)) | ((F.col("feature_id") == 2997) & (F.hour("time") > 12))
    assert as_set(good) == as_set(grid_rows(spark, times=16, features=300).where(~lost)) and good.count() == 4800 - 12
    source = zarr.ZarrGridSource({"path": path, "on_bad_block": "skip"})
    reader, opened, read = source.reader(source.schema()), [], zarr._content
    monkeypatch.setattr(zarr, "_content", lambda system, path: opened.append(path) or read(system, path))
    batches = [list(reader.read(p)) for p in reader.partitions()]
    assert len([p for p in opened if "/time/" in p]) <= len(batches) + 3 and max(map(len, batches)) == 1
    assert len([p for p in opened if "/streamflow/" in p]) == 1200


def test_small_blosc_blocks_share_tasks(spark, tmp_path):
    """260 containers in at most 65 tasks, each of which sends its blocks' rows as one batch."""
    path, storage = str(tmp_path / "blosc.zarr"), {"compressor": {"id": "blosc", "cname": "zstd", "shuffle": 2}, "filters": None}
    write_grid(grid_rows(spark, times=8, features=130), path, time_size=4, feature_size=1, storage={"streamflow": storage, "velocity": storage})
    source = zarr.ZarrGridSource({"path": path})
    reader = source.reader(source.schema())
    batches = [list(reader.read(p)) for p in reader.partitions()]
    assert len(batches) <= 65 and [len(b) for b in batches] == [1] * len(batches)
    assert sum(b.num_rows for part in batches for b in part) == 8 * 130
    assert as_set(load(spark, path)) == as_set(grid_rows(spark, times=8, features=130))


def test_a_file_of_the_store_is_written_once(spark):
    """Three by three blocks: no coordinate block is written again by each of its chunks."""
    chunks = to_chunks(grid_rows(spark), 4, 2).collect()
    files = [name for chunk in chunks for name, _ in block_files(chunk, ["streamflow"], 4, 2, lambda name: ZLIB)]
    assert len(files) == len(set(files)) == 3 + 3 + 9


def test_a_store_is_written_from_one_read(spark, tmp_path):
    """Rows of one partition are made once for cells, axes and lengths; the store has what they have."""
    made, path = tmp_path / "made", str(tmp_path / "once.zarr")
    made.mkdir()

    def noted(batches):
        (made / uuid.uuid4().hex).touch()
        yield from batches

    nan = F.when(F.col("velocity") == 2.25, float("nan")).otherwise(F.col("velocity")).alias("velocity")
    rows = grid_rows(spark).select("feature_id", "time", "streamflow", nan).where("feature_id <> 17 or streamflow > 20")
    write_grid(rows.coalesce(1).mapInArrow(noted, rows.schema), path, time_size=4, feature_size=2)
    assert len(list(made.iterdir())) == 1
    assert zarr.grid_sizes(path) == {"time": 9, "feature_id": 5}
    back, whole = load(spark, path), F.col("streamflow").isNotNull()
    assert back.count() == 45 and back.where(~whole).where("velocity is null").count() == 45 - rows.count() > 0
    assert as_set(back.where(whole)) == as_set(rows.withColumn("velocity", F.nanvl("velocity", F.lit(None).cast("double"))))
    write_grid(rows.where("false"), str(tmp_path / "none.zarr"), time_size=4, feature_size=2)
    assert zarr.grid_sizes(str(tmp_path / "none.zarr")) == {"time": 0, "feature_id": 0}


def test_ids_that_the_grid_lacks(spark, wide):
    wanted = spark.createDataFrame([(7,), (8,), (None,)], "c long")
    with pytest.raises(KeyError, match="8"):
        zarr.read_reaches_in(spark, wide, wanted, key="c")
    assert zarr.read_reaches_in(spark, wide, wanted, key="c", on_missing="ignore", variables="velocity").count() == 3
    assert zarr.read_reaches_in(spark, wide, wanted.where("c = 8"), key="c", on_missing="ignore").count() == 0


def test_block_lists():
    assert zarr._ranges([7, 0, 1, 2, 9, 8]) == "0-2,7-9" and zarr._numbers("0-2,7-9") == {0, 1, 2, 7, 8, 9}
    assert zarr._ranges([]) == "" and zarr._numbers("") == set() and zarr._numbers(zarr._ranges([4])) == {4}


def test_chunks_straight_from_the_source(spark, tmp_path):
    path = str(tmp_path / "g.zarr")
    write_grid(grid_rows(spark), path, time_size=4, feature_size=2)
    chunks = load(spark, path, layout="chunks")
    assert chunks.count() == 9 and as_set(flatten_chunks(chunks)) == as_set(grid_rows(spark))
    assert as_set(flatten_chunks(rechunk(chunks, (4, 2), (5, 4)))) == as_set(grid_rows(spark))
    axis = as_set(load(spark, path, layout="axis"))
    assert axis == {(7 + 10 * i, i) for i in range(5)}
    with pytest.raises(Exception, match="unknown layout"):
        load(spark, path, layout="columns")


def test_day_sums_leave_the_blocks(spark, tmp_path):
    """Ten days of hours of five reaches, a few missing: the scan gives rows by day, not by hour."""
    path = str(tmp_path / "g.zarr")
    rows = grid_rows(spark, times=240).withColumn("streamflow", F.when(F.col("streamflow") % 97 != 0, F.col("streamflow")))
    write_grid(rows, path, time_size=96, feature_size=2)
    sums = load(spark, path, layout="day_sums", variables="streamflow")
    # Hours begin at one, so eleven days; blocks of 96 hours cut two of them once more.
    assert sums.count() == 5 * (11 + 2) and rows.count() == 5 * 240
    want = {(r["reach_id"], r["date"]): r["streamflow"] for r in daily_means(rows).collect()}
    got = {(r["reach_id"], r["date"]): r["streamflow"] for r in daily_means_from_sums(sums).collect()}
    assert got.keys() == want.keys() and any(v is None for v in want.values())
    for key, value in want.items():
        assert got[key] == pytest.approx(value) if value is not None else got[key] is None


def broken_store(spark, path):
    write_grid(grid_rows(spark), path, time_size=4, feature_size=2)
    for name, block in (("velocity", "0.0"), ("streamflow", "2.1")):
        with open(os.path.join(path, name, block), "wb") as handle:
            handle.write(b"not compressed")


@pytest.mark.parametrize("layout", ["rows", "chunks", "day_sums"])
def test_broken_blocks_are_rows(spark, tmp_path, layout):
    path = str(tmp_path / "bad.zarr")
    broken_store(spark, path)
    good, broken = zarr.split_broken(load(spark, path, on_bad_block="mark", layout=layout))
    places = {tuple(r)[:4]: r["reason"] for r in broken.collect()}
    assert places.keys() == {(0, 4, 0, 2), (8, 9, 2, 4)} and all("error" in reason for reason in places.values())
    assert good.count() == load(spark, path, on_bad_block="skip", layout=layout).count()
    if layout == "rows":
        assert as_set(good) == as_set(load(spark, path, on_bad_block="skip")) and good.count() == 45 - 8 - 2


def test_a_broken_coordinate_is_marked_for_all_its_blocks(spark, tmp_path):
    path = str(tmp_path / "bad.zarr")
    write_grid(grid_rows(spark), path, time_size=4, feature_size=2)
    os.remove(os.path.join(path, "feature_id", "1"))
    frame = load(spark, path, on_bad_block="mark")
    good, broken = zarr.split_broken(frame)
    assert good.count() == 27 and broken.count() == 3
    assert good.where("feature_id = 7").count() == 9
    with pytest.raises(Exception, match="coordinate block"):
        load(spark, path).where("feature_id = 7").count()


def test_job_lists_broken_blocks(spark, tmp_path):
    path, root = str(tmp_path / "bad.zarr"), str(tmp_path / "store")
    broken_store(spark, path)
    job.main(["--input", path, "--store", root, "--run-id", "x", "--on-bad-block", "mark"])
    job.run_in_store(grid_rows(spark).limit(7), root, run_id="y")
    snapshot = RunStore(spark, root).snapshot()
    assert sinks.retrospective_of(snapshot, "x").count() == 35 and sinks.retrospective_of(snapshot).count() == 42
    assert {(r["run_id"], *tuple(r)[:4]) for r in sinks.broken_blocks_of(snapshot).collect()} == {("x", 0, 4, 0, 2), ("x", 8, 9, 2, 4)}
    assert sinks.broken_blocks_of(snapshot, "y").count() == 0
    assert {r["reach_id"] for r in sinks.indices_of(snapshot, "x").collect()} == {7, 17, 27, 37, 47}
    with pytest.raises(ValueError):
        job.main(["--input", path, "--retro-out", "/r", "--indices-out", "/i", "--on-bad-block", "mark"])


def test_cells_of_broken_blocks_stay_off_the_driver(spark, tmp_path):
    """700 hours of 80 reaches, most cells without a flow: no side of a join is sent whole, as small as the files look."""
    hours = spark.range(700).select("id", (F.col("id") % 80).alias("user_id"), F.lit(1.5).alias("value"))
    hours.withColumn("ts", F.timestamp_seconds(F.col("id") * 3600).cast("timestamp_ntz")).write.parquet(str(tmp_path / "events.parquet"))
    found = QUERIES["broken_blocks"](spark, str(tmp_path))
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
    lost = {part: 168 * 10 for part in (3, 5, 7)}
    assert as_set(found) == {(part, 7000 - lost.get(part, 0), 1 if part in lost else None, lost.get(part)) for part in range(8)}


def test_job_with_a_reach_table(spark, tmp_path, wide):
    ids, root, hours = str(tmp_path / "ids"), str(tmp_path / "store"), str(tmp_path / "hours")
    spark.createDataFrame([(7,), (17,), (9000 * 10 + 7,)], "feature_id long").write.parquet(ids)
    args = ["--reach-table", ids, "--store", root, "--run-id"]
    with pytest.raises(KeyError):
        job.main(["--input", wide, *args, "a"])
    job.main(["--input", wide, *args, "a", "--on-missing", "ignore"])
    grid_rows(spark).write.parquet(hours)
    job.main(["--input", hours, "--format", "parquet", *args, "b", "--on-missing", "ignore"])
    snapshot = RunStore(spark, root).snapshot()
    assert (sinks.retrospective_of(snapshot, "a").count(), sinks.retrospective_of(snapshot, "b").count()) == (6, 18)
    with pytest.raises(ValueError):
        job.main(["--input", wide, *args, "a", "--select", "reach_list", "--reaches", "7"])


def test_store_without_a_grid_array(spark, tmp_path):
    path = tmp_path / "g.zarr"
    write_grid(grid_rows(spark), str(path), time_size=4, feature_size=2)
    metadata = json.loads((path / ".zmetadata").read_text())
    kept = {key: value for key, value in metadata["metadata"].items() if key.split("/")[0] in ("time", "feature_id")}
    (path / ".zmetadata").write_text(json.dumps({"metadata": kept}))
    with pytest.raises(Exception, match="no array of the store spans"):
        load(spark, str(path))
