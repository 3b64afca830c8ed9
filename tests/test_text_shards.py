import json

import pytest
from pyspark.sql import functions as F

from freshet.sources.text_shards import read_shards, shard_files, write_shards


def names(folder):
    return sorted(p.name for p in folder.iterdir())


def test_names_and_number(spark, tmp_path):
    prefix = str(tmp_path / "out" / "indices")
    lines = spark.range(1000).select(F.concat(F.lit("line "), F.col("id")).alias("any"))
    write_shards(lines, prefix, shards=4, suffix=".txt")
    assert names(tmp_path / "out") == [f"indices-{i:05d}-of-00004.txt" for i in range(4)]
    got = [line for name in names(tmp_path / "out") for line in (tmp_path / "out" / name).read_text().split("\n")[:-1]]
    assert sorted(got) == sorted(f"line {i}" for i in range(1000))
    assert all((tmp_path / "out" / name).stat().st_size for name in names(tmp_path / "out"))


def test_empty_shards_are_there(spark, tmp_path):
    prefix = f"file://{tmp_path}/few"
    write_shards(spark.createDataFrame([("one é",), (None,)], "v string"), prefix, shards=6, header="v")
    assert names(tmp_path) == [f"few-{i:05d}-of-00006" for i in range(6)]
    texts = [(tmp_path / n).read_text() for n in names(tmp_path)]
    assert sorted(texts) == ["v\n"] * 4 + ["v\n\n", "v\none é\n"]
    assert sorted(r["value"] for r in read_shards(spark, prefix).collect()) == ["", *["one é"], *["v"] * 6]
    write_shards(spark.createDataFrame([], "v string"), str(tmp_path / "none"), shards=2)
    assert len(shard_files(str(tmp_path / "none"))) == 2


def test_records_one_file_a_partition(spark, tmp_path):
    prefix = str(tmp_path / "records")
    records = spark.range(9).repartition(3).select("id", F.array(F.lit(1.5), F.lit(None)).alias("values"), F.lit("a\nb").alias("text"))
    write_shards(records, prefix, suffix=".json")
    assert len(names(tmp_path)) == 3
    rows = [json.loads(line) for n in names(tmp_path) for line in (tmp_path / n).read_text().splitlines()]
    assert sorted(r["id"] for r in rows) == list(range(9)) and rows[0]["text"] == "a\nb" and rows[0]["values"] == [1.5, None]
    assert sorted(map(tuple, read_shards(spark, prefix, ".json", records.schema).select("id", "text").collect())) == [(i, "a\nb") for i in range(9)]


def test_append_and_overwrite(spark, tmp_path):
    prefix = str(tmp_path / "x")
    lines = spark.range(20).select(F.col("id").cast("string").alias("v"))
    write_shards(lines, prefix, 5)
    with pytest.raises(Exception, match="already"):
        write_shards(lines, prefix, 3)
    write_shards(lines, prefix, 2, suffix=".txt")  # another set
    write_shards(lines.limit(4), prefix, 3, mode="overwrite")
    assert names(tmp_path) == sorted([f"x-{i:05d}-of-00002.txt" for i in range(2)] + [f"x-{i:05d}-of-00003" for i in range(3)])
    assert read_shards(spark, prefix).count() == 4 and read_shards(spark, prefix, ".txt").count() == 20
    with pytest.raises(ValueError):
        write_shards(lines, prefix, 3, mode="ignore")
    with pytest.raises(ValueError):
        write_shards(lines, prefix, 0)


def test_failed_attempts_leave_nothing(spark, tmp_path):
    """A task that dies after some lines: no file of the write is left, nor its folder."""
    lines = spark.range(5000).repartition(4).select(F.col("id").cast("string").alias("v"))
    bad = lines.withColumn("v", F.when(F.col("v") == "4321", F.raise_error(F.lit("dies")).cast("string")).otherwise(F.col("v")))
    with pytest.raises(Exception, match="dies"):
        write_shards(bad, str(tmp_path / "x"))
    assert names(tmp_path) == []
    with pytest.raises(FileNotFoundError):
        shard_files(str(tmp_path / "x"))


def test_files_of_a_repeated_attempt_are_dropped(spark, tmp_path, monkeypatch):
    """Two attempts at a task both wrote: the one that reported counts."""
    from freshet.sources import text_shards

    monkeypatch.setattr(text_shards.TaskContext, "get", classmethod(lambda cls: type("Task", (), {"partitionId": lambda self: 0})()))
    import pyarrow as pa

    writer = text_shards.ShardWriter({"path": str(tmp_path / "x"), "suffix": ".txt"}, False)
    batch = lambda text: iter([pa.RecordBatch.from_arrays([pa.array([text])], names=["v"])])
    writer.write(batch("lost"))
    writer.commit([writer.write(batch("kept"))])
    assert names(tmp_path) == ["x-00000-of-00001.txt"] and (tmp_path / "x-00000-of-00001.txt").read_text() == "kept\n"


def test_incomplete_sets(spark, tmp_path):
    prefix = str(tmp_path / "x")
    write_shards(spark.range(6).select(F.col("id").cast("string")), prefix, 3)
    (tmp_path / "x-00001-of-00003").unlink()
    with pytest.raises(FileNotFoundError, match="2 shards"):
        read_shards(spark, prefix)
