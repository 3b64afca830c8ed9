"""Records merged from the states of single years against records of the whole series."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from freshet.operators.water_years import tag_water_years, trim_water_years
from freshet.operators.yearly import water_year_frame
from freshet.operators.yearly_state import kept_states, merged_years, year_states
from freshet.plans.indices import indices_of_states, indices_table
from tests.helpers import by_reach, days, noise, years_of


def awkward(spark):
    """Gaps, missing flows, years of few rows, flat low and high spells across year ends, reaches that fail."""
    rng = random.Random(8)
    rows = []

    def add(reach, flows, start=date(1999, 10, 1), keep=lambda d: True):
        for i, q in enumerate(flows):
            d = start + timedelta(i)
            if keep(d):
                rows.append((reach, d, None if q is None else float(q)))

    add(1, noise(1, years_of(4, 1999)))
    add(2, [q if rng.random() > 0.05 else None for q in noise(2, years_of(4, 1999))])
    add(3, noise(3, years_of(5, 1999)), keep=lambda d: not (d.year == 2001 and 3 < d.month < 12 and d.day > 2))
    # A year of three rows between whole ones, so that a week reaches back over it.
    add(4, noise(4, years_of(5, 1999)), keep=lambda d: not (date(2001, 10, 4) <= d < date(2002, 10, 1)))
    # Low from late September into October, high over another year end.
    flows = [5.0 + rng.random() for _ in range(years_of(4, 1999))]
    flows[360:375] = [0.1] * 15
    flows[725:740] = [500.0] * 15
    flows[1090:1096] = [0.0] * 6
    add(5, flows)
    add(6, noise(6, 500), start=date(2000, 3, 1))
    add(7, [None] * years_of(2, 1999))
    add(8, noise(8, 100))
    add(9, [None if 350 < i < 380 else q for i, q in enumerate(noise(9, years_of(3, 1999)))])
    rows += [(None, date(2000, 1, 1) + timedelta(i), 1.0) for i in range(50)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "reach_id long, date date, streamflow double")


@pytest.fixture(scope="module")
def frame(spark):
    return awkward(spark).persist()


def test_merged_years_equal_those_of_the_whole_series(spark, frame):
    columns = ["days", "flows", "total_flow", "total_change", "min_7", "null_7", "zero_days", "low_days", "low_events", "high_days", "high_events", "half_flow_date"]
    whole = water_year_frame(trim_water_years(frame.where("reach_id is not null")))
    want = {(r["reach_id"], r["water_year"]): r for r in whole.collect()}
    got = {(r["reach_id"], r["water_year"]): r for r in merged_years(kept_states(year_states(frame)).where("kept")).collect()}
    assert got.keys() == want.keys() and len(want) > 25
    for key, row in want.items():
        for name in columns:
            value = row[name]
            assert got[key][name] == (pytest.approx(value, rel=1e-12) if isinstance(value, float) else value), (key, name)
    assert sum(r["low_events"] for r in want.values()) > 10 and sum(r["high_events"] for r in want.values()) >= 1


@pytest.mark.parametrize("first", [2000, 2001, 2003])
def test_appended_years_give_the_whole_record(spark, frame, tmp_path, first):
    path = str(tmp_path / "states")
    tagged = tag_water_years(frame)
    for years in (F.col("water_year") <= first, *[F.col("water_year") == y for y in range(first + 1, 2005)]):
        year_states(tagged.where(years).drop("water_year").repartition(2)).write.mode("append").parquet(path)
    got, want = by_reach(indices_of_states(spark.read.parquet(path))), by_reach(indices_table(frame))
    assert got.keys() == want.keys() == set(range(1, 10))
    for reach, record in want.items():
        for field, value in record.asDict().items():
            near = None if value is None else pytest.approx(value, rel=1e-9, abs=1e-9)
            assert got[reach][field] == near, (reach, field)


def test_states_of_nothing(spark, frame):
    none = year_states(frame.where("false"))
    assert indices_of_states(none).count() == 0


def test_merge_shuffles_states_once(spark, frame, tmp_path):
    path = str(tmp_path / "states")
    year_states(frame).write.parquet(path)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        record = indices_of_states(spark.read.parquet(path))
        record.collect()
        plan = record._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "ReusedExchange" not in line]
    # The states, and the small result of a Python kernel.
    assert len([line for line in shuffles if "REPARTITION_BY_COL" not in line]) == 1 and "SinglePartition" not in plan


def test_few_rows_a_year(spark):
    """Years of one to eight rows: weeks that begin several years back."""
    rng = random.Random(3)
    rows = [(r, date(1990 + y, 11, 1) + timedelta(i), float(rng.randrange(1, 40))) for r in range(12) for y in range(9) for i in range(rng.randrange(1, 9))]
    daily = spark.createDataFrame(rows, "reach_id long, date date, streamflow double")
    whole = {(r["reach_id"], r["water_year"]): (r["min_7"], r["null_7"], r["low_events"], r["high_events"]) for r in water_year_frame(trim_water_years(daily)).collect()}
    merged = {(r["reach_id"], r["water_year"]): (r["min_7"], r["null_7"], r["low_events"], r["high_events"]) for r in merged_years(kept_states(year_states(daily)).where("kept")).collect()}
    assert merged.keys() == whole.keys() and any(v[0] is not None for v in whole.values())
    for key, value in whole.items():
        assert merged[key] == (value[0] if value[0] is None else pytest.approx(value[0]), *value[1:]), key
