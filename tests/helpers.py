from datetime import date, timedelta

import numpy as np


def days(spark, series: dict[int, list], start=date(2000, 10, 1)):
    """Daily frame from lists of flows; a list element may be None."""
    rows = [
        (reach, start + timedelta(i), None if q is None else float(q))
        for reach, flows in series.items()
        for i, q in enumerate(flows)
    ]
    return spark.createDataFrame(rows, "reach_id long, date date, streamflow double")


def years_of(count: int, start=2000) -> int:
    """Number of days in that many October-September years."""
    return (date(start + count, 10, 1) - date(start, 10, 1)).days


def noise(seed: int, count: int) -> list[float]:
    return (np.random.default_rng(seed).gamma(2.0, 10.0, count)).round(3).tolist()


def by_reach(frame) -> dict:
    return {r["reach_id"]: r for r in frame.collect()}
