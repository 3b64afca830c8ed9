"""Baseflow index with the Eckhardt filter and calibrated parameters.

What compares neighbouring days (baseflow-only days, recession constant, recession
spells) is windows and aggregates. The two filters feed each result into the next
day, which no window can express; they run on one reach at a time in Python.

Sources: Lyne and Hollick (1979), Eckhardt (2005), Brutsaert (2008), Xie et al. (2020).
"""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from freshet.operators import ALL_ROWS, by_reach, ROWS_SO_FAR, series_order

# Fixed values.
FILTER_CONSTANT = 0.925
MAJOR_EVENT_QUANTILE = 0.9
RECESSION_SHARE = 0.05
SPELL_MIN_DAYS = 10
SPELL_SKIPPED_SHARE = 0.6
CANDIDATES = 999



def with_flow(daily: DataFrame) -> DataFrame:
    return daily.where(F.col("streamflow").isNotNull())


def strict_baseflow(daily: DataFrame) -> DataFrame:
    """Flag the days whose flow is baseflow only, and give the slope of the flow.

    Left out are days that do not fall, two days before and three after them, five
    days after the peak of a major event, and days followed by a steeper fall.
    """
    order = series_order(daily)
    flow = F.col("streamflow")
    before, after = F.lag(flow).over(order), F.lead(flow).over(order)
    level = F.expr(f"percentile(streamflow, {MAJOR_EVENT_QUANTILE})").over(by_reach())
    rises = F.coalesce(flow >= before, F.lit(True))
    rises_next = F.coalesce(after >= flow, F.lit(True))
    any_within = lambda flag, first, last: F.coalesce(
        F.max(flag).over(order.rowsBetween(first, last)), F.lit(False)
    )
    return (
        with_flow(daily)
        .withColumn("slope", (after - before) / 2)
        .withColumn("_wet", F.coalesce(F.col("slope") >= 0, F.lit(True)))
        .withColumn("_peak", (flow >= level) & rises & ~rises_next)
        .withColumn("_steeper", F.coalesce(F.lead("slope").over(order) < F.col("slope"), F.lit(True)))
        .withColumn(
            "strict",
            ~(any_within(F.col("_wet"), -3, 2) | any_within(F.col("_peak"), -5, -1) | F.col("_steeper")),
        )
        .drop("_wet", "_peak", "_steeper")
    )


def _recession_rates() -> Column:
    """Ascending relative rates of fall on baseflow-only days, as an aggregate."""
    return F.sort_array(F.collect_list(F.when(F.col("strict"), F.try_divide(-F.col("slope"), F.col("streamflow")))))


def _recession(rates: str) -> Column:
    """Daily recession constant: at the slowest twentieth of the rates, null without any."""
    return F.exp(-F.get(F.col(rates), F.floor(F.size(rates) * RECESSION_SHARE).cast("int")))


def recession_constant(flagged: DataFrame) -> DataFrame:
    """Daily recession constant per reach from its baseflow-only days."""
    rates = flagged.groupBy("reach_id").agg(_recession_rates().alias("_rates"))
    return rates.select("reach_id", _recession("_rates").alias("recession"))


def recession_spells(daily: DataFrame) -> DataFrame:
    """Flag the late part of every long spell of falling three-day means.

    A spell needs ten days; its first 60 percent are left out.
    """
    order = series_order(daily)
    falls = F.coalesce(F.lag("streamflow").over(order) > F.lead("streamflow", 2).over(order), F.lit(False))
    changes = F.coalesce(F.col("_falls") != F.lag("_falls").over(order), F.lit(True)).cast("int")
    spell = Window.partitionBy("reach_id", "_spell").orderBy("date")
    length = F.count(F.lit(1)).over(spell.rowsBetween(*ALL_ROWS))
    return (
        daily.withColumn("_falls", falls)
        .withColumn("_change", changes)
        .withColumn("_spell", F.sum("_change").over(order.rowsBetween(*ROWS_SO_FAR)))
        .withColumn("_length", length)
        .withColumn("_at", F.row_number().over(spell))
        .withColumn(
            "recedes",
            F.col("_falls")
            & (F.col("_length") >= SPELL_MIN_DAYS)
            & (F.col("_at") > F.ceil(F.col("_length") * SPELL_SKIPPED_SHARE)),
        )
        .drop("_falls", "_change", "_spell", "_length", "_at")
    )


def lyne_hollick_filter(flow: np.ndarray, constant: float = FILTER_CONSTANT) -> np.ndarray:
    """Forward, then backward pass; neither may exceed its input."""

    def one_pass(values: list[float]) -> list[float]:
        base = [values[0]]
        half = (1 - constant) / 2
        for earlier, current in zip(values, values[1:]):
            base.append(min(current, constant * base[-1] + half * (earlier + current)))
        return base

    forward = one_pass(flow.tolist())
    return np.array(one_pass(forward[::-1])[::-1])


def eckhardt_filter(flow: np.ndarray, first: float, recession: float, maximum: np.ndarray | float) -> np.ndarray:
    """Baseflow per day for one maximum index, or one column per candidate."""
    maximum = np.asarray(maximum, float)
    carry = (1 - maximum) * recession / (1 - recession * maximum)
    share = (1 - recession) * maximum / (1 - recession * maximum)
    base = np.empty((len(flow), *maximum.shape))
    base[0] = first
    for day in range(1, len(flow)):
        base[day] = np.minimum(flow[day], carry * base[day - 1] + share * flow[day])
    return base


def _calibrated_maximum(flow: np.ndarray, recedes: np.ndarray, first: float, recession: float) -> float:
    """The candidate that fits recession days well relative to all other days.

    Each candidate is judged by the model efficiency on both kinds of days and by the
    share of days on which the filter had to be held back. All candidates advance
    together, one vector per day, and only their running sums are kept.
    """
    grid = np.arange(1, CANDIDATES + 1) / (CANDIDATES + 1)
    carry = (1 - grid) * recession / (1 - recession * grid)
    share = (1 - recession) * grid / (1 - recession * grid)
    base = np.full(CANDIDATES, first)
    held_back = np.zeros(CANDIDATES)
    miss = {True: np.zeros(CANDIDATES), False: np.zeros(CANDIDATES)}
    miss[bool(recedes[0])] += (flow[0] - base) ** 2
    gap = np.empty(CANDIDATES)
    for today, receding in zip(flow[1:].tolist(), recedes[1:].tolist()):
        base *= carry
        base += np.multiply(share, today, out=gap)
        held_back += base > today
        np.minimum(base, today, out=base)
        np.subtract(today, base, out=gap)
        gap *= gap
        miss[receding] += gap

    def efficiency(receding: bool) -> np.ndarray:
        days = flow[recedes == receding]
        spread = ((days - days.mean()) ** 2).sum() if days.size else 0.0
        return 1 - miss[receding] / (spread + 1e-10) - 1e-10

    fit = 1 - (1 - efficiency(True)) / (1 - efficiency(False))
    return float(grid[np.argmin(1 - fit * (1 - held_back / len(flow)))])


def baseflow_share(flow: np.ndarray, recedes: np.ndarray, recession: float) -> float | None:
    """Baseflow over total flow of one reach's days in order; none without a recession constant or flow."""
    if not np.isfinite(recession) or not flow.sum() > 0:
        return None
    first = lyne_hollick_filter(flow)[0]
    maximum = _calibrated_maximum(flow, recedes, first, recession)
    return eckhardt_filter(flow, first, recession, maximum).sum() / flow.sum()


@F.arrow_udf(DoubleType())
def _shares(series: pa.Array, recessions: pa.Array) -> pa.Array:
    """The share of each reach, from its list of days and its recession constant."""
    days, bounds = series.flatten(), np.cumsum([0, *series.value_lengths().fill_null(0).to_pylist()])
    date = days.field("date").cast(pa.int32()).to_numpy()
    flow, recedes = days.field("streamflow").to_numpy(), days.field("recedes").to_numpy(zero_copy_only=False)
    out = []
    for start, stop, recession in zip(bounds, bounds[1:], recessions.to_pylist()):
        order = start + np.argsort(date[start:stop])
        out.append(baseflow_share(flow[order], recedes[order], np.nan if recession is None else recession))
    return pa.array(out, pa.float64())


def baseflow_inputs(daily: DataFrame) -> DataFrame:
    """Per reach: its days with flow and recession flag as one list, and its recession constant."""
    return (
        recession_spells(strict_baseflow(daily))
        .groupBy("reach_id")
        .agg(
            _recession_rates().alias("_rates"),
            F.collect_list(F.struct("date", "streamflow", "recedes")).alias("days"),
        )
        .select("reach_id", "days", _recession("_rates").alias("recession"))
    )


def with_baseflow_index(inputs: DataFrame) -> DataFrame:
    """``baseflow_index`` in place of ``days`` and ``recession``; null where the constant cannot be found.

    Arrow batches are bounded in bytes, by ``spark.sql.execution.arrow.maxBytesPerBatch``.
    """
    return inputs.withColumn("baseflow_index", _shares("days", "recession")).drop("days", "recession")


def baseflow_index(daily: DataFrame) -> DataFrame:
    """Baseflow over total flow per reach; null where the constant cannot be found."""
    return with_baseflow_index(baseflow_inputs(daily))


def _filtered(daily: DataFrame, kernel) -> DataFrame:
    kind = daily.schema["reach_id"].dataType.simpleString()

    def run(days: pd.DataFrame) -> pd.DataFrame:
        days = days.sort_values("date")
        base = kernel(days["streamflow"].to_numpy(float))
        return pd.DataFrame({"reach_id": days["reach_id"], "date": days["date"], "baseflow": base})

    series = with_flow(daily).select("reach_id", "date", "streamflow")
    return series.groupBy("reach_id").applyInPandas(run, f"reach_id {kind}, date date, baseflow double")


def lyne_hollick(daily: DataFrame, constant: float = FILTER_CONSTANT) -> DataFrame:
    """Lyne-Hollick baseflow per day."""
    return _filtered(daily, lambda flow: lyne_hollick_filter(flow, constant))


def eckhardt(daily: DataFrame, recession: float, maximum: float) -> DataFrame:
    """Eckhardt baseflow per day with fixed parameters, started from the Lyne-Hollick value."""
    return _filtered(
        daily, lambda flow: eckhardt_filter(flow, lyne_hollick_filter(flow)[0], recession, maximum)
    )
