"""Flow-duration curve: percentiles and what follows from them."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshet.functions.numeric import floor_or_null, weibull_quantile
from freshet.operators.monthly import month_cov, month_mean

# Percentile levels, and the ones that make up the output vector.
LEVELS = [2, 5, 10, 15, 20, 25, 30, 33, 35, 40, 45, 50, 55, 60, 65, 66, 70, 75, 80, 85, 90, 95, 99]
VECTOR_LEVELS = [2, 5, 10, 20, 25, 30, 50, 75, 90, 95, 99]
VARIABILITY_LEVELS = list(range(5, 100, 5))
SLOPE_LEVELS = (33, 66)
LOWEST_FLOW = 0.001


def flow_percentiles(daily: DataFrame, levels: list[int] = LEVELS) -> DataFrame:
    """Weibull percentiles, minimum and maximum per reach, nulls skipped.

    Spark's own ``percentile`` uses another plotting position, so each reach's flows
    are sorted as one array, as long as its record has days, and only the picks stay.
    """
    return _picked(
        daily.groupBy("reach_id").agg(F.sort_array(F.collect_list("streamflow")).alias("_flows")), levels
    )


def _picked(flows: DataFrame, levels: list[int] = LEVELS) -> DataFrame:
    ordered = F.col("_flows")
    return flows.select(
        *[c for c in flows.columns if c != "_flows"],
        F.transform(F.lit([level / 100 for level in levels]), lambda p: weibull_quantile(ordered, p)).alias("percentiles"),
        F.get(ordered, F.lit(0)).alias("min_flow"),
        F.get(ordered, F.size(ordered) - 1).alias("max_flow"),
    )


def _at(levels: list[int]) -> str:
    """SQL list of the percentiles at some of the levels."""
    return ", ".join(f"percentiles[{LEVELS.index(level)}]" for level in levels)


def duration_vector() -> Column:
    """Minimum, eleven percentiles, maximum."""
    return F.expr(f"array(min_flow, {_at(VECTOR_LEVELS)}, max_flow)")


def variability_index() -> Column:
    """Sample standard deviation of the log10 of 19 percentiles, low ones lifted."""
    logs = F.transform(F.expr(f"array({_at(VARIABILITY_LEVELS)})"), lambda q: F.log10(F.greatest(q, F.lit(LOWEST_FLOW))))
    count = len(VARIABILITY_LEVELS)
    mean = F.aggregate(logs, F.lit(0.0), lambda total, x: total + x) / count
    spread = F.aggregate(logs, F.lit(0.0), lambda total, x: total + (x - mean) * (x - mean))
    return F.sqrt(spread / (count - 1))


def duration_slope() -> Column:
    """Slope of the log flow-duration curve between the two slope levels."""
    low, high = SLOPE_LEVELS
    at = lambda level: F.ln(floor_or_null(F.expr(_at([level])), LOWEST_FLOW))
    return (at(high) - at(low)) / (high - low)


def curve_of(flows: DataFrame) -> DataFrame:
    """Vector, variability index and slope per reach, from the ascending array ``_flows``."""
    return _curve(_picked(flows))


def _curve(percentiles: DataFrame) -> DataFrame:
    return percentiles.select(
        "reach_id",
        duration_vector().alias("nth_percentile_flows"),
        variability_index().alias("variability_index"),
        duration_slope().alias("slope_fdc"),
    )


def duration_curve(daily: DataFrame) -> DataFrame:
    """Vector, variability index and slope per reach."""
    return _curve(flow_percentiles(daily))


def months_and_curve(daily: DataFrame) -> DataFrame:
    """Month statistics and duration curve together, from one pass over the days.

    Groups per reach and month first; the month's flows ride along as a short list and
    are joined to the reach's list afterwards.
    """
    flow = F.col("streamflow")
    months = daily.groupBy("reach_id", F.month("date").alias("month")).agg(
        month_mean(flow).alias("monthwise_mean"),
        month_cov(flow).alias("monthwise_cov"),
        F.collect_list(flow).alias("flows"),
    )
    stats = F.struct("month", "monthwise_mean", "monthwise_cov")
    reaches = months.groupBy("reach_id").agg(
        F.sort_array(F.collect_list(stats)).alias("m"),
        F.sort_array(F.flatten(F.collect_list("flows"))).alias("_flows"),
    )
    return _picked(reaches).select(
        "reach_id",
        "m.monthwise_mean",
        "m.monthwise_cov",
        duration_vector().alias("nth_percentile_flows"),
        variability_index().alias("variability_index"),
        duration_slope().alias("slope_fdc"),
    )
