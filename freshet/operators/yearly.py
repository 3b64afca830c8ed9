"""Per-water-year quantities and the indices that average them.

``water_year_frame`` declares every per-year quantity once. Each index selects the
few columns it needs and Catalyst prunes the other windows and aggregates.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshet.functions.calendar import day_of_numbered_year
from freshet.functions.numeric import clamp
from freshet.functions.pearson3 import frequency_factor
from freshet.operators import ALL_ROWS, by_reach, reach_order, ROWS_SO_FAR, year_order

# Fixed values.
ZERO_FLOW = 0.001
LOW_FLOW_RATIO = 0.2
HIGH_FLOW_RATIO = 9
WEEK = 7
WEEK_MIN_DAYS = 328
WEEK_MAX_NULL_SHARE = 0.1
TARGET_PROBABILITY = 0.1
FLASHINESS_PERIODS = [(1980, 1989), (1990, 1999), (2000, 2009), (2010, 2022)]


def seven_day_means(trimmed: DataFrame) -> DataFrame:
    """Trailing mean over seven rows, across year ends, null unless all seven have a flow."""
    frame = reach_order().rowsBetween(1 - WEEK, 0)
    flow = F.col("streamflow")
    return trimmed.withColumn("mean_7", F.when(F.count(flow).over(frame) == WEEK, F.avg(flow).over(frame)))


def flow_marks(trimmed: DataFrame, low_ratio: float = LOW_FLOW_RATIO, high_ratio: float = HIGH_FLOW_RATIO) -> DataFrame:
    """Zero-, low- and high-flow flags per day; a missing flow is none of them.

    Low means below a share of the reach's mean, high above a multiple of its median
    (for the median the Weibull position and the ordinary one are the same).
    """
    flow = F.col("streamflow")
    return (
        trimmed.withColumns(
            {
                "_low_limit": F.avg(flow).over(by_reach()) * low_ratio,
                "_high_limit": F.greatest(F.median(flow).over(by_reach()) * high_ratio, F.lit(ZERO_FLOW)),
            }
        )
        .withColumns(
            {
                "is_zero": F.coalesce(flow < ZERO_FLOW, F.lit(False)),
                "is_low": F.coalesce(flow < F.col("_low_limit"), F.lit(False)),
                "is_high": F.coalesce(flow > F.col("_high_limit"), F.lit(False)),
            }
        )
        .drop("_low_limit", "_high_limit")
    )


def starts_run(flag: str) -> Column:
    """True on the first row of each run of set flags within a reach."""
    return F.col(flag) & ~F.coalesce(F.lag(flag).over(reach_order()), F.lit(False))


def event_durations(marked: DataFrame, flag: str) -> DataFrame:
    """Every run of consecutive flagged rows with its first date and its length."""
    return (
        marked.withColumn("_start", starts_run(flag).cast("long"))
        .withColumn("event", F.sum("_start").over(reach_order().rowsBetween(*ROWS_SO_FAR)))
        .where(F.col(flag))
        .groupBy("reach_id", "event")
        .agg(F.min("date").alias("start_date"), F.count(F.lit(1)).alias("duration"))
    )


def water_year_frame(trimmed: DataFrame) -> DataFrame:
    """One row per reach and water year with all quantities the indices average."""
    flow = F.col("streamflow")
    days = flow_marks(seven_day_means(trimmed)).withColumns(
        {
            "_change": F.abs(flow - F.lag(flow).over(year_order())),
            "_so_far": F.sum(flow).over(year_order().rowsBetween(*ROWS_SO_FAR)),
            "_in_year": F.sum(flow).over(year_order().rowsBetween(*ALL_ROWS)),
            "_low_start": starts_run("is_low"),
            "_high_start": starts_run("is_high"),
        }
    )
    count_true = lambda flag: F.sum(F.col(flag).cast("long"))
    past_half = flow.isNotNull() & (F.col("_so_far") >= F.col("_in_year") / 2)
    return days.groupBy("reach_id", "water_year").agg(
        F.count(F.lit(1)).alias("days"),
        F.count(flow).alias("flows"),
        F.sum(flow).alias("total_flow"),
        F.sum("_change").alias("total_change"),
        F.min("mean_7").alias("min_7"),
        F.sum(F.col("mean_7").isNull().cast("long")).alias("null_7"),
        count_true("is_zero").alias("zero_days"),
        count_true("is_low").alias("low_days"),
        count_true("_low_start").alias("low_events"),
        count_true("is_high").alias("high_days"),
        count_true("_high_start").alias("high_events"),
        F.min(F.when(past_half, F.col("date"))).alias("half_flow_date"),
    )


# Per-year expressions on ``water_year_frame``.


def flashiness() -> Column:
    """Sum of day-to-day changes over total flow.

    Null with fewer than two days, with any missing flow, or without positive flow.
    """
    whole = (F.col("days") >= 2) & (F.col("days") == F.col("flows")) & (F.col("total_flow") > 0)
    return F.when(whole, F.col("total_change") / F.col("total_flow"))


def has_usable_week() -> Column:
    """Years with enough rows and few missing seven-day means."""
    return (F.col("days") > WEEK_MIN_DAYS) & (F.col("null_7") / F.col("days") < WEEK_MAX_NULL_SHARE)


def half_flow_day() -> Column:
    return day_of_numbered_year(F.col("half_flow_date"), F.col("water_year"))


# Per-reach aggregates on ``water_year_frame``.


def flashiness_by_period(periods=FLASHINESS_PERIODS) -> Column:
    """Mean flashiness of each period, then the variation of the last one in percent."""
    year, index = F.col("water_year"), flashiness()
    within = [F.when(year.between(first, last), index) for first, last in periods]
    last_mean = F.avg(within[-1])
    cov = F.try_divide(F.stddev_samp(within[-1]) * 100, last_mean)
    return F.array(*[F.avg(w) for w in within], cov)


def usable_minimum() -> Column:
    return F.when(has_usable_week(), F.col("min_7"))


def zero_adjusted_probability(target: float = TARGET_PROBABILITY) -> Column:
    """Target probability among the years that have flow.

    Zero once the share of years with a zero-flow day reaches the target.
    """
    share = F.avg((F.col("zero_days") > 0).cast("double"))
    inner = clamp(F.try_divide(F.lit(target) - share, 1 - share), 1e-6, 1 - 1e-6)
    return F.when((share == 1) | (share >= target), 0.0).otherwise(inner)


def log_minimum() -> Column:
    low = usable_minimum()
    return F.log10(F.when(low > 0, low))


def log_moments() -> list[Column]:
    """Count, mean, sample deviation and bias-corrected skew of the log minima.

    Spark's ``skewness`` is the uncorrected one. The skew of (nearly) equal values
    counts as zero and needs three values.
    """
    x = log_minimum()
    n = F.count(x)
    size = n.cast("double")
    squares = F.pow(F.stddev_pop(x), 2) * size
    corrected = F.skewness(x) * F.sqrt(size * (size - 1)) / F.nullif(size - 2, F.lit(0.0))
    skew = F.when(n >= 3, F.when(squares < 1e-14, 0.0).otherwise(corrected))
    return [
        n.alias("n"),
        F.avg(x).alias("mean_log"),
        F.stddev_samp(x).alias("sd_log"),
        skew.alias("skew_log"),
    ]


def seven_q10(mean: Column, deviation: Column, factor: Column, probability: Column) -> Column:
    """Ten to the log-Pearson III quantile; at probability zero the flow is zero."""
    return F.when(probability == 0, F.when(deviation > 0, 0.0)).otherwise(
        F.pow(F.lit(10.0), mean + deviation * factor)
    )


def mean_event_duration(days: str, events: str) -> Column:
    """Mean run length: flagged days over the number of runs, zero without any."""
    total = F.sum(days)
    return F.when(total == 0, 0.0).otherwise(F.try_divide(total, F.sum(events)))


def half_flow_summary() -> Column:
    """Mean day of the half-flow date and its population variation in percent."""
    day = half_flow_day()
    return F.array(F.avg(day), F.try_divide(F.stddev_pop(day) * 100, F.avg(day)))


def yearly_aggregates(trimmed: DataFrame, target: float = TARGET_PROBABILITY, periods=FLASHINESS_PERIODS) -> DataFrame:
    """What comes from water years, one row per reach; the seven-day quantile by its parameters, see ``with_seven_q10``."""
    return aggregate_years(water_year_frame(trimmed), target, periods)


def aggregate_years(years: DataFrame, target: float = TARGET_PROBABILITY, periods=FLASHINESS_PERIODS) -> DataFrame:
    """As ``yearly_aggregates``, of the quantities of every water year."""
    return years.groupBy("reach_id").agg(
        flashiness_by_period(periods).alias("flashiness_index"),
        F.avg(usable_minimum()).alias("mean_annual_7_day_min"),
        zero_adjusted_probability(target).alias("_p"),
        *log_moments(),
        F.avg("zero_days").alias("zero_flow_days_n"),
        F.avg("low_days").alias("low_flow_days_n"),
        mean_event_duration("low_days", "low_events").alias("duration_low_flow_event"),
        F.avg("high_days").alias("high_flow_days_n"),
        mean_event_duration("high_days", "high_events").alias("duration_high_flow_event"),
        half_flow_summary().alias("half_flow_date"),
    )


def with_seven_q10(reaches: DataFrame) -> DataFrame:
    """``sevenQ10`` in place of its parameters; narrow, one Python value per reach."""
    known = F.col("skew_log").isNotNull()
    quantile = seven_q10(
        F.col("mean_log"), F.col("sd_log"), frequency_factor(F.col("_p"), F.col("skew_log")), F.col("_p")
    )
    return reaches.withColumn("sevenQ10", F.when(known, quantile)).drop(
        "_p", "n", "mean_log", "sd_log", "skew_log"
    )


def yearly_indices(trimmed: DataFrame, target: float = TARGET_PROBABILITY, periods=FLASHINESS_PERIODS) -> DataFrame:
    """All indices that come from water years, one row per reach."""
    return with_seven_q10(yearly_aggregates(trimmed, target, periods))
