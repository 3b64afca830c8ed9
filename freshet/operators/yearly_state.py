"""What one water year of a reach adds to its indices, so that later years can be appended.

A state row is made from one year's days alone and never changes. The record of a reach is merged
from the states of its years: the end years are judged anew, seven-day means and flow events
reach over year ends by the few rows that each state keeps of its own, limits that follow
from the whole record are counted in the years' sorted flows, and the sorted flows of all
years merge into one. Appending a year so reads the states, not the days or hours behind them.

The flood season and the baseflow run through the whole series, and take it from the states.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freshet.functions.calendar import days_in_year
from freshet.operators import ALL_ROWS, by_reach, ROWS_SO_FAR, year_order
from freshet.operators.duration_curve import curve_of
from freshet.operators.water_years import tag_water_years
from freshet.operators.yearly import HIGH_FLOW_RATIO, LOW_FLOW_RATIO, WEEK, ZERO_FLOW, aggregate_years

#: Rows of the year before that a seven-day mean may reach back to.
REACH_BACK = WEEK - 1


def year_states(daily: DataFrame, starting_month: int = 10) -> DataFrame:
    """One row per reach and water year of ``daily(reach_id, date, streamflow)``; rows without a reach id have no place.

    ``daily`` must hold whole years of rows, or those of a year that will not be added to. One
    shuffle by reach and year; a row has as many values as the year has days.
    """
    flow = F.col("streamflow")
    week = year_order().rowsBetween(1 - WEEK, 0)
    days = tag_water_years(daily.where(F.col("reach_id").isNotNull()), starting_month).withColumns(
        {
            "_before": F.lag(flow).over(year_order()),
            "_at": F.row_number().over(year_order()),
            "_mean_7": F.when(F.count(flow).over(week) == WEEK, F.avg(flow).over(week)),
            "_so_far": F.sum(flow).over(year_order().rowsBetween(*ROWS_SO_FAR)),
            "_in_year": F.sum(flow).over(year_order().rowsBetween(*ALL_ROWS)),
        }
    )
    inner = F.col("_at") >= WEEK
    both = flow.isNotNull() & F.col("_before").isNotNull()
    past_half = flow.isNotNull() & (F.col("_so_far") >= F.col("_in_year") / 2)
    sorted_of = lambda value: F.sort_array(F.collect_list(value))  # nulls stay out
    states = days.groupBy("reach_id", "water_year").agg(
        F.count(F.lit(1)).alias("days"),
        F.count(flow).alias("flows"),
        F.sum(flow).alias("total_flow"),
        F.sum(F.abs(flow - F.col("_before"))).alias("total_change"),
        F.min(F.when(inner, F.col("_mean_7"))).alias("inner_min_7"),
        F.sum((inner & F.col("_mean_7").isNull()).cast("long")).alias("inner_null_7"),
        F.sum(F.coalesce(flow < ZERO_FLOW, F.lit(False)).cast("long")).alias("zero_days"),
        F.min(F.when(past_half, F.col("date"))).alias("half_flow_date"),
        F.sort_array(F.collect_list(F.struct("date", "streamflow"))).alias("series"),
        sorted_of(flow).alias("sorted"),
        # A run of low days has a first day: low days less pairs of low neighbours.
        sorted_of(F.when(both, F.greatest(flow, F.col("_before")))).alias("pair_high"),
        sorted_of(F.when(both, F.least(flow, F.col("_before")))).alias("pair_low"),
    )
    return states


def kept_states(states: DataFrame) -> DataFrame:
    """States less those of a short first and last year, as ``trim_water_years`` has it."""
    year = F.col("water_year")
    ends = states.withColumns({"_first": F.min(year).over(by_reach()), "_last": F.max(year).over(by_reach())})
    short = year.isin(F.col("_first"), F.col("_last")) & (F.col("days") < days_in_year(year))
    return ends.withColumn("kept", ~short).drop("_first", "_last")


def days_of(states: DataFrame) -> DataFrame:
    """The days behind the states, in place: ``reach_id, water_year, date, streamflow``."""
    return states.select("reach_id", "water_year", F.inline("series"))


def _edge_means(context: Column, flows: Column) -> Column:
    """Seven-day means of a year's first rows, from the rows before them; null where a row or a flow is missing."""
    both = F.concat(context, F.slice(flows, 1, REACH_BACK))

    def mean(at: Column) -> Column:
        window = F.slice(both, F.greatest(at - REACH_BACK, F.lit(1)), WEEK)
        whole = (at >= WEEK) & (F.size(F.filter(window, lambda x: x.isNotNull())) == WEEK)
        return F.when(whole, F.aggregate(window, F.lit(0.0), lambda total, x: total + x) / WEEK)

    first = F.size(context) + 1
    last = F.size(both)
    return F.when(last >= first, F.transform(F.sequence(first, last), mean)).otherwise(F.array().cast("array<double>"))


def merged_years(kept: DataFrame) -> DataFrame:
    """One row per reach and water year with the quantities of ``water_year_frame``, of the kept states of a reach."""
    order = Window.partitionBy("reach_id").orderBy("water_year")
    flows = F.col("series.streamflow")
    tail = F.slice(flows, F.greatest(F.size(flows) - REACH_BACK + 1, F.lit(1)), REACH_BACK)
    # Years of few rows: the rows before may stand in several of them.
    before = F.concat(*[F.coalesce(F.lag("_tail", k).over(order), F.array().cast("array<double>")) for k in range(REACH_BACK, 0, -1)])
    whole = Window.partitionBy("reach_id")
    every = F.sort_array(F.flatten(F.collect_list("sorted").over(whole)))
    middle = lambda values: F.when(F.size(values) > 0, (F.get(values, F.floor((F.size(values) - 1) / 2).cast("int")) + F.get(values, F.floor(F.size(values) / 2).cast("int"))) / 2)
    years = (
        kept.withColumn("_tail", tail)
        .withColumn("_before", before)
        .withColumn("_context", F.slice("_before", F.greatest(F.size("_before") - REACH_BACK + 1, F.lit(1)), REACH_BACK))
        .withColumns({"_edge": _edge_means(F.col("_context"), flows), "_last": F.element_at(F.when(F.size("_before") > 0, F.col("_before")), -1)})
        .withColumns(
            {
                "_low": F.sum("total_flow").over(whole) / F.sum("flows").over(whole) * LOW_FLOW_RATIO,
                "_high": F.greatest(middle(every) * HIGH_FLOW_RATIO, F.lit(ZERO_FLOW)),
            }
        )
    )
    low, high, first, last = F.col("_low"), F.col("_high"), F.get(flows, F.lit(0)), F.col("_last")
    count = lambda name, test: F.size(F.filter(name, test)).cast("long")
    under, over = lambda x: F.coalesce(x < low, F.lit(False)), lambda x: F.coalesce(x > high, F.lit(False))
    across = lambda test: (test(first) & test(last)).cast("long")  # a run that goes on from the year before
    known = F.filter("_edge", lambda x: x.isNotNull())
    return years.select(
        "reach_id", "water_year", "days", "flows", "total_flow", "total_change", "zero_days", "half_flow_date",
        F.least("inner_min_7", F.array_min(known)).alias("min_7"),
        (F.col("inner_null_7") + F.size("_edge") - F.size(known)).alias("null_7"),
        count("sorted", under).alias("low_days"),
        (count("sorted", under) - count("pair_high", under) - across(under)).alias("low_events"),
        count("sorted", over).alias("high_days"),
        (count("sorted", over) - count("pair_low", over) - across(over)).alias("high_events"),
    )


def merged_yearly(kept: DataFrame) -> DataFrame:
    """As ``yearly_aggregates``, of kept states."""
    return aggregate_years(merged_years(kept))


def merged_curve(kept: DataFrame) -> DataFrame:
    """The duration curve's columns per reach: the years' sorted flows as one."""
    merged = kept.groupBy("reach_id").agg(F.sort_array(F.flatten(F.collect_list("sorted"))).alias("_flows"))
    return curve_of(merged)


def merged_status(states: DataFrame) -> DataFrame:
    """As ``reach_status``, of all states of a reach with the mark ``kept``."""
    fewest = F.min(F.when(F.col("kept"), F.col("flows")))
    return states.groupBy("reach_id").agg(F.coalesce(fewest > 0, F.lit(False)).alias("computed"))
