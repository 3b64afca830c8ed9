"""Mean and coefficient of variation per calendar month."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshet.functions.numeric import round_half_even


def month_mean(flow: Column) -> Column:
    return round_half_even(F.avg(flow), 2)


def month_cov(flow: Column) -> Column:
    """Sample standard deviation over the unrounded mean, in percent."""
    return round_half_even(F.try_divide(F.stddev_samp(flow), F.avg(flow)) * 100, 2)


def monthwise_stats(daily: DataFrame) -> DataFrame:
    """One row per reach and calendar month present in the data."""
    flow = F.col("streamflow")
    return daily.groupBy("reach_id", F.month("date").alias("month")).agg(
        month_mean(flow).alias("monthwise_mean"), month_cov(flow).alias("monthwise_cov")
    )


def monthwise_arrays(stats: DataFrame) -> DataFrame:
    """One row per reach; arrays hold the months present, in month order."""
    ordered = F.sort_array(F.collect_list(F.struct("month", "monthwise_mean", "monthwise_cov")))
    return stats.groupBy("reach_id").agg(ordered.alias("m")).select(
        "reach_id", "m.monthwise_mean", "m.monthwise_cov"
    )
