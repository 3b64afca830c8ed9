"""Table schemas and the fixed values that come with the source data."""

from pyspark.sql import types as T

# The six model variables and the fill number each one uses.
FILL_VALUES = {
    "streamflow": -999900,
    "velocity": -999900,
    "qBtmVertRunoff": -9999000,
    "qBucket": -999900000,
    "qSfcLatRunoff": -999900000,
    "q_lateral": -99990,
}

FLOW_VARIABLES = list(FILL_VALUES)

RETRO_SCHEMA = T.StructType(
    [T.StructField("feature_id", T.LongType()), T.StructField("time", T.TimestampNTZType())]
    + [T.StructField(name, T.FloatType()) for name in FLOW_VARIABLES]
)

# Names of the index record, in output order.
INDICES_SCHEMA = T.StructType(
    [
        T.StructField("reach_id", T.LongType(), nullable=False),
        T.StructField("monthwise_mean", T.ArrayType(T.DoubleType())),
        T.StructField("monthwise_cov", T.ArrayType(T.DoubleType())),
        T.StructField("nth_percentile_flows", T.ArrayType(T.DoubleType())),
        T.StructField("variability_index", T.DoubleType()),
        T.StructField("slope_fdc", T.DoubleType()),
        T.StructField("flashiness_index", T.ArrayType(T.DoubleType())),
        T.StructField("sevenQ10", T.DoubleType()),
        T.StructField("mean_annual_7_day_min", T.DoubleType()),
        T.StructField("baseflow_index", T.DoubleType()),
        T.StructField("zero_flow_days_n", T.DoubleType()),
        T.StructField("low_flow_days_n", T.DoubleType()),
        T.StructField("duration_low_flow_event", T.DoubleType()),
        T.StructField("high_flow_days_n", T.DoubleType()),
        T.StructField("duration_high_flow_event", T.DoubleType()),
        T.StructField("half_flow_date", T.ArrayType(T.DoubleType())),
        T.StructField("start_date_flood_season", T.IntegerType()),
    ]
)

DAILY_SCHEMA = T.StructType(
    [
        T.StructField("reach_id", T.LongType()),
        T.StructField("date", T.DateType()),
        T.StructField("streamflow", T.DoubleType()),
    ]
)

# Length of each array in the record of a reach that failed.
FAILED_ARRAY_LENGTHS = {
    "monthwise_mean": 12,
    "monthwise_cov": 12,
    "nth_percentile_flows": 13,
    "flashiness_index": 5,
    "half_flow_date": 2,
}
