"""Missing values: NaN, fill numbers, and the output form of both."""

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: stands for a missing element inside an output array.
MISSING_ELEMENT = -99.0


def null_if_nan(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def null_if_fill(value: Column, fill: float) -> Column:
    """Null where the value equals its fill number or is NaN.

    The comparison runs in double precision: large fill numbers change when they are
    first narrowed to float.
    """
    wide = value.cast("double")
    return F.when((wide != F.lit(float(fill))) & ~F.isnan(wide), value)


def _iso_text(value: Column) -> Column:
    seconds = F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss")
    fraction = F.date_format(value, "SSSSSS")
    return F.when(fraction == "000000", seconds).otherwise(F.concat(seconds, F.lit("."), fraction))


def _duration_text(value: Column) -> Column:
    """``D days HH:MM:SS[.ffffff]``; below zero the days are floored and a plus follows."""
    micros = (
        F.extract(F.lit("DAY"), value).cast("long") * 86_400_000_000
        + F.extract(F.lit("HOUR"), value).cast("long") * 3_600_000_000
        + F.extract(F.lit("MINUTE"), value).cast("long") * 60_000_000
        + (F.extract(F.lit("SECOND"), value) * 1_000_000).cast("long")
    )
    within = F.pmod(micros, F.lit(86_400_000_000))
    days = ((micros - within) / 86_400_000_000).cast("long")
    pad = lambda part: F.lpad(part.cast("long").cast("string"), 2, "0")
    clock = F.concat_ws(
        ":",
        pad(F.floor(within / 3_600_000_000)),
        pad(F.floor(within / 60_000_000) % 60),
        pad(F.floor(within / 1_000_000) % 60),
    )
    fraction = within % 1_000_000
    return F.concat(
        days.cast("string"),
        F.when(days < 0, " days +").otherwise(" days "),
        clock,
        F.when(fraction > 0, F.concat(F.lit("."), F.lpad(fraction.cast("string"), 6, "0"))).otherwise(""),
    )


def sanitized(value: Column, kind: T.DataType, in_list: bool = False) -> Column:
    """Output form of a value of any type.

    Missing scalars become null, missing list elements become ``MISSING_ELEMENT``, and
    records follow the scalar rule even inside a list. Timestamps turn into ISO text
    and durations into text.
    """
    if isinstance(kind, T.StructType):
        fields = [sanitized(value[f.name], f.dataType).alias(f.name) for f in kind.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(kind, T.MapType):
        return F.transform_values(value, lambda _, v: sanitized(v, kind.valueType))
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda v: sanitized(v, kind.elementType, in_list=True))
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        value = null_if_nan(value)
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        value, kind = _iso_text(value), T.StringType()
    elif isinstance(kind, T.DayTimeIntervalType):
        value, kind = _duration_text(value), T.StringType()
    if in_list and isinstance(kind, (T.NumericType, T.StringType)):
        value = F.coalesce(value, F.lit(MISSING_ELEMENT).cast(kind))
    return value
