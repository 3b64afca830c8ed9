"""Water years and calendar arithmetic on date columns."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def water_year(date: Column, starting_month: int = 10) -> Column:
    """Water year of a date.

    A year that starts in the first half of the calendar year carries the number of
    the year it starts in; one that starts in the second half, the year it ends in.
    """
    started = (F.month(date) >= starting_month).cast("int")
    offset = started - 1 if starting_month < 7 else started
    return (F.year(date) + offset).cast("int")


def is_leap_year(year: Column) -> Column:
    return ((year % 4 == 0) & (year % 100 != 0)) | (year % 400 == 0)


def days_in_year(year: Column) -> Column:
    """Expected number of days of a year number.

    For water years starting in March to June the leap day falls into the calendar
    year after the number; the expected length still follows the number itself.
    """
    return F.when(is_leap_year(year), 366).otherwise(365)


def day_of_numbered_year(date: Column, year: Column) -> Column:
    """1-based day counted from 1 January of ``year``; zero or negative before it."""
    return F.datediff(date, F.make_date(year, F.lit(1), F.lit(1))) + 1
