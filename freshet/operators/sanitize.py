"""Output form of whole records."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.functions.missing import sanitized


def sanitize_records(frame: DataFrame) -> DataFrame:
    """Apply the missing-value rules to every column, driven by the schema.

    The top-level fields of a record follow the scalar rule, elements of lists the
    list rule, at any depth.
    """
    return frame.select(*[sanitized(F.col(f.name), f.dataType).alias(f.name) for f in frame.schema.fields])
