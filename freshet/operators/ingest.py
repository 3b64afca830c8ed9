"""From raw grid rows to the typed retrospective table."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.functions.missing import null_if_fill
from freshet.schemas import FILL_VALUES, FLOW_VARIABLES, RETRO_SCHEMA


def complete_columns(rows: DataFrame, *further: str) -> DataFrame:
    """Add missing model variables as null and project to the fixed column order, ``further`` columns last."""
    missing = {name: F.lit(None).cast("double") for name in FLOW_VARIABLES if name not in rows.columns}
    return rows.withColumns(missing).select(*RETRO_SCHEMA.names, *further)


def fills_to_null(rows: DataFrame, fills: dict[str, float] = FILL_VALUES) -> DataFrame:
    """Turn each column's fill number, and NaN, into null."""
    return rows.withColumns(
        {name: null_if_fill(F.col(name), fill) for name, fill in fills.items() if name in rows.columns}
    )


def typed_retrospective(rows: DataFrame, *further: str) -> DataFrame:
    """Cast to the retrospective schema."""
    return rows.select(*[F.col(f.name).cast(f.dataType) for f in RETRO_SCHEMA.fields], *further)


def retrospective(rows: DataFrame, *further: str) -> DataFrame:
    """Complete, clean and type raw rows; ``further`` columns go along. Narrow throughout: no shuffle."""
    return typed_retrospective(fills_to_null(complete_columns(rows, *further)), *further)
