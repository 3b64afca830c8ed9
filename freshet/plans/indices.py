"""One index record per reach."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.operators.baseflow import baseflow_index, baseflow_inputs, with_baseflow_index
from freshet.operators.duration_curve import months_and_curve
from freshet.operators.flood import flood_season_start
from freshet.operators.monthly import monthwise_arrays, monthwise_stats
from freshet.operators.sanitize import sanitize_records
from freshet.operators.water_years import marked_status, reach_status, trim_water_years
from freshet.operators.yearly import with_seven_q10, yearly_aggregates
from freshet.operators.yearly_state import days_of, kept_states, merged_curve, merged_status, merged_yearly
from freshet.schemas import FAILED_ARRAY_LENGTHS, INDICES_SCHEMA


def streamflow_indices(daily: DataFrame, empty_year: str = "skip") -> DataFrame:
    """All sixteen indices for all reaches, as unsanitized records.

    The days are shuffled by reach once. Every branch below starts from that exchange
    with the same columns, so Spark reuses it, and the branches join where they are.
    A reach that fails gets a record of nulls, with arrays of fixed length.
    """
    days = (
        daily.select("reach_id", "date", "streamflow")
        .where(F.col("reach_id").isNotNull())
        .repartition("reach_id")
    )
    return _records(reach_status(days), trim_water_years(days), empty_year)


def _records(status: DataFrame, trimmed: DataFrame, empty_year: str, in_place: bool = False) -> DataFrame:
    return _joined(status, [yearly_aggregates(trimmed), months_and_curve(trimmed)], trimmed, empty_year, in_place)


def _joined(status: DataFrame, branches: list[DataFrame], trimmed: DataFrame, empty_year: str, in_place: bool = False) -> DataFrame:
    """One row per reach of all branches.

    Spark chooses the joins, and the branches run side by side; as it forgets the layout of what
    comes out of Python, the baseflow index is shuffled once more, a number per reach.
    ``in_place`` spares that and the joins' sorts: the rows are hashed where they are, the lists
    of days stream past them, and both kernels run after the joins, in one stage.
    """
    record = status
    for branch in (*branches, flood_season_start(trimmed, empty_year)):
        record = record.join(branch.hint("shuffle_hash") if in_place else branch, "reach_id", "left")
    if in_place:
        record = with_baseflow_index(baseflow_inputs(trimmed).join(record.hint("shuffle_hash"), "reach_id", "right"))
    else:
        record = record.join(baseflow_index(trimmed), "reach_id", "left")
    record = with_seven_q10(record)

    def value(field):
        nothing = F.lit(None)
        if field.name in FAILED_ARRAY_LENGTHS:
            nothing = F.array_repeat(F.lit(None).cast("double"), FAILED_ARRAY_LENGTHS[field.name])
        return F.when(F.col("computed"), F.col(field.name)).otherwise(nothing).cast(field.dataType).alias(field.name)

    return record.select(F.col("reach_id"), *[value(f) for f in INDICES_SCHEMA.fields[1:]])


def indices_of_store(stored: DataFrame, empty_year: str = "skip") -> DataFrame:
    """As ``indices_table``, of a daily store: its buckets and their order spare all shuffles, and most sorts."""
    trimmed = stored.where("kept").select("reach_id", "water_year", "date", "streamflow")
    return sanitize_records(_records(marked_status(stored), trimmed, empty_year, in_place=True))


def indices_of_states(states: DataFrame, empty_year: str = "skip") -> DataFrame:
    """As ``indices_table``, merged from the states of all years of the reaches; one shuffle by reach."""
    marked = kept_states(states.repartition("reach_id"))
    kept = marked.where("kept")
    trimmed = days_of(kept)
    months = monthwise_arrays(monthwise_stats(trimmed))
    return sanitize_records(_joined(merged_status(marked), [merged_yearly(kept), merged_curve(kept), months], trimmed, empty_year))


def indices_table(daily: DataFrame, empty_year: str = "skip") -> DataFrame:
    """The records as they are written: missing scalars null, missing elements -99."""
    return sanitize_records(streamflow_indices(daily, empty_year))
