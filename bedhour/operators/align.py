"""Minutes since admission to whole hours of the stay."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import STAY
from ..functions import hour_ceil, hour_round, to_number
from .joins import balanced_join


def align_points(events: DataFrame, stays: DataFrame, minute: str = "event_min") -> DataFrame:
    """Point events in hours ``0 .. los-1``: adds ``hour`` and the stay's ``los``.

    The hour test runs before the join, so early events never shuffle.
    """
    timed = events.withColumn("hour", hour_round(minute)).where(F.col("hour") >= 0).drop(minute)
    joined = balanced_join(timed, stays.select(STAY, "los"), STAY, "inner")
    return joined.where(F.col("hour") < F.col("los"))


def align_intervals(
    intervals: DataFrame,
    stays: DataFrame,
    start: str = "start_min",
    stop: str | None = "stop_min",
    drop_hour_zero: bool = False,
    keep_before_admission: bool = False,
) -> DataFrame:
    """Intervals as ``start_hour`` to ``stop_hour`` (exclusive, cut at ``los``).

    The start is rounded and the stop rounded up; with ``stop=None`` every
    interval lasts one hour. Intervals that end at or before their start, or
    start at or after discharge, are dropped. ``drop_hour_zero`` also drops
    intervals that start or end at hour 0. Starts before admission are dropped
    unless ``keep_before_admission``.
    """
    begin = hour_round(start)
    end = hour_ceil(stop) if stop else F.col("start_hour") + 1
    timed = intervals.withColumn("start_hour", begin).withColumn("stop_hour", end)
    timed = timed.where(F.col("stop_hour") > F.col("start_hour"))
    if not keep_before_admission:
        timed = timed.where(F.col("start_hour") >= 0)
    if drop_hour_zero:
        timed = timed.where((F.col("start_hour") > 0) & (F.col("stop_hour") > 0))
    timed = timed.drop(*[c for c in (start, stop) if c])
    joined = balanced_join(timed, stays.select(STAY, "los"), STAY, "inner")
    return joined.where(F.col("start_hour") < F.col("los")).withColumn(
        "stop_hour", F.least("stop_hour", "los")
    )


def align_treatment(treatment: DataFrame, stays: DataFrame) -> DataFrame:
    """Treatments by hour. Ventilator treatments are left to the ventilation
    intervals; a missing text is kept."""
    kept = treatment.where(~F.col("treatmentstring").eqNullSafe("Ventilator"))
    return align_points(kept, stays)


def union_procedures(micro: DataFrame, treatment: DataFrame) -> DataFrame:
    """Cultures and treatments as one stream of procedures."""
    columns = ["uniquepid", STAY, "treatmentid", "treatmentstring", "hour", "los"]
    cultures = micro.withColumnsRenamed({"labid": "treatmentid", "labname": "treatmentstring"})
    return cultures.select(*columns).unionByName(treatment.select(*columns))


def align_intake(intake: DataFrame, stays: DataFrame, **options) -> DataFrame:
    """One-hour intake intervals with the dose as a number."""
    rows = align_intervals(intake.drop("stop_min"), stays, stop=None, **options)
    return rows.withColumn("cellvaluenumeric", to_number(F.col("cellvaluenumeric").cast("string")))


def align_infusion(infusion: DataFrame, stays: DataFrame, **options) -> DataFrame:
    """Infusion intervals; the amount is the drug rate text as a number."""
    rows = align_intervals(infusion, stays, **options)
    return rows.withColumn("amount", to_number("drugrate")).drop("drugrate")
