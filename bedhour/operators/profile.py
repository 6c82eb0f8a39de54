"""Counts printed between the stages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import PATIENT, STAY
from ..functions import col


def event_counts(events: DataFrame, item: str) -> DataFrame:
    """Distinct items and stays, and rows, of one family."""
    return events.agg(
        F.countDistinct(col(item)).alias("items"),
        F.countDistinct(STAY).alias("stays"),
        F.count(F.lit(1)).alias("rows"),
    )


def stay_counts(stays: DataFrame) -> DataFrame:
    """Patients, stays, genders, ethnicities and the hours to be expected."""
    return stays.agg(
        F.countDistinct(PATIENT).alias("patients"),
        F.countDistinct(STAY).alias("stays"),
        F.countDistinct("gender").alias("genders"),
        F.countDistinct("ethnicity").alias("ethnicities"),
        F.sum("los").alias("expected_hours"),
    )


def label_frequencies(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(col(column).alias(column)).agg(F.count(F.lit(1)).alias("rows"))
