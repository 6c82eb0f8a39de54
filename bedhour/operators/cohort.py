"""Cohort operators: one row per unit stay."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import PATIENT, STAY
from ..functions import age_years, hour_round
from .joins import balanced_join

VISIT_COLUMNS = [
    PATIENT,
    STAY,
    "patienthealthsystemstayid",
    "unitadmissionoffset",
    "unitdischargeoffset",
    "los_min",
    "min_valid_year",
    "unitdischargestatus",
    "Age",
    "gender",
    "ethnicity",
    "admissionheight",
    "admissionweight",
    "dischargeweight",
]

COHORT_COLUMNS = [
    PATIENT,
    STAY,
    "unitadmissionoffset",
    "unitdischargeoffset",
    "Age",
    "gender",
    "ethnicity",
    "admissionheight",
    "admissionweight",
    "label",
    "unitdischargestatus",
    "patienthealthsystemstayid",
]


def visit_table(patient: DataFrame, min_age: float = 18) -> DataFrame:
    """Adult stays; time starts at unit admission, so its offset is 0. A stay
    without a discharge offset keeps a null length and is sorted out later."""
    return (
        patient.withColumn("Age", age_years("age"))
        .where(F.col("Age") >= min_age)
        .withColumn("unitadmissionoffset", F.lit(0).cast("bigint"))
        .withColumn("los_min", F.col("unitdischargeoffset") - F.col("unitadmissionoffset"))
        .withColumn("min_valid_year", F.col("hospitaldischargeyear"))
        .select(*VISIT_COLUMNS)
    )


def _invalid():
    return F.col("unitadmissionoffset").isNull() | F.col("unitdischargeoffset").isNull()


def invalid_visits(visits: DataFrame) -> DataFrame:
    """Stays without an admission or discharge offset."""
    return visits.where(_invalid())


def valid_visits(visits: DataFrame) -> DataFrame:
    return visits.where(~_invalid())


def fill_missing(df: DataFrame, keep_null: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """Missing values become 0 in number columns and ``"0"`` in text columns."""
    out = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if field.name not in keep_null:
            if isinstance(field.dataType, T.StringType):
                c = F.coalesce(c, F.lit("0"))
            elif isinstance(field.dataType, T.NumericType):
                c = F.coalesce(c, F.lit(0).cast(field.dataType))
        out.append(c.alias(field.name))
    return df.select(*out)


def mortality_label(visits: DataFrame) -> DataFrame:
    """1 for a stay that ended with ``Expired`` and a non-negative length."""
    expired = F.col("unitdischargestatus").eqNullSafe("Expired")
    in_order = F.col("unitdischargeoffset") >= F.col("unitadmissionoffset")
    labelled = valid_visits(visits).withColumn("label", (expired & in_order).cast("int"))
    return fill_missing(labelled)


def case_control_split(visits: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Labelled cohort and the invalid stays set aside."""
    return mortality_label(visits), invalid_visits(visits)


def build_cohort(patient: DataFrame, min_age: float = 18) -> DataFrame:
    cohort, _ = case_control_split(visit_table(patient, min_age))
    return cohort.select(*COHORT_COLUMNS)


def cohort_summary(cohort: DataFrame) -> DataFrame:
    """One row: records, patients, positive and negative cases."""
    return cohort.agg(
        F.count(F.lit(1)).alias("records"),
        F.countDistinct(PATIENT).alias("patients"),
        F.coalesce(F.sum((F.col("label") == 1).cast("bigint")), F.lit(0)).alias("positive"),
        F.coalesce(F.sum((F.col("label") == 0).cast("bigint")), F.lit(0)).alias("negative"),
    )


SUMMARY_LINES = {
    "records": "stays in the cohort",
    "patients": "different patients",
    "positive": "stays that ended in death",
    "negative": "stays survived",
}


def summary_text(cohort: DataFrame, title: str = "Mortality") -> DataFrame:
    """The summary as lines of text, ready for ``write.text``."""
    s = cohort_summary(cohort)
    return s.select(
        F.concat_ws(
            "\n",
            F.lit(title),
            *[F.concat(F.lit(f"{name} = "), F.col(c)) for c, name in SUMMARY_LINES.items()],
        ).alias("value")
    )


def los_hours(cohort: DataFrame) -> DataFrame:
    """Length of stay in whole hours; stays that round to 0 are dropped."""
    minutes = F.col("unitdischargeoffset") - F.col("unitadmissionoffset")
    return (
        cohort.withColumn("los_min", minutes)
        .withColumn("los", hour_round("los_min"))
        .where(F.col("los") > 0)
        .withColumn("Age", F.col("Age").cast("int"))
    )


def min_stay(stays: DataFrame, hours: int = 24) -> DataFrame:
    return stays.where(F.col("los") >= hours)


def restrict_events(events: DataFrame, stays: DataFrame, hour: str = "hour") -> DataFrame:
    """Events of the kept stays that start at or after admission."""
    kept = events.where(F.col(hour) >= 0)
    return balanced_join(kept, stays.select(STAY), STAY, "left_semi")


def stays_with_items(
    labelled: DataFrame, required: list[str], label: str = "label", key: str = STAY
) -> DataFrame:
    """Stays in which every required label occurs at least once.

    Rows are reduced to one per stay and label before the count, so a stay with
    very many rows is combined on the map side.
    """
    pairs = labelled.where(F.col(label).isin(required)).select(key, label).distinct()
    return (
        pairs.groupBy(key)
        .agg(F.count(F.lit(1)).alias("found"))
        .where(F.col("found") == len(set(required)))
        .select(key)
    )
