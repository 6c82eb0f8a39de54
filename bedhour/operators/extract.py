"""Raw tables to long events, one function per family.

Each takes raw DataFrames and the cohort and returns the rows of cohort stays
with their event minute (``event_min``) or interval (``start_min``,
``stop_min``). Offsets are minutes since unit admission.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import PATIENT, STAY
from ..constants import INFUSION_UNITS
from ..functions import contains_text, last_parenthesised
from .cohort import fill_missing
from .joins import balanced_join, lookup_join

_IDS = [PATIENT, "patienthealthsystemstayid", STAY, "unitadmissionoffset"]
_IDS_DISCHARGE = [*_IDS, "unitdischargeoffset"]


def with_cohort(events: DataFrame, cohort: DataFrame, columns: list[str]) -> DataFrame:
    """Inner join with the stay's identifying columns."""
    return balanced_join(events, cohort.select(*columns), STAY, "inner")


def infusion_stop(
    start: Column | str, rate: Column | str, volume: Column | str, unit: Column | str
) -> Column:
    """Minute at which an infusion ends.

    Rate 0 ends at once. A listed unit runs ``volume / rate`` minutes, or that
    many hours when it ends in ``/hr``, rounded up. Without a listed unit the
    end is minute 0.
    """
    start, rate, volume, unit = (F.col(c) if isinstance(c, str) else c for c in (start, rate, volume, unit))
    per_hour = F.substring_index(unit, "/", -1) == "hr"
    minutes = F.when(per_hour, 60 * volume / F.nullif(rate, F.lit(0.0))).otherwise(
        volume / F.nullif(rate, F.lit(0.0))
    )
    return (
        F.when(rate == 0, start)
        .when(unit.isin(INFUSION_UNITS), start + F.ceil(minutes).cast("bigint"))
        .otherwise(F.lit(0).cast("bigint"))
    )


def extract_infusion(infusion: DataFrame, cohort: DataFrame) -> DataFrame:
    zero = F.lit(0.0)
    rows = with_cohort(infusion, cohort, _IDS).select(
        *_IDS,
        "infusiondrugid",
        "drugname",
        "drugrate",
        "infusionoffset",
        F.coalesce("infusionrate", zero).alias("infusionrate"),
        F.coalesce("drugamount", zero).alias("drugamount"),
        F.coalesce("volumeoffluid", zero).alias("volumeoffluid"),
        last_parenthesised("drugname").alias("unit_time"),
        F.col("infusionoffset").alias("start_min"),
    )
    rows = rows.withColumn(
        "stop_min", infusion_stop("start_min", "infusionrate", "volumeoffluid", "unit_time")
    )
    offsets = ["unitadmissionoffset", "start_min", "stop_min", "infusionoffset"]
    return fill_missing(rows.na.drop(subset=offsets), keep_null=offsets)


def _intake_output(table: DataFrame, cohort: DataFrame, word: str, ids: list[str]) -> DataFrame:
    rows = table.where(contains_text("cellpath", word))
    return with_cohort(rows, cohort, ids)


def extract_intake(intake_output: DataFrame, cohort: DataFrame) -> DataFrame:
    rows = _intake_output(intake_output, cohort, "intake", _IDS).select(
        *_IDS,
        "celllabel",
        "cellpath",
        "cellvaluenumeric",
        F.col("intakeoutputoffset").alias("start_min"),
        (F.col("intakeoutputoffset") + 1).alias("stop_min"),
    )
    offsets = ["unitadmissionoffset", "start_min", "stop_min"]
    return fill_missing(rows.na.drop(subset=offsets), keep_null=offsets)


def extract_output(intake_output: DataFrame, cohort: DataFrame) -> DataFrame:
    rows = _intake_output(intake_output, cohort, "output", _IDS_DISCHARGE).select(
        *_IDS_DISCHARGE,
        "celllabel",
        "cellpath",
        "cellvaluenumeric",
        F.col("intakeoutputoffset").alias("event_min"),
    )
    offsets = ["unitadmissionoffset", "unitdischargeoffset", "event_min"]
    return fill_missing(rows.na.drop(subset=offsets), keep_null=offsets)


def extract_treatment(
    treatment: DataFrame, cohort: DataFrame, time_col: str = "treatmentoffset"
) -> DataFrame:
    """Repeated rows count once. Rows outside the cohort go before repeats are
    looked for (the cohort has one row per stay), so they are never shuffled."""
    raw = treatment.select(STAY, time_col, "treatmentid", "treatmentstring")
    rows = with_cohort(raw, cohort, _IDS_DISCHARGE).dropDuplicates().select(
        *_IDS_DISCHARGE, "treatmentid", time_col, "treatmentstring", F.col(time_col).alias("event_min")
    )
    offsets = ["unitadmissionoffset", "unitdischargeoffset", "event_min"]
    return fill_missing(rows.na.drop(subset=offsets), keep_null=offsets)


def extract_labs(lab: DataFrame, custom_lab: DataFrame, cohort: DataFrame) -> DataFrame:
    standard = lab.where(F.col("labresult").isNotNull()).select(
        "labid",
        STAY,
        "labresultoffset",
        "labresult",
        "labname",
        F.coalesce("labmeasurenamesystem", F.lit("0")).alias("labmeasurenamesystem"),
    )
    custom = custom_lab.where(F.col("labotherresult").isNotNull()).select(
        F.col("customlabid").alias("labid"),
        STAY,
        F.col("labotheroffset").alias("labresultoffset"),
        F.col("labotherresult").alias("labresult"),
        F.col("labothername").alias("labname"),
        F.lit("Not exist").alias("labmeasurenamesystem"),
    )
    ids = [PATIENT, STAY, "unitadmissionoffset", "unitdischargeoffset"]
    return (
        with_cohort(standard.unionByName(custom), cohort, ids)
        .withColumn("event_min", F.col("labresultoffset"))
        .na.drop()
    )


def extract_chart(
    nurse: DataFrame, respiratory: DataFrame, cohort: DataFrame, labels: DataFrame | None = None
) -> DataFrame:
    """Bedside and respiratory charting under one set of names, without
    repeated rows. Stays outside the cohort (one row per stay) and, given a
    table of ``labels`` (``itemstring``), labels outside it go first; repeats are
    looked for among the rest."""
    bedside = nurse.select(
        "nursingchartid",
        STAY,
        F.col("nursingchartoffset").alias("event_min"),
        "nursingchartcelltypevallabel",
        "nursingchartvalue",
    )
    resp = respiratory.select(
        F.col("respchartid").alias("nursingchartid"),
        STAY,
        F.col("respchartoffset").alias("event_min"),
        F.col("respchartvaluelabel").alias("nursingchartcelltypevallabel"),
        F.col("respchartvalue").alias("nursingchartvalue"),
    )
    rows = bedside.unionByName(resp).na.drop()
    if labels is not None:
        named = labels.select(F.col("itemstring").alias("nursingchartcelltypevallabel")).distinct()
        rows = lookup_join(rows, named, "nursingchartcelltypevallabel", "left_semi")
    return with_cohort(rows, cohort, [PATIENT, STAY]).dropDuplicates()


PERIODIC = [
    "temperature",
    "sao2",
    "heartrate",
    "respiration",
    "cvp",
    "etco2",
    "systemicsystolic",
    "systemicdiastolic",
]
APERIODIC = ["noninvasivesystolic", "noninvasivediastolic", "paop", "cardiacoutput"]


def unpivot_values(
    table: DataFrame, ids: list[str], columns: Iterable[str], label: str, value: str
) -> DataFrame:
    """Columns to (label, value) rows, without missing values or ids."""
    long = table.unpivot(list(ids), list(columns), label, value)
    return long.na.drop()


def extract_vitals(periodic: DataFrame, aperiodic: DataFrame, cohort: DataFrame) -> DataFrame:
    def long(table: DataFrame, id_col: str, columns: list[str]) -> DataFrame:
        rows = table.select(
            F.col(id_col).alias("nursingchartid"),
            STAY,
            F.col("observationoffset").alias("event_min"),
            *columns,
        )
        return unpivot_values(
            rows,
            ["nursingchartid", STAY, "event_min"],
            columns,
            "nursingchartcelltypevallabel",
            "nursingchartvalue",
        )

    rows = long(periodic, "vitalperiodicid", PERIODIC).unionByName(
        long(aperiodic, "vitalaperiodicid", APERIODIC)
    )
    return with_cohort(rows, cohort, [PATIENT, STAY])


def extract_micro(micro: DataFrame, cohort: DataFrame) -> DataFrame:
    """Culture sites and antibiotics as two streams of labels."""

    def stream(source: str) -> DataFrame:
        return micro.select(
            F.col("microlabid").alias("labid"),
            STAY,
            F.col("culturetakenoffset").alias("event_min"),
            F.col(source).alias("labname"),
        ).na.drop()

    ids = [PATIENT, STAY, "unitadmissionoffset", "unitdischargeoffset"]
    return with_cohort(stream("culturesite").unionByName(stream("antibiotic")), cohort, ids).na.drop()


def vent_intervals(respiratory: DataFrame, event_label: str = "RT Vent On/Off") -> DataFrame:
    """One ventilation interval per stay: first ``Start`` to last ``Off``, or to
    the last entry when there is no ``Off``. Ties go by chart id. The aggregates
    are combined on the map side, so a long stay is never sorted."""
    rows = respiratory.where(F.col("respchartvaluelabel") == event_label)
    entry = F.struct(F.col("respchartoffset").alias("at"), F.col("respchartid").alias("id"))
    value = F.col("respchartvalue")
    grouped = rows.groupBy(STAY).agg(
        F.min(F.when(value == "Start", entry)).alias("start"),
        F.max(F.when(value == "Off", entry)).alias("off"),
        F.max(entry).alias("last"),
    )
    return grouped.where(F.col("start").isNotNull()).select(
        F.col("start.id").alias("respchartid"),
        STAY,
        F.col("start.at").alias("start_min"),
        F.coalesce(F.col("off.at"), F.col("last.at")).alias("stop_min"),
        F.lit("Ventilator").alias("label"),
    )
