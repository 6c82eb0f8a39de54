"""Stages between raw tables and aligned events, each over a dict of families.

Families: ``med`` (intake), ``ing`` (infusion), ``proc`` (treatment), ``micro``,
``out``, ``chart``, ``vitals``, ``lab``, ``vent``.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import PATIENT, STAY
from ..constants import REQUIRED_ITEMS
from ..operators import align, clean, cohort, extract
from ..operators import select as selection
from ..operators.joins import stays_within

Tables = dict[str, DataFrame]


@dataclass(frozen=True)
class Outliers:
    """What happens to values beyond a family's percentiles: the rows go, or
    with ``impute`` the values move onto the bound."""

    low: float = 2
    high: float = 98
    impute: bool = False

_HS = "patienthealthsystemstayid"

# Columns each family hands to the next stage.
STAGE_COLUMNS = {
    "out": [PATIENT, _HS, STAY, "celllabel", "unitadmissionoffset", "event_min", "cellvaluenumeric"],
    "chart": [PATIENT, STAY, "nursingchartid", "event_min", "nursingchartcelltypevallabel", "nursingchartvalue"],
    "vitals": [PATIENT, STAY, "nursingchartid", "event_min", "nursingchartcelltypevallabel", "nursingchartvalue"],
    "lab": [PATIENT, STAY, "labid", "labname", "event_min", "labresult"],
    "micro": [PATIENT, STAY, "labid", "labname", "event_min"],
    "proc": [PATIENT, _HS, STAY, "treatmentid", "treatmentoffset", "treatmentstring", "unitadmissionoffset", "event_min"],
    "med": [PATIENT, _HS, STAY, "start_min", "stop_min", "celllabel", "cellvaluenumeric"],
    "ing": [PATIENT, _HS, STAY, "infusiondrugid", "start_min", "stop_min", "drugname", "drugrate", "infusionrate"],
    "vent": ["respchartid", STAY, "start_min", "stop_min", "label"],
}

LABELS = {
    "med": "celllabel",
    "ing": "drugname",
    "proc": "treatmentstring",
    "out": "celllabel",
    "chart": "nursingchartcelltypevallabel",
    "lab": "labname",
    "micro": "labname",
}


def extract_events(
    raw: Mapping[str, DataFrame],
    stays: DataFrame,
    families: Iterable[str] | None = None,
    chart_labels: DataFrame | None = None,
) -> Tables:
    """Long events of the wanted families, with their stage columns. Charting of
    labels outside ``chart_labels`` is dropped before repeats are looked for."""
    makers = {
        "out": lambda: extract.extract_output(raw["intakeOutput"], stays),
        "chart": lambda: extract.extract_chart(raw["nurseCharting"], raw["respiratoryCharting"], stays, chart_labels),
        "vitals": lambda: extract.extract_vitals(raw["vitalPeriodic"], raw["vitalAperiodic"], stays),
        "lab": lambda: extract.extract_labs(raw["lab"], raw["customLab"], stays),
        "micro": lambda: extract.extract_micro(raw["microLab"], stays),
        "proc": lambda: extract.extract_treatment(raw["treatment"], stays),
        "med": lambda: extract.extract_intake(raw["intakeOutput"], stays),
        "ing": lambda: extract.extract_infusion(raw["infusionDrug"], stays),
        "vent": lambda: extract.vent_intervals(raw["respiratoryCharting"]),
    }
    wanted = list(families) if families is not None else list(makers)
    return {f: makers[f]().select(*STAGE_COLUMNS[f]) for f in wanted}


def select_events(events: Mapping[str, DataFrame], dictionaries: Mapping[str, DataFrame]) -> Tables:
    """Harmonised labels. Vitals join the charted values; a family without a
    dictionary keeps its labels."""
    out = dict(events)
    if "chart" in out:
        charted = clean.coerce_numeric(out["chart"], "nursingchartvalue")
        if "vitals" in out:
            charted = charted.unionByName(out.pop("vitals"))
        out["chart"] = charted
    for family, label in LABELS.items():
        if family in out and family in dictionaries:
            out[family] = selection.select_features(out[family], dictionaries[family], label)
    return out


def clean_events(
    events: Mapping[str, DataFrame],
    chart: Outliers | None = None,
    lab: Outliers | None = Outliers(),
) -> Tables:
    """Percentile outlier handling per family. Values are numbers afterwards
    either way."""
    out = dict(events)
    for family, value, rule in (("chart", "nursingchartvalue", chart), ("lab", "labresult", lab)):
        if family in out:
            out[family] = (
                clean.clean_outliers(out[family], LABELS[family], value, rule.low, rule.high, rule.impute)
                if rule
                else clean.coerce_numeric(out[family], value)
            )
    return out


def align_events(events: Mapping[str, DataFrame], stays: DataFrame, drop_hour_zero: bool = True) -> Tables:
    """Events in stay hours; cultures become procedures. Intake and infusion
    intervals that start in hour 0 are dropped unless told otherwise."""
    out: Tables = {}
    for family in ("out", "chart", "lab"):
        if family in events:
            out[family] = align.align_points(events[family], stays)
    if "proc" in events:
        out["proc"] = align.align_treatment(events["proc"], stays)
        if "micro" in events:
            out["proc"] = align.union_procedures(align.align_points(events["micro"], stays), out["proc"])
    if "med" in events:
        out["med"] = align.align_intake(events["med"], stays, drop_hour_zero=drop_hour_zero)
    if "ing" in events:
        out["ing"] = align.align_infusion(events["ing"], stays, drop_hour_zero=drop_hour_zero)
    if "vent" in events:
        out["vent"] = align.align_intervals(events["vent"], stays)
    return out


def restrict_cohort(
    stays: DataFrame, events: Mapping[str, DataFrame], min_hours: int = 24, required: list[str] | None = None
) -> DataFrame:
    """Stays of the minimum length in which every required label was charted or
    measured inside the stay."""
    kept = cohort.min_stay(stays, min_hours)
    required = REQUIRED_ITEMS if required is None else required
    if not required:
        return kept
    labelled = (
        events["chart"]
        .select(STAY, "event_min", F.col(LABELS["chart"]).alias("label"))
        .unionByName(events["lab"].select(STAY, "event_min", F.col(LABELS["lab"]).alias("label")))
        .where(F.col("label").isin(required))
    )
    return stays_within(kept, cohort.stays_with_items(align.align_points(labelled, kept), required), STAY)
