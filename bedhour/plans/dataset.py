"""From aligned events to the final labelled table."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import STAY
from ..constants import ANTIBIOTIC_LABELS, CULTURE_TREATMENTS
from ..functions import col, contains_text, positive_flag, sum_skip_null, to_number
from ..operators import align, channels, cohort, diagnosis, impute, labels, scores, tabular, units
from ..operators.joins import stays_within
from ..operators.tabular import Stream
from ..sources import Stages
from .stages import Outliers, align_events, clean_events, extract_events, restrict_cohort, select_events

ADDED_FLUID = "Crystalloids"
ADDED_ANTIBIOTIC = "Antibiotics_list"
TIME = "Time_since_ICU_admission"


def event_streams(aligned: Mapping[str, DataFrame], rate_zero: bool = False) -> dict[str, Stream]:
    """Aligned families with the rule each is tabularised by. ``rate_zero`` gives
    infusion rates of 0, as in the published table."""
    aligned = dict(aligned)
    if rate_zero and "ing" in aligned:
        aligned["ing"] = aligned["ing"].withColumn("infusionrate", F.lit(0.0))
    kinds = {
        "med": ("interval", {"med": "cellvaluenumeric"}, "celllabel"),
        "ing": ("interval", {"ing": "amount", "rate": "infusionrate"}, "drugname"),
        "proc": ("flag", {"proc": "treatmentstring"}, "treatmentstring"),
        "out": ("hourly", {"out": "cellvaluenumeric"}, "celllabel"),
        "chart": ("hold", {"chart": "nursingchartvalue"}, "nursingchartcelltypevallabel"),
        "lab": ("hold", {"lab": "labresult"}, "labname"),
    }
    streams = {
        f: Stream(aligned[f], kind, values, label)
        for f, (kind, values, label) in kinds.items()
        if f in aligned
    }
    if "vent" in aligned:
        on = aligned["vent"].withColumn("on", F.lit(1.0))
        streams["vent"] = Stream(on, "interval", {"vent": "on"})
    return streams


def crystalloid_intervals(intake_output: DataFrame, stays: DataFrame, label: str = ADDED_FLUID) -> DataFrame:
    """Crystalloid intake from minute 0 on, as one-hour intervals."""
    rows = intake_output.where(
        contains_text("cellpath", "intake") & (F.col("celllabel") == label) & (F.col("intakeoutputoffset") >= 0)
    ).select(
        STAY,
        F.col("intakeoutputoffset").alias("start_min"),
        F.lit(ADDED_FLUID).alias("label"),
        to_number(F.col("cellvaluenumeric").cast("string")).alias("dose"),
    )
    return align.align_intervals(rows, stays, stop=None)


def antibiotic_hours(intake_output: DataFrame, stays: DataFrame, names: list[str]) -> DataFrame:
    """Hours of the stay with an intake entry of the antibiotic list."""
    rows = intake_output.where(
        contains_text("cellpath", "intake") & F.col("celllabel").isin(names)
    ).select(STAY, F.col("intakeoutputoffset").alias("event_min"), F.lit(ADDED_ANTIBIOTIC).alias("label"))
    return align.align_points(rows, stays)


def hourly_table(
    stays: DataFrame,
    streams: Mapping[str, Stream],
    static: list[str],
    halo: tuple[int, int] = (labels.BACK, labels.AHEAD),
    **options,
) -> DataFrame:
    """Wide hourly table with flat channel names and halo rows for the labels."""
    wide = tabular.tabularize(stays, streams, static=static, halo=halo, **options)
    return channels.merge_channels(wide.drop("los"))


def engineer_features(flat: DataFrame, si: bool = False, strict_cardio: bool = False) -> DataFrame:
    """All row-wise steps: drug totals, sums, imputation, flags and scores.
    They add no shuffle and change no row."""
    totals, _ = units.drug_totals(flat, si)
    df = units.group_sums(totals)
    df = impute.null_above(df)
    df = impute.positive_column(df, "med_Antibiotics (ml)", "Antibiotics")
    df = impute.derived_impute(impute.default_impute(df))
    df = impute.vasoactive_flag(df).drop("Labetalol (MG)", "Esmolol (MG)")
    df = impute.fluids_total(df, ADDED_FLUID)
    if "blood_culture" in df.columns:
        culture = positive_flag(sum_skip_null([c for c in ("blood_culture", "Blood culture") if c in df.columns]))
        df = df.withColumn("Blood culture", culture).drop("blood_culture")
    if ADDED_ANTIBIOTIC in df.columns:
        both = sum_skip_null([ADDED_ANTIBIOTIC, "Antibiotics"])
        df = df.withColumn("Antibiotics", positive_flag(both)).drop(ADDED_ANTIBIOTIC)
    return scores.sofa_score(scores.gcs_score(df), strict_cardio)


def finish(labelled: DataFrame) -> DataFrame:
    """Remaining missing numbers are 0; time gets its final name."""
    return labelled.na.fill(0).withColumnRenamed("hour", TIME)


@dataclass(frozen=True)
class Mode:
    """How far the published computation is followed where it contradicts its
    own units or names.

    ``rate_zero``: infusion rates are 0. ``si``: unit factors follow the units.
    ``strict_cardio``: a dopamine rate of 0 scores nothing.
    ``myocarditis_from_arrhythmia``: that column holds the arrhythmia codes.
    """

    rate_zero: bool
    si: bool
    strict_cardio: bool
    myocarditis_from_arrhythmia: bool


MODES = {
    "published": Mode(rate_zero=True, si=False, strict_cardio=False, myocarditis_from_arrhythmia=True),
    "corrected": Mode(rate_zero=False, si=True, strict_cardio=True, myocarditis_from_arrhythmia=False),
}

# Columns of the raw tables that are read for more than one purpose.
SHARED = {
    "intakeOutput": [STAY, "intakeoutputoffset", "cellpath", "celllabel", "cellvaluenumeric"],
    "respiratoryCharting": [STAY, "respchartid", "respchartoffset", "respchartvaluelabel", "respchartvalue"],
    "treatment": [STAY, "treatmentid", "treatmentoffset", "treatmentstring"],
}


def final_dataset(
    raw: Mapping[str, DataFrame],
    dictionaries: Mapping[str, DataFrame],
    infection_codes: tuple[list[str], list[str]] | DataFrame = ((), ()),
    mode: str | Mode = "corrected",
    min_hours: int = 24,
    required: list[str] | None = None,
    clean_chart: Outliers | None = None,
    clean_lab: Outliers | None = Outliers(),
    crystalloid_label: str = ADDED_FLUID,
    antibiotics: list[str] = ANTIBIOTIC_LABELS,
    cultures: list[str] = CULTURE_TREATMENTS,
    feature_labels: Mapping[str, list[str]] | None = None,
    stages: Stages | None = None,
) -> DataFrame:
    """Raw tables to one labelled row per stay and hour. ``infection_codes`` are
    two short lists, or a table as ``infection_prefixes`` gives.

    Everything that depends on the stay alone (diagnoses, cultures, category
    codes) is joined to the stay table; everything that depends on the hour
    travels in the event stream. The wide table itself is shuffled once.

    Raw tables that serve several families are read once, for the cohort's
    stays, and what is read more than once after that (cohort, charted values,
    labs, final stays, hourly cells) is written to ``stages`` too: a lost
    executor then costs a stage, join sizes are known from the files, and a run
    by the same name goes on where it was.
    """
    rules = MODES[mode] if isinstance(mode, str) else mode
    stages = stages or Stages(raw["patient"].sparkSession)
    raw = dict(raw)
    base = stages.write(cohort.los_hours(cohort.build_cohort(raw["patient"])), "cohort", by_stay=True)
    for name, columns in SHARED.items():
        raw[name] = stages.write(stays_within(raw[name].select(*columns), base, STAY), f"raw-{name}")
    charted = dictionaries["chart"] if "chart" in dictionaries else None
    selected = select_events(extract_events(raw, base, chart_labels=charted), dictionaries)
    for family, rule in (("chart", clean_chart), ("lab", clean_lab)):
        if rule:  # cleaning reads a family's values several times
            selected[family] = stages.write(selected[family], f"selected-{family}")
    events = clean_events(selected, chart=clean_chart, lab=clean_lab)
    for family in ("chart", "lab"):
        events[family] = stages.write(events[family], f"events-{family}", by_stay=True)
    stays = restrict_cohort(base, events, min_hours, required)

    codes = diagnosis.split_codes(raw["diagnosis"])
    if isinstance(infection_codes, DataFrame):
        prefixes, groups = diagnosis.prefix_table(infection_codes, rules.myocarditis_from_arrhythmia)
        coded = diagnosis.stay_flags_by_table(codes, prefixes, groups)
    else:
        groups = diagnosis.diagnosis_groups(rules.myocarditis_from_arrhythmia, *map(list, infection_codes))
        coded = diagnosis.stay_flags(codes, groups)
    cultured = diagnosis.culture_stays(raw["treatment"], cultures)
    attributes = tabular.encode_labels(stays, ["gender", "ethnicity"])
    attributes = (
        attributes.where(F.coalesce(F.col("admissionweight"), F.lit(-1)) != 0)
        .withColumnsRenamed({"admissionheight": "height", "admissionweight": "weight"})
        .join(coded, STAY, "left")
        .join(cultured, STAY, "left")
        .na.fill(0, [*groups, "blood_culture"])
    )
    attributes = stages.write(attributes, "stays", by_stay=True)
    static = ["uniquepid", "Age", "gender", "ethnicity", "height", "weight", "blood_culture", *groups]

    streams = event_streams(align_events(events, attributes), rules.rate_zero)
    intake = raw["intakeOutput"]
    streams["cryst"] = Stream(
        crystalloid_intervals(intake, attributes, crystalloid_label), "interval", {"cryst": "dose"}
    )
    streams["abx"] = Stream(antibiotic_hours(intake, attributes, antibiotics), "flag", {"abx": "label"})
    flat = hourly_table(attributes, streams, static, labels=feature_labels, store_cells=stages)
    return finish(labels.label_states(engineer_features(flat, rules.si, rules.strict_cardio)))
