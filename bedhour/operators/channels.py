"""From ``family__label`` columns to one column per clinical channel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import STAY
from ..functions import col
from .joins import stays_without
from .tabular import SEP

FAMILIES = ("med", "ing", "rate", "proc", "out", "chart", "lab", "vent", "cryst", "abx")

# Labels charted and measured in the laboratory: which source is read first.
# ``None`` as second means the other source is not used at all.
MERGE_ORDER = {
    "Temperature": ("lab", None),
    "PEEP": ("chart", "lab"),
    "FIO2 (%)": ("lab", "chart"),
    "O2 Sat (%)": ("chart", "lab"),
    "Respiratory Rate": ("chart", "lab"),
}

# Drugs given both as intake and as infusion: one amount, the sum of both.
SUMMED_INTAKE = ["med_Norepinephrine (ml)", "med_Dopamine (ml)"]


def merge_channels(wide: DataFrame) -> DataFrame:
    """Flat channel names. A label in one family keeps its name; one in chart
    and lab is merged in the given order (else the lab copy is ``<label>_lab``);
    one in intake and infusion is summed where listed (else ``<label>_ing``).
    Infusion rates are ``<drug>_rate``. Also flags a height of 0."""
    by_label: dict[str, dict[str, str]] = {}
    out: list[Column] = []
    for name in wide.columns:
        family, _, label = name.partition(SEP)
        if family not in FAMILIES or not label:
            out.append(col(name))
        else:
            by_label.setdefault(label, {})[family] = name
    for label, found in by_label.items():
        if "chart" in found and "lab" in found and label in MERGE_ORDER:
            first, second = MERGE_ORDER[label]
            c = col(found[first])
            out.append((F.coalesce(c, col(found[second])) if second else c).alias(label))
            found = {f: n for f, n in found.items() if f not in ("chart", "lab")}
        if label in SUMMED_INTAKE and "med" in found and "ing" in found:
            out.append((col(found["med"]) + col(found["ing"])).alias(label))
            found = {f: n for f, n in found.items() if f not in ("med", "ing", "rate")}
        taken = False
        for family, name in found.items():
            if family == "rate":
                out.append(col(name).alias(f"{label}_rate"))
            else:
                out.append(col(name).alias(f"{label}_{family}" if taken else label))
                taken = True
    if "height" in wide.columns:
        out.append((F.coalesce(col("height"), F.lit(-1)) == 0).cast("int").alias("height_fillna"))
    return wide.select(*out)


def drop_weightless(wide: DataFrame, stays: DataFrame, weight: str = "admissionweight") -> DataFrame:
    """Drop the stays whose weight is 0, found on the stay table."""
    return stays_without(wide, stays.where(F.col(weight) == 0), STAY)
