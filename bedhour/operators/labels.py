"""Circulatory state per hour and whether shock follows within 12 hours."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import STAY
from ..functions import col
from .hours import BLOCK_HOURS, block_of

BACK = 1
AHEAD = 12
STATES = ("no_circ", "circ", "ambiguous")


def with_halo(
    df: DataFrame, back: int = BACK, ahead: int = AHEAD, block_hours: int = BLOCK_HOURS
) -> DataFrame:
    """Rows by (stay, block), each block with copies of the ``back`` hours before
    it and the ``ahead`` hours after it, marked ``halo``. Windows per block then
    see what windows per stay would, without a task holding a whole stay."""
    hour = F.col("hour")
    blocks = F.sequence(block_of(hour - ahead, block_hours), block_of(hour + back, block_hours))
    return df.withColumn("block", F.explode(blocks)).withColumn(
        "halo", F.col("block") != block_of(hour, block_hours)
    )


def annotate_states(
    df: DataFrame,
    pressure: str = "MAP",
    vaso: str = "vasoactive/inotropic",
    lactate: str = "Lactate",
    block_hours: int = BLOCK_HOURS,
) -> DataFrame:
    """Adds ``Annotation`` from the rows of this hour and the one before.

    ``no_circ``: mean pressure over 65, no vasoactive drug and any lactate under
    2; else ``circ``: mean pressure at most 65 or any vasoactive drug, and any
    lactate of 2 or more; else ``ambiguous``. The window is a range of hours, so
    gaps do not widen it. A table that already has halo rows is used as it is.
    """
    made_halo = "halo" not in df.columns
    rows = with_halo(df, BACK, 0, block_hours) if made_halo else df
    w = W.partitionBy(STAY, "block").orderBy("hour").rangeBetween(-BACK, 0)
    mean, most_vaso = F.avg(col(pressure)).over(w), F.max(col(vaso)).over(w)
    low, high = F.min(col(lactate)).over(w), F.max(col(lactate)).over(w)
    state = (
        F.when((mean > 65) & (most_vaso == 0) & (low < 2), F.lit("no_circ"))
        .when(((mean <= 65) | (most_vaso == 1)) & (high >= 2), F.lit("circ"))
        .otherwise(F.lit("ambiguous"))
    )
    out = rows.withColumn("Annotation", state)
    return out.where(~F.col("halo")).drop("halo", "block") if made_halo else out


def label_next12h(df: DataFrame, block_hours: int = BLOCK_HOURS) -> DataFrame:
    """Adds ``Shock_next_12h``: 1 if a ``circ`` hour lies in (t, t + 12], else 0,
    also when no later hours exist."""
    made_halo = "halo" not in df.columns
    rows = with_halo(df, 0, AHEAD, block_hours) if made_halo else df
    w = W.partitionBy(STAY, "block").orderBy("hour").rangeBetween(1, AHEAD)
    shock = (F.col("Annotation") == "circ").cast("int")
    out = rows.withColumn("Shock_next_12h", F.coalesce(F.max(shock).over(w), F.lit(0)))
    return out.where(~F.col("halo")).drop("halo", "block") if made_halo else out


def label_states(df: DataFrame, block_hours: int = BLOCK_HOURS, **columns: str) -> DataFrame:
    """Both labels with one shuffle: halo rows are added once (unless the table
    has them), state and outlook run in the same partitions, and the halo goes."""
    rows = df if "halo" in df.columns else with_halo(df, BACK, AHEAD, block_hours)
    labelled = label_next12h(annotate_states(rows, block_hours=block_hours, **columns))
    return labelled.where(~F.col("halo")).drop("halo", "block")


def label_crosstab(df: DataFrame) -> DataFrame:
    """Rows per state and outlook."""
    return df.groupBy("Annotation", "Shock_next_12h").agg(F.count(F.lit(1)).alias("rows"))
