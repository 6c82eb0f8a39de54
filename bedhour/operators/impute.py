"""Missing values on the wide table, and flags made from totals."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import DEFAULTS, VASOACTIVE
from ..functions import col, positive_flag, sum_skip_null


def _column_or_null(df: DataFrame, name: str) -> Column:
    return col(name) if name in df.columns else F.lit(None).cast("double")


def _replace(df: DataFrame, new: Mapping[str, Column]) -> DataFrame:
    """One projection with ``new`` columns replaced or added."""
    kept = [new[c].alias(c) if c in new else col(c) for c in df.columns]
    added = [expr.alias(c) for c, expr in new.items() if c not in df.columns]
    return df.select(*kept, *added)


def null_above(df: DataFrame, column: str = "Temperature", limit: float = 50) -> DataFrame:
    if column not in df.columns:
        return df
    c = col(column)
    return _replace(df, {column: F.when(~F.coalesce(c > limit, F.lit(False)), c)})


def default_impute(df: DataFrame, defaults: Mapping[str, float] = DEFAULTS) -> DataFrame:
    """Constant for a missing value, with ``<column>_fillna`` telling where. A
    column the table lacks counts as missing throughout."""
    new: dict[str, Column] = {}
    for name, default in defaults.items():
        c = _column_or_null(df, name)
        new[name] = F.coalesce(c, F.lit(float(default)))
        new[f"{name}_fillna"] = c.isNull().cast("int")
    return _replace(df, new)


def derived_impute(df: DataFrame) -> DataFrame:
    """Mean pressure, cardiac output and the oxygenation ratio, from columns
    that ``default_impute`` has filled."""
    mean_pressure = _column_or_null(df, "MAP")
    output = _column_or_null(df, "Cardiac Output")
    body = F.pow(col("weight"), F.lit(0.425)) * F.pow(col("height"), F.lit(0.725))
    return _replace(
        df,
        {
            "MAP": F.coalesce(mean_pressure, (2 * col("ABPd") + col("ABPs")) / 3),
            "MAP_fillna": mean_pressure.isNull().cast("int"),
            "Cardiac Output": F.coalesce(output, F.lit(3.5 * 0.007184) * body),
            "Cardiac Output_fillna": output.isNull().cast("int"),
            "PaO2/FiO2": F.try_divide(col("PaO2"), col("FIO2 (%)") / 100),
        },
    )


def positive_column(df: DataFrame, source: str, name: str) -> DataFrame:
    """Replace ``source`` by a 0/1 column; absent counts as 0."""
    flag = positive_flag(_column_or_null(df, source))
    out = _replace(df, {name: flag})
    return out.select(*[col(c) for c in out.columns if c != source or c == name])


def vasoactive_flag(df: DataFrame, totals: list[str] = VASOACTIVE) -> DataFrame:
    present = [c for c in totals if c in df.columns]
    return _replace(df, {"vasoactive/inotropic": positive_flag(sum_skip_null(present))})


def beta_blocker_flag(df: DataFrame) -> DataFrame:
    """1 when labetalol or esmolol was given. A missing amount leaves it 0."""
    total = _column_or_null(df, "Labetalol (MG)") + _column_or_null(df, "Esmolol (MG)")
    return _replace(df, {"ACE_inhibitors(beta-blocker)": positive_flag(total)})


FLUID_PARTS = [
    "Insulin (Unit)",
    "Nutrition (ml)",
    "Nacl n% (sum)",
    "Dextrose n% (sum)",
    "Heparin sodium (Unit)",
    "Water",
]


def fluids_total(df: DataFrame, crystalloid: str | None = None) -> DataFrame:
    """Fluid volume per hour: heparin units times 100 and the other parts, plus
    the hourly crystalloid column when given. The parts are dropped."""
    terms = [col(c) * 100 if c == "Heparin sodium (Unit)" else col(c) for c in FLUID_PARTS if c in df.columns]
    if crystalloid and crystalloid in df.columns:
        terms.append(col(crystalloid))
    parts = [c for c in [*FLUID_PARTS, *([crystalloid] if crystalloid else [])] if c in df.columns]
    return _replace(df, {"Fluids(ml)": sum_skip_null(terms)}).drop(*parts)
