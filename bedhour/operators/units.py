"""Drug unit conversion on the wide table.

Columns are found by name: ``<drug> (<unit>)`` holds an amount and
``<drug> (<unit>)_rate`` a rate; intake columns carry the prefix ``med_``.
Conversions return Column expressions, so a whole step is one projection.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import DRUG_DENSITY, ML_PER_UNIT, RATE_DRUGS, UNITS_PER_MCG, UNITS_PER_MG
from ..functions import col, sum_skip_null

WEIGHT = "weight"


def drug_of(column: str) -> str | None:
    """Drug a column is about, by its name before the bracket."""
    name = column.split("(")[0].strip().removeprefix("med_")
    return name if name in DRUG_DENSITY else None


def ml_to_mg(x: Column, drug: str) -> Column:
    density, scale = DRUG_DENSITY[drug]
    return x * F.lit(density) / F.lit(float(scale))


def mcg_to_mg(x: Column) -> Column:
    return x / 1000


def mcgkg_to_mg(x: Column, weight: Column, si: bool = False) -> Column:
    """The published factor multiplies by 1000; ``si`` divides, as the units say."""
    return x / 1000 * weight if si else x * 1000 * weight


def unitkg_to_mg(x: Column, weight: Column) -> Column:
    return x / UNITS_PER_MG * weight


def unit_to_mg(x: Column) -> Column:
    return x / UNITS_PER_MG


def ml_to_unit(x: Column) -> Column:
    return x / ML_PER_UNIT


def mcg_to_unit(x: Column) -> Column:
    return x * UNITS_PER_MCG


def _per_kg(x: Column, weight: Column) -> Column:
    return x / F.nullif(weight, F.lit(0.0))


def mlhr_to_mcgkgmin(x: Column, drug: str, weight: Column | None = None, si: bool = False) -> Column:
    """The published formula has no weight term and multiplies by 60."""
    density, scale = DRUG_DENSITY[drug]
    if si:
        return _per_kg(x * F.lit(density) * F.lit(float(scale)) / 60, weight)
    return x * 60 * F.lit(density) * F.lit(float(scale))


def mcgmin_to_mcgkgmin(x: Column, weight: Column) -> Column:
    return _per_kg(x, weight)


def mghr_to_mcgkgmin(x: Column, weight: Column, si: bool = False) -> Column:
    """The published formula multiplies by 60; ``si`` divides."""
    per_hour = _per_kg(x * 1000, weight)
    return per_hour / 60 if si else per_hour * 60


def unithr_to_mcgkgmin(x: Column, weight: Column) -> Column:
    return _per_kg(x / UNITS_PER_MG * 1000, weight) * 60


def matching(columns: list[str], search: str) -> list[str]:
    """Columns about a drug. ``epine`` does not mean norepinephrine."""
    s = search.lower()
    return [
        c
        for c in columns
        if s in c.lower() and not (s == "epine" and "norepine" in c.lower())
    ]


def _suffix(column: str) -> str:
    return "(" + column.split("(")[-1]


def convert_drug(
    columns: list[str], search: str, si: bool = False
) -> tuple[list[str], dict[str, Column], dict[str, Column], list[str]]:
    """Matched columns, amounts in mg, rates in mcg/kg/min, and the matched
    columns no rule converts (they are dropped from the table, so report them)."""
    matched = matching(columns, search)
    weight = col(WEIGHT)
    amounts: dict[str, Column] = {}
    rates: dict[str, Column] = {}
    lost: list[str] = []
    for name in matched:
        x, unit, drug = col(name), _suffix(name), drug_of(name)
        if unit == "(ml)" and drug:
            amounts[name] = ml_to_mg(x, drug)
        elif unit == "(mcg)":
            amounts[name] = mcg_to_mg(x)
        elif unit == "(mcg/kg)":
            amounts[name] = mcgkg_to_mg(x, weight, si)
        elif unit == "(ml)_rate" and drug in RATE_DRUGS:
            rates[name] = mlhr_to_mcgkgmin(x, drug, weight, si)
        elif unit == "(mcg)_rate":
            rates[name] = mcgmin_to_mcgkgmin(x, weight)
        elif unit == "(mg)_rate":
            rates[name] = mghr_to_mcgkgmin(x, weight, si)
        else:
            lost.append(name)
    return matched, amounts, rates, lost


def convert_units(columns: list[str], search: str) -> tuple[list[str], dict[str, Column]]:
    """Insulin and heparin: all matched columns and their amounts in units."""
    rules: dict[str, Callable[[Column], Column]] = {"(ml)": ml_to_unit, "(mcg)": mcg_to_unit}
    matched = matching(columns, search)
    return matched, {c: rules[_suffix(c)](col(c)) for c in matched if _suffix(c) in rules}


# Total columns per drug: search text, name, native mg columns, native rate column.
_TOTALS = [
    ("nore", "Norepinephrine", ["Norepinephrine (mg)"], True),
    ("epine", "Epinephrine", ["Epinephrine (mg)"], True),
    ("dopamin", "Dopamine", [], True),
    ("dobuta", "Dobutamine", [], True),
    ("phenyl", "Phenylephrine", [], True),
    ("vasopre", "Vasopressin", ["Vasopressin (mg)"], True),
    ("labeta", "Labetalol", ["Labetalol(mg)", "Labetalol (mg)"], False),
    ("milrino", "Milrinone", [], False),
]


def drug_totals(df: DataFrame, si: bool = False) -> tuple[DataFrame, list[str]]:
    """Per drug one amount ``(MG)`` and, for pressors, one rate column; the
    columns they were made from are dropped. Absent columns count as 0. Returns
    the table and the names of columns that were dropped without a rule."""
    remaining = list(df.columns)
    new: dict[str, Column] = {}
    lost: list[str] = []
    for search, name, native_mg, has_rate in _TOTALS:
        matched, amounts, rates, unconverted = convert_drug(remaining, search, si)
        extra = [c for c in native_mg if c in matched]
        new[f"{name} (MG)"] = sum_skip_null([*amounts.values(), *map(col, extra)])
        if has_rate:
            native = [c for c in matched if c == f"{name} (mcg/kg)_rate"]
            new[f"{name} (MCG/KG/MIN)_Rate"] = sum_skip_null([*rates.values(), *map(col, native)])
            extra = [*extra, *native]
        lost += [c for c in unconverted if c not in extra]
        remaining = [c for c in remaining if c not in matched]
    totals = [expr.alias(c) for c, expr in new.items()]
    return df.select(*[col(c) for c in remaining], *totals), lost


def group_sums(df: DataFrame) -> DataFrame:
    """Insulin, nutrition, saline, dextrose and heparin totals, replacing the
    columns they were made from; ``med_Esmolol`` and ``med_Water`` are renamed.
    Rates are not volumes: ``_rate`` columns are dropped and never summed."""
    remaining = list(df.columns)
    new: dict[str, Column] = {}

    def take(search: str) -> list[str]:
        nonlocal remaining
        found = matching(remaining, search)
        remaining = [c for c in remaining if c not in found]
        return [c for c in found if not c.endswith("_rate")]

    _, insulin = convert_units(take("insulin"), "insulin")
    new["Insulin (Unit)"] = sum_skip_null(insulin.values())
    new["Nutrition (ml)"] = sum_skip_null(take("nutrition"))
    saline = take("nacl")
    strengths = ["3%", "0.9%", "0.45%"]
    wanted = [f"{p}NaCl {s}" for s in strengths for p in ("med_", "")] + ["med_NaCl 1.5%"]
    new["Nacl n% (sum)"] = sum_skip_null([c for c in wanted if c in saline])
    new["Dextrose n% (sum)"] = sum_skip_null(take("dextro"))
    _, heparin = convert_units(take("heparin"), "heparin")
    new["Heparin sodium (Unit)"] = sum_skip_null(heparin.values())
    names = {"med_Esmolol": "Esmolol (MG)", "med_Water": "Water"}
    return df.select(
        *[col(c).alias(names.get(c, c)) for c in remaining],
        *[expr.alias(c) for c, expr in new.items()],
    )
