"""Severity scores, row by row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import col

COMPONENTS = [
    "Sofa_Respiration",
    "Sofa_Coagulation",
    "Sofa_Liver",
    "Sofa_Cardiovascular",
    "Sofa_GCS",
    "Sofa_Urine",
]


def gcs_score(df: DataFrame) -> DataFrame:
    total = col("Motor Response") + col("Eye Opening") + col("Verbal Response")
    return df.withColumn("GCS_score", total)


def _steps(*steps: tuple[Column, int]) -> Column:
    """First condition that holds gives the score, none gives 0."""
    chain = F
    for condition, score in steps:
        chain = chain.when(condition, F.lit(score))
    return chain.otherwise(F.lit(0))


def respiration(ratio: Column, ventilated: Column) -> Column:
    return _steps(
        (ratio >= 400, 0),
        (ratio > 300, 1),
        (ratio > 200, 2),
        ((ratio > 100) & ventilated, 3),
        ((ratio <= 100) & ventilated, 4),
    )


def coagulation(platelets: Column) -> Column:
    return _steps(
        (platelets > 150, 0), (platelets > 100, 1), (platelets > 50, 2), (platelets > 20, 3), (platelets <= 20, 4)
    )


def liver(bilirubin: Column) -> Column:
    """Values between two bands score 0, as published."""
    return _steps(
        (bilirubin < 1.2, 0),
        (bilirubin.between(1.2, 1.9), 1),
        (bilirubin.between(2, 5.9), 2),
        (bilirubin.between(6, 11.9), 3),
        (bilirubin >= 12, 4),
    )


def cardiovascular(
    pressure: Column, dopa_rate: Column, dopa_mg: Column, epi_rate: Column, norepi_rate: Column, strict: bool = False
) -> Column:
    """The highest band wins. As published, a dopamine rate of 0 also meets the
    ``<= 5`` band; ``strict`` asks for a rate above 0."""
    low_dopa = (dopa_rate > 0) & (dopa_rate <= 5) if strict else dopa_rate <= 5
    return _steps(
        ((dopa_rate > 15) | (epi_rate > 0.1) | (norepi_rate > 0.1), 4),
        ((dopa_rate > 5) & (epi_rate <= 0.1), 3),
        (low_dopa | (dopa_mg > 0), 2),
        (pressure < 70, 1),
        (pressure >= 70, 0),
    )


def neurologic(gcs: Column) -> Column:
    """Hourly means between two bands score 0, as published."""
    return _steps(
        (gcs == 15, 0),
        (gcs.between(13, 14), 1),
        (gcs.between(10, 12), 2),
        (gcs.between(6, 9), 3),
        (gcs < 6, 4),
    )


def renal(creatinine: Column, urine: Column) -> Column:
    """The lowest band wins."""
    return _steps(
        (creatinine < 1.2, 0),
        (creatinine.between(1.2, 1.9), 1),
        (creatinine.between(2.0, 3.4), 2),
        (creatinine.between(3.5, 4.9) | urine.between(200, 500), 3),
        ((creatinine > 5) | (urine < 200), 4),
    )


def sofa_score(df: DataFrame, strict_cardio: bool = False) -> DataFrame:
    """Six organ scores and their sum. Missing inputs count as 0, apart from the
    oxygenation ratio, where missing gives score 0."""

    def zero(name: str) -> Column:
        return F.coalesce(col(name).cast("double"), F.lit(0.0)) if name in df.columns else F.lit(0.0)

    ratio = col("PaO2/FiO2") if "PaO2/FiO2" in df.columns else F.lit(None).cast("double")
    parts = {
        "Sofa_Respiration": respiration(ratio, zero("Ventilator") > 0),
        "Sofa_Coagulation": coagulation(zero("Platelets")),
        "Sofa_Liver": liver(zero("Total Bilirubin")),
        "Sofa_Cardiovascular": cardiovascular(
            zero("MAP"),
            zero("Dopamine (MCG/KG/MIN)_Rate"),
            zero("Dopamine (MG)"),
            zero("Epinephrine (MCG/KG/MIN)_Rate"),
            zero("Norepinephrine (MCG/KG/MIN)_Rate"),
            strict_cardio,
        ),
        "Sofa_GCS": neurologic(zero("GCS_score")),
        "Sofa_Urine": renal(zero("Creatinine"), zero("Urine output")),
    }
    scored = df.select(*map(col, df.columns), *[expr.alias(name) for name, expr in parts.items()])
    total = F.lit(0)
    for name in COMPONENTS:
        total = total + F.col(name)
    return scored.withColumn("SoFa_score", total)
