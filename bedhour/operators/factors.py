"""Drug and fluid totals from the long table, with the conversions as data.

A factor table says which labels count towards which total and by how much. A
label is found by a piece of text in its name, of several pieces by the first in
the table's order; its unit is what stands in its last brackets. So another drug
or unit is a row, and the plan does not grow with the number of labels. The
totals are those of ``units.drug_totals`` and ``units.group_sums``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import STAY
from ..constants import DRUG_DENSITY, ML_PER_UNIT, RATE_DRUGS, UNITS_PER_MCG, UNITS_PER_MG
from .hours import explode_hours
from .joins import balanced_join, lookup_join

# ``search`` is the text that finds a label (not where ``but_not`` stands too), of
# rank ``place``. ``unit``, ``drug`` (the name before the bracket) and ``name``
# narrow it down where given. A value counts ``factor`` times, and is multiplied
# by the weight to the power ``per_kg``.
SCHEMA = (
    "place int, search string, but_not string, rate boolean, unit string, drug string, name string, "
    "total string, factor double, per_kg int"
)

# Search text and name of the drugs, in the order in which labels are looked for.
_DRUGS = {
    "nore": "Norepinephrine",
    "epine": "Epinephrine",
    "dopamin": "Dopamine",
    "dobuta": "Dobutamine",
    "phenyl": "Phenylephrine",
    "vasopre": "Vasopressin",
    "labeta": "Labetalol",
    "milrino": "Milrinone",
}
_NO_RATE = ("Labetalol", "Milrinone")
_NATIVE_MG = {
    "Norepinephrine": ["Norepinephrine (mg)"],
    "Epinephrine": ["Epinephrine (mg)"],
    "Vasopressin": ["Vasopressin (mg)"],
    "Labetalol": ["Labetalol(mg)", "Labetalol (mg)"],
}
_SALINE = [f"{p}NaCl {s}" for s in ("3%", "0.9%", "0.45%") for p in ("med_", "")] + ["med_NaCl 1.5%"]


def default_factors(spark: SparkSession, si: bool = False) -> DataFrame:
    """The factors of the published table, or with ``si`` those that follow the units."""
    rows: list[tuple] = []

    def row(place, search, total, factor, unit=None, rate=False, drug=None, name=None, per_kg=0):
        but_not = "norepine" if search == "epine" else None
        rows.append((place, search, but_not, rate, unit, drug, name, total, float(factor), per_kg))

    for place, (search, drug) in enumerate(_DRUGS.items()):
        amount = f"{drug} (MG)"
        for of, (density, scale) in DRUG_DENSITY.items():
            row(place, search, amount, density / scale, "(ml)", drug=of)
        row(place, search, amount, 1 / 1000, "(mcg)")
        row(place, search, amount, 1 / 1000 if si else 1000, "(mcg/kg)", per_kg=1)
        for native in _NATIVE_MG.get(drug, []):
            row(place, search, amount, 1, name=native)
        if drug in _NO_RATE:
            continue
        rate = f"{drug} (MCG/KG/MIN)_Rate"
        for of in RATE_DRUGS:
            density, scale = DRUG_DENSITY[of]
            row(place, search, rate, density * scale * (1 / 60 if si else 60), "(ml)", True, of, per_kg=-1 if si else 0)
        row(place, search, rate, 1, "(mcg)", True, per_kg=-1)
        row(place, search, rate, 1000 / 60 if si else 1000 * 60, "(mg)", True, per_kg=-1)
        row(place, search, rate, 1, rate=True, name=f"{drug} (mcg/kg)")
    after = len(_DRUGS)
    for place, (search, total) in enumerate((("insulin", "Insulin (Unit)"), ("heparin", "Heparin sodium (Unit)"))):
        row(after + place, search, total, 1 / ML_PER_UNIT, "(ml)")
        row(after + place, search, total, UNITS_PER_MCG, "(mcg)")
    row(after + 2, "nutrition", "Nutrition (ml)", 1)
    for name in _SALINE:
        row(after + 3, "nacl", "Nacl n% (sum)", 1, name=name)
    row(after + 4, "dextro", "Dextrose n% (sum)", 1)
    return spark.createDataFrame(rows, SCHEMA)


def label_factors(labels: DataFrame, factors: DataFrame) -> DataFrame:
    """``family, label, total, factor, per_kg`` of the labels that count. A label
    is cut into all pieces of the lengths searched for, which are joined by
    equality."""
    is_rate = F.col("family") == "rate"
    lower = F.lower("label")
    searches = factors.select("place", "search", "but_not").distinct()
    lengths = searches.agg(F.collect_set(F.length("search")).alias("n")).scalar()
    pieces = labels.select("family", "label", F.explode(lengths).alias("_n")).where(F.col("_n") <= F.length("label"))
    starts = F.explode(F.sequence(F.lit(1), F.length("label") - F.col("_n") + 1)).alias("_at")
    pieces = pieces.select("family", "label", "_n", starts).select("family", "label", F.substr(lower, F.col("_at"), F.col("_n")).alias("search"))
    hits = lookup_join(pieces.distinct(), searches, "search").where(
        F.col("but_not").isNull() | ~F.contains(lower, F.col("but_not"))
    )
    found = hits.groupBy("family", "label").agg(F.min_by("search", "place").alias("search"))
    found = found.select(
        "family",
        "label",
        "search",
        is_rate.alias("rate"),
        F.concat(F.lit("("), F.substring_index("label", "(", -1)).alias("_unit"),
        F.replace(F.trim(F.substring_index("label", "(", 1)), F.lit("med_"), F.lit("")).alias("_drug"),
    )
    rules = factors.drop("place", "but_not")
    joined = lookup_join(found, rules, ["search", "rate"])
    fits = [
        F.col("unit").isNull() | (F.col("unit") == F.col("_unit")),
        F.col("drug").isNull() | (F.col("drug") == F.col("_drug")),
        F.col("name").isNull() | (F.col("name") == F.col("label")),
    ]
    return joined.where(fits[0] & fits[1] & fits[2]).select("family", "label", "total", "factor", "per_kg")


def hourly_totals(long: DataFrame, stays: DataFrame, factors: DataFrame, weight: str = "weight") -> DataFrame:
    """``stay, hour, total, value``: sums of the converted values of
    ``tabular.long_table`` in the hours in which they last. Hours without any
    value of a total have no row; a value per weight counts only where the
    weight is known and not 0."""
    table = label_factors(long.select("family", "label").distinct(), factors)
    cells = lookup_join(long, table, ["family", "label"])
    cells = balanced_join(cells, stays.select(STAY, F.nullif(F.col(weight), F.lit(0.0)).alias("_w")), STAY, "left")
    by_weight = F.when(F.col("per_kg") == 0, F.lit(1.0)).when(F.col("per_kg") > 0, F.col("_w")).otherwise(1 / F.col("_w"))
    cells = cells.withColumn("value", F.col("value") * F.col("factor") * by_weight).where(F.col("value").isNotNull())
    # The sum over a cell's hours comes after equal ranges of hours were added up.
    ranges = cells.groupBy(STAY, "total", "hour", "until").agg(F.sum("value").alias("value"))
    hours = explode_hours(ranges.withColumnRenamed("hour", "_from"), F.col("_from"), F.col("until") - 1)
    return hours.groupBy(STAY, "hour", "total").agg(F.sum("value").alias("value"))
