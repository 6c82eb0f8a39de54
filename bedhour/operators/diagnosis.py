"""Diagnosis and treatment flags."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import STAY
from ..constants import CULTURE_TREATMENTS, DIAGNOSIS_PREFIXES
from ..functions import col, hour_round
from .joins import lookup_join


def split_codes(diagnosis: DataFrame, code: str = "icd9code") -> DataFrame:
    """``"428.0, I50.9"`` to ``icd9 = 4280`` and ``icd10 = I509``. Rows without
    a second code are dropped, also for matches on the first."""
    parts = F.split(F.col(code), ",")

    def part(i: int) -> Column:
        return F.replace(F.trim(F.try_element_at(parts, F.lit(i))), F.lit("."), F.lit(""))

    return (
        diagnosis.where(F.col(code).isNotNull())
        .withColumn("icd9", part(1))
        .withColumn("icd10", part(2))
        .where(F.col("icd10").isNotNull())
    )


def starts_with_any(code: str, prefixes: list[str]) -> Column:
    """True where the column ``code`` has any of the prefixes; dots in them are
    ignored. One list lookup per prefix length, so a list may hold thousands of
    prefixes; it is parsed in one go, not made of one call per entry."""
    by_length: dict[int, set[str]] = {}
    for prefix in prefixes:
        plain = prefix.replace(".", "")
        by_length.setdefault(len(plain), set()).add(plain)

    def quoted(text: str) -> str:
        return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"

    found = [
        F.expr(f"substring(`{code}`, 1, {n}) IN ({', '.join(map(quoted, sorted(of_length)))})")
        for n, of_length in sorted(by_length.items())
    ]
    return reduce(lambda a, b: a | b, found, F.lit(False))


def diagnosis_groups(
    myocarditis_from_arrhythmia: bool = False,
    infection_icd9: list[str] | None = None,
    infection_icd10: list[str] | None = None,
) -> dict[str, Column]:
    """Group name to match condition. The infection codes are the caller's; with
    ``myocarditis_from_arrhythmia`` that column holds the arrhythmia codes, as
    in the published table."""
    groups = {"suspected_infection": starts_with_any("icd10", infection_icd10 or [])
              | starts_with_any("icd9", infection_icd9 or [])}
    for name, prefixes in DIAGNOSIS_PREFIXES.items():
        groups[name] = starts_with_any("icd10", prefixes)
    if myocarditis_from_arrhythmia:
        groups["Myocarditis"] = groups.pop("Arrhythmia")
    return groups


def infection_codes(codes: DataFrame, first_row_only: bool = False) -> tuple[list[str], list[str]]:
    """ICD-9 and ICD-10 lists from a table ``icd_version, icd_code``, each row
    holding one or more codes joined by comma and space. All rows count; with
    ``first_row_only`` only the first of each version, as published, by the
    column ``position`` or else the order of a single file. What is collected is
    the caller's own code list."""
    version = F.col("icd_version").cast("int")
    rows = codes.where(version.isin(9, 10) & F.col("icd_code").isNotNull())
    if first_row_only:
        at = F.col("position") if "position" in codes.columns else F.monotonically_increasing_id()
        rows = rows.withColumn("_at", at).groupBy(version.alias("version")).agg(F.min_by("icd_code", "_at").alias("icd_code"))
    else:
        rows = rows.select(version.alias("version"), "icd_code")
    found: dict[int, dict[str, None]] = {9: {}, 10: {}}
    for r in rows.collect():
        found[r["version"]].update((c.strip(), None) for c in r["icd_code"].split(",") if c.strip())
    return list(found[9]), list(found[10])


def infection_prefixes(codes: DataFrame, first_row_only: bool = False) -> DataFrame:
    """``version, prefix`` (``icd9`` or ``icd10``, without dots) from the same
    table as ``infection_codes`` takes. It stays a table, whatever its length."""
    version = F.col("icd_version").cast("int")
    rows = codes.where(version.isin(9, 10) & F.col("icd_code").isNotNull())
    if first_row_only:
        at = F.col("position") if "position" in codes.columns else F.monotonically_increasing_id()
        rows = rows.withColumn("_at", at).groupBy(version.alias("icd_version")).agg(F.min_by("icd_code", "_at").alias("icd_code"))
    each = rows.select(F.concat(F.lit("icd"), F.col("icd_version").cast("int")).alias("version"), F.explode(F.split("icd_code", ",")).alias("_p"))
    return each.select("version", F.replace(F.trim("_p"), F.lit("."), F.lit("")).alias("prefix")).where("prefix <> ''").distinct()


def prefix_table(infection: DataFrame, myocarditis_from_arrhythmia: bool = False) -> tuple[DataFrame, list[str]]:
    """``grp, version, prefix`` of all groups, and the names of the groups."""
    fixed = {
        "Myocarditis" if name == "Arrhythmia" and myocarditis_from_arrhythmia else name: prefixes
        for name, prefixes in DIAGNOSIS_PREFIXES.items()
        if not (myocarditis_from_arrhythmia and name == "Myocarditis")
    }
    rows = [(name, "icd10", p.replace(".", "")) for name, prefixes in fixed.items() for p in prefixes]
    listed = infection.sparkSession.createDataFrame(rows, "grp string, version string, prefix string")
    names = ["suspected_infection", *(n for n in diagnosis_groups(myocarditis_from_arrhythmia) if n != "suspected_infection")]
    return infection.select(F.lit("suspected_infection").alias("grp"), "version", "prefix").unionByName(listed), names


def code_groups(codes: DataFrame, prefixes: DataFrame) -> DataFrame:
    """``version, code, groups``: the groups of every different code. A code is
    cut to each length the list has, and the cuts are joined to it by equality."""
    each = F.explode(F.array(*[F.struct(F.lit(v).alias("version"), F.col(v).alias("code")) for v in ("icd9", "icd10")]))
    different = codes.select(each.alias("_c")).select("_c.*").where(F.col("code").isNotNull()).distinct()
    lengths = prefixes.agg(F.collect_set(F.length("prefix")).alias("n")).scalar()
    cuts = different.select("version", "code", F.explode(lengths).alias("_n")).where(F.col("_n") <= F.length("code"))
    cuts = cuts.select("version", "code", F.expr("substring(code, 1, _n)").alias("prefix"))
    listed = prefixes.groupBy("version", "prefix").agg(F.collect_set("grp").alias("groups"))
    hits = lookup_join(cuts, listed, ["version", "prefix"])
    return hits.groupBy("version", "code").agg(F.array_distinct(F.flatten(F.collect_set("groups"))).alias("groups"))


def stay_flags_by_table(codes: DataFrame, prefixes: DataFrame, names: list[str]) -> DataFrame:
    """``stay_flags`` with the groups as a table of prefixes."""
    groups = code_groups(codes, prefixes)
    found = codes.select(STAY, "icd9", "icd10")
    for v in ("icd9", "icd10"):
        of_version = groups.where(F.col("version") == v).select(F.col("code").alias(v), F.col("groups").alias(f"_{v}"))
        found = lookup_join(found, of_version, v, "left")
    none = F.array().cast("array<string>")
    either = F.concat(F.coalesce("_icd9", none), F.coalesce("_icd10", none))
    return found.groupBy(STAY).agg(*[F.max(F.array_contains(either, F.lit(n)).cast("int")).alias(n) for n in names])


def matched_codes(codes: DataFrame, groups: Mapping[str, Column]) -> DataFrame:
    """Distinct (stay, group) pairs with at least one matching code."""
    hits = F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in groups.items()]))
    return codes.select(STAY, F.explode(hits).alias("grp")).distinct()


def stay_flags(codes: DataFrame, groups: Mapping[str, Column]) -> DataFrame:
    """One row per stay with any diagnosis: a 0/1 column for each group, all
    taken in one pass."""
    return codes.groupBy(STAY).agg(
        *[F.max(F.coalesce(cond, F.lit(False)).cast("int")).alias(name) for name, cond in groups.items()]
    )


def culture_stays(treatment: DataFrame, texts: list[str] = CULTURE_TREATMENTS) -> DataFrame:
    """Stays with any treatment text of the list: ``blood_culture = 1``."""
    hit = treatment.where(F.col("treatmentstring").isin(texts))
    return hit.select(STAY).distinct().withColumn("blood_culture", F.lit(1))


def label_hours(intake: DataFrame, labels: list[str], flag: str) -> DataFrame:
    """Distinct (stay, hour) with an intake entry of the listed labels. Several
    entries in an hour give one row, so a join cannot repeat rows."""
    rows = intake.where(F.col("celllabel").isin(labels) & F.col("intakeoutputoffset").isNotNull())
    return (
        rows.select(STAY, hour_round("intakeoutputoffset").alias("hour"))
        .distinct()
        .withColumn(flag, F.lit(1))
    )


def attach_flags(
    table: DataFrame, flags: DataFrame, on: list[str], names: list[str], unique: bool = False
) -> DataFrame:
    """Left join of 0/1 columns; rows without a match get 0. ``unique`` says that
    the key is unique in ``table`` too (stays, or stay hours), so no key is hot
    and a plain join will do."""
    keyed = flags.select(*on, *map(col, names))
    joined = table.join(keyed, on, "left") if unique else lookup_join(table, keyed, on, "left")
    return joined.na.fill(0, names)
