"""Command line: raw files to the final table.

    spark-submit -m bedhour.plans.run RAW_FOLDER DICTIONARY_FOLDER OUTPUT [options]

Every raw table is converted to Parquet once (a gzipped CSV can only be read by
one task), then all stages work on that. With ``--run NAME`` a run that was
stopped goes on after its last complete stage, as far as inputs, options and code
are the same. The stages are removed at the end, unless ``--keep-stages``.
"""

from __future__ import annotations

import argparse
from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import cohort, labels
from ..operators.diagnosis import infection_prefixes
from ..session import build_session
from ..sources import Stages, file_position, read_dictionary, read_raw_observed
from .dataset import MODES, TIME, final_dataset
from .stages import Outliers

# Dictionary file of each family.
DICTIONARY_FILES = {
    "med": "total_med_infusion_intake.csv",
    "ing": "total_med_infusion_intake.csv",
    "proc": "total_procedure.csv",
    "out": "total_output.csv",
    "chart": "total_lab_chart.csv",
    "lab": "total_lab_chart.csv",
    "micro": "total_lab_chart.csv",
}


def to_parquet(tables: Mapping[str, tuple[DataFrame, Observation]], stages: Stages) -> dict[str, DataFrame]:
    """Each raw table read once and written with its fixed types. The write
    counts rows and unreadable values, and sketches frequent keys for the joins."""
    return {name: stages.write(table, f"source-{name}", observations=[seen]) for name, (table, seen) in tables.items()}


def source_report(spark: SparkSession, stages: Stages) -> DataFrame:
    """``table, counter, value``: what was counted while the sources were read."""
    rows = [
        (name.removeprefix("source-"), counter, value)
        for name, seen in stages.observed.items()
        if name.startswith("source-")
        for counter, value in seen.items()
        if isinstance(value, int)
    ]
    return spark.createDataFrame(rows, "table string, counter string, value bigint")


COUNTS = ("rows", "stays", "last_hour")


def observe_final(final: DataFrame) -> tuple[DataFrame, Observation]:
    """The final table with the counts that its reports need, taken as it is
    written. Every stay has one row of hour 0."""
    seen = Observation("final")
    pairs = [
        F.count_if((F.col("Annotation") == state) & (F.col("Shock_next_12h") == shock)).alias(f"{state} {shock}")
        for state in labels.STATES
        for shock in (0, 1)
    ]
    counts = [F.count(F.lit(1)).alias("rows"), F.count_if(F.col(TIME) == 0).alias("stays"), F.max(TIME).alias("last_hour")]
    return final.observe(seen, *counts, *pairs), seen


def write_reports(patient: DataFrame, seen: Mapping[str, int | None], sources: DataFrame, output: str) -> None:
    """Cohort figures (from the patient table alone), what was counted while the
    sources were read and the final table written: no scan of either."""
    spark = patient.sparkSession
    labelled = cohort.mortality_label(cohort.visit_table(patient))
    cohort.cohort_summary(labelled).write.mode("overwrite").json(f"{output}/cohort")
    counts = spark.createDataFrame([tuple(seen[k] for k in COUNTS)], ", ".join(f"{k} bigint" for k in COUNTS))
    counts.write.mode("overwrite").json(f"{output}/counts")
    pairs = [(state, shock, seen[f"{state} {shock}"]) for state in labels.STATES for shock in (0, 1)]
    transitions = spark.createDataFrame([p for p in pairs if p[2]], "Annotation string, Shock_next_12h int, rows bigint")
    transitions.write.mode("overwrite").json(f"{output}/transitions")
    sources.write.mode("overwrite").json(f"{output}/sources")


def run(
    spark: SparkSession,
    raw: str,
    dictionaries: str,
    output: str,
    suffix: str = ".csv.gz",
    run_name: str | None = None,
    reports: str | None = None,
    first_row_only: bool = False,
    keep_stages: bool = False,
    buckets: int | None = None,
    **options,
) -> Stages:
    """``options`` go to ``final_dataset``. With ``keep_stages`` the stages of a
    named run stay, so that a later run by that name does over only what its
    options or inputs change."""
    stages = Stages(spark, run_name, buckets=buckets)
    tables = to_parquet(read_raw_observed(spark, raw, suffix), stages)
    names = {f: read_dictionary(spark, f"{dictionaries}/{file}") for f, file in DICTIONARY_FILES.items()}
    listed = spark.read.option("header", True).csv(f"{dictionaries}/suspected_infection.csv")
    codes = infection_prefixes(listed.withColumn("position", file_position()), first_row_only)
    final, seen = observe_final(final_dataset(tables, names, codes, stages=stages, **options))
    final.write.mode("overwrite" if keep_stages else "errorifexists").parquet(output)
    if reports:
        write_reports(tables["patient"], seen.get, source_report(spark, stages), reports)
    if not keep_stages:
        stages.remove()
    return stages


def _outliers(low: float, high: float, impute: bool, on: bool) -> Outliers | None:
    return Outliers(low, high, impute) if on else None


def parse(args: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="bedhour.plans.run")
    p.add_argument("raw")
    p.add_argument("dictionaries")
    p.add_argument("output")
    p.add_argument("--suffix", default=".csv.gz")
    p.add_argument("--run", help="name of the run; a stopped run of that name goes on")
    p.add_argument("--keep-stages", action="store_true", help="keep the stages of a named run for the next one, and write OUTPUT over")
    p.add_argument("--buckets", type=int, help="write stages that are joined by stay in so many buckets")
    p.add_argument("--reports", help="folder for cohort figures, counts and transitions")
    p.add_argument("--mode", choices=sorted(MODES), default="corrected")
    p.add_argument("--min-hours", type=int, default=24)
    p.add_argument("--required", nargs="*", help="labels every stay must have")
    p.add_argument("--first-infection-row", action="store_true", help="only the first row of each code version counts")
    for family, on in (("chart", False), ("lab", True)):
        p.add_argument(f"--clean-{family}", action=argparse.BooleanOptionalAction, default=on)
        p.add_argument(f"--{family}-percentiles", nargs=2, type=float, default=(2, 98), metavar=("LOW", "HIGH"))
        p.add_argument(f"--{family}-impute", action="store_true", help="move outliers onto the bound")
    return p.parse_args(args)


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> None:
    a = parse(args)
    run(
        spark or build_session(),
        a.raw,
        a.dictionaries,
        a.output,
        a.suffix,
        a.run,
        a.reports,
        a.first_infection_row,
        a.keep_stages,
        a.buckets,
        mode=a.mode,
        min_hours=a.min_hours,
        required=a.required,
        clean_chart=_outliers(*a.chart_percentiles, a.chart_impute, a.clean_chart),
        clean_lab=_outliers(*a.lab_percentiles, a.lab_impute, a.clean_lab),
    )


if __name__ == "__main__":
    main()
