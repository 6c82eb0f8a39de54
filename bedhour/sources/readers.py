"""Readers for the raw tables (CSV with header, gzipped or not, or Parquet)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import nan_to_null
from .schemas import RAW_SCHEMAS

# Minutes from admission beyond which a time cannot belong to the stay: ten years.
LONGEST_STAY = 10 * 366 * 24 * 60


def _cast(raw: DataFrame, field: T.StructField) -> Column:
    """A column by its name in the header, with its fixed type or null."""
    present = {name.lower(): name for name in raw.columns}
    return F.col("`" + present[field.name.lower()] + "`").try_cast(field.dataType.simpleString())


def _typed(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """Named columns with the fixed types; NaN is read as missing."""
    out = []
    for field in schema.fields:
        c = _cast(raw, field)
        out.append((nan_to_null(c) if isinstance(field.dataType, T.DoubleType) else c).alias(field.name))
    return raw.select(*out)


def _open(spark: SparkSession, path: str) -> DataFrame:
    if path.rstrip("/").endswith(".parquet"):
        return spark.read.parquet(path)
    return spark.read.option("header", True).option("escape", '"').csv(path)


def read_table(spark: SparkSession, path: str, table: str) -> DataFrame:
    """One raw table by its path.

    CSV columns are taken by header name, so a file may hold more columns in
    any order; only the named ones are parsed. A gzipped CSV cannot be split,
    but a folder of them is read by as many tasks; at scale, convert it once
    with ``read_table(...).write.parquet``.
    """
    return _typed(_open(spark, path), T.StructType.fromDDL(RAW_SCHEMAS[table]))


def read_observed(spark: SparkSession, path: str, table: str) -> tuple[DataFrame, Observation]:
    """``read_table``, and an observation of the first job that reads it whole:
    ``read`` rows, of how many a column could not be read as its type
    (``bad <column>``), and how many hold a time outside ``LONGEST_STAY`` minutes
    (``far <column>``). Nothing is dropped; such values were always null."""
    raw = _open(spark, path)
    counts = [F.count(F.lit(1)).alias("read")]
    for field in T.StructType.fromDDL(RAW_SCHEMAS[table]).fields:
        if isinstance(field.dataType, T.StringType):
            continue
        given = _cast(raw, T.StructField(field.name, T.StringType()))
        cast = _cast(raw, field)
        counts.append(F.count_if(given.isNotNull() & cast.isNull()).alias(f"bad {field.name}"))
        if field.name.endswith("offset"):
            counts.append(F.count_if(F.abs(cast) > LONGEST_STAY).alias(f"far {field.name}"))
    seen = Observation(f"read {table}")
    return _typed(raw.observe(seen, *counts), T.StructType.fromDDL(RAW_SCHEMAS[table])), seen


def read_raw(spark: SparkSession, root: str, suffix: str = ".csv.gz") -> dict[str, DataFrame]:
    """All raw tables under ``root``, named ``<table><suffix>``."""
    return {t: read_table(spark, f"{root.rstrip('/')}/{t}{suffix}", t) for t in RAW_SCHEMAS}


def read_raw_observed(
    spark: SparkSession, root: str, suffix: str = ".csv.gz"
) -> dict[str, tuple[DataFrame, Observation]]:
    """``read_raw`` with an observation of each table."""
    return {t: read_observed(spark, f"{root.rstrip('/')}/{t}{suffix}", t) for t in RAW_SCHEMAS}


def file_position() -> Column:
    """Order of rows over several files: by file name, then by place in the file.

    Spark reads a file in blocks and gives each to one task, so the place is the
    block's start and the row's number in the task (``monotonically_increasing_id``
    rises inside a task, whatever blocks it holds)."""
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """Label dictionary ``itemstring, altername``; ``position`` tells the order,
    because the last entry of a repeated label wins. It is the column of that
    name, or else the place of the row: file name, block, row in the block."""
    raw = spark.read.option("header", True).option("escape", '"').csv(path)
    position = F.col("position").cast("bigint") if "position" in raw.columns else file_position()
    return raw.select("itemstring", "altername", position.alias("position"))
