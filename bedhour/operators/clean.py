"""Numeric coercion and percentile outlier handling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import to_number
from .joins import lookup_join

# Bins per doubling of the value, the number that no bin of a finite value
# reaches, and parts of a bin.
PER_DOUBLING = 256
BEYOND = PER_DOUBLING * 1_100
PARTS = 1 << 22


def coerce_numeric(events: DataFrame, value: str) -> DataFrame:
    """Rows whose value is a number, with the value as a double."""
    return events.withColumn(value, to_number(F.col(value).cast("string"))).where(
        F.col(value).isNotNull()
    )


def _bin(v: Column) -> Column:
    """Whole number that never falls as the value rises: ``PER_DOUBLING`` bins
    for each power of two, mirrored for negative values; infinite values and NaN
    (above all others) have bins of their own."""
    size = F.abs(v)
    finite = F.floor(F.log2(size) * PER_DOUBLING).cast("long") + BEYOND
    place = F.when(v == 0, 0).when(size < float("inf"), finite).otherwise(2 * BEYOND)
    return F.when(F.isnan(v), F.lit(3 * BEYOND)).when(v < 0, -place).otherwise(place).cast("long")


def _holding(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Of the bins under the same keys, those that hold the ranks wanted: rows of
    ``_c`` values each, ``_before`` of them before the first bin. ``_before``
    becomes the number before each bin."""
    upto = F.col("_before") + F.sum("_c").over(W.partitionBy(*keys).orderBy(order))
    counted = rows.withColumn("_upto", upto).withColumn("_before", F.col("_upto") - F.col("_c"))
    below = F.floor("rank")
    return counted.where((F.col("_upto") > below) & (F.col("_before") <= below + 1)).drop("_c", "_upto")


def percentile_bounds(
    events: DataFrame, label: str, value: str, low: float = 2, high: float = 98, parts: int = PARTS
) -> DataFrame:
    """Exact linear-interpolated percentiles per label: ``label, n, lo, hi``.

    A label may hold a third of all rows, so its values are never gathered. A
    first pass counts values per bin, by their leading digits; the bins that hold
    the wanted ranks are a few rows per label. A second pass takes the values in
    those bins, equal ones as a count, and counts them per part of a bin, by the
    following digits; only the values of the part that holds a rank are put in
    order. Every count is combined on the map side.
    """
    rows = events.select(F.col(label).alias("_l"), F.col(value).cast("double").alias("_v")).where(
        F.col("_l").isNotNull() & F.col("_v").isNotNull()
    )
    bins = rows.groupBy("_l", _bin(F.col("_v")).alias("_bin")).agg(
        F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_from"), F.max("_v").alias("_to")
    )
    bins = bins.withColumn("_n", F.sum("_c").over(W.partitionBy("_l"))).withColumn("_before", F.lit(0).cast("long"))
    ranks = [
        F.struct(F.lit(i).alias("i"), ((F.col("_n").cast("double") - 1) * F.lit(p / 100.0)).alias("rank"))
        for i, p in enumerate((low, high))
    ]
    wanted = _holding(bins.select("*", F.inline(F.array(*ranks))), ["_l", "i"], "_bin")
    # At most four bins per label.
    v = F.col("_v")
    hit = lookup_join(rows, wanted, "_l", equal_rows=True).where(v.between(F.col("_from"), F.col("_to")))
    fields = ["i", "_bin", "_n", "rank", "_before", "_from", "_to"]
    inside = hit.groupBy("_l", *fields, "_v").agg(F.count(F.lit(1)).alias("_c"))
    share = F.try_divide(v - F.col("_from"), F.col("_to") - F.col("_from"))
    # A bin without a finite width is one part.
    share = F.when(F.abs(share) <= 1, share).otherwise(F.lit(0.0))
    inside = inside.withColumn("_part", F.least(F.floor(share * parts), F.lit(parts - 1)))
    keys = ["_l", "i", "_bin"]
    sums = inside.groupBy(*keys, "_n", "rank", "_before", "_part").agg(F.sum("_c").alias("_c"))
    narrow = _holding(sums, keys, "_part").select(*keys, "_part", F.col("_before").alias("_first"))

    ordered = W.partitionBy(*keys, "_part").orderBy("_v")
    last = inside.join(narrow, [*keys, "_part"]).withColumn("_upto", F.col("_first") + F.sum("_c").over(ordered))
    below = F.floor("rank")

    def first(i: int, beyond: Column) -> Column:
        return F.min(F.when((F.col("i") == i) & (F.col("_upto") > beyond), F.col("_v")))

    found = last.groupBy("_l").agg(
        F.max("_n").alias("n"),
        *[F.max(F.when(F.col("i") == i, F.col("rank"))).alias(f"_r{i}") for i in (0, 1)],
        *[first(i, below + k).alias(f"_v{i}{k}") for i in (0, 1) for k in (0, 1)],
    )

    def at(i: int) -> Column:
        a, rank = F.col(f"_v{i}0"), F.col(f"_r{i}")
        # At the last rank there is no next value; its weight is 0 there.
        return a + (F.coalesce(f"_v{i}1", a) - a) * (rank - F.floor(rank))

    return found.select(F.col("_l").alias(label), "n", at(0).alias("lo"), at(1).alias("hi"))


def outlier_trim(events: DataFrame, bounds: DataFrame, label: str, value: str) -> DataFrame:
    """Drop rows strictly outside their label's bounds."""
    joined = lookup_join(events, bounds.select(label, "lo", "hi"), label, "left", equal_rows=True)
    inside = (F.col(value) >= F.col("lo")) & (F.col(value) <= F.col("hi"))
    kept = F.col(value).isNotNull() & F.coalesce(inside, F.lit(True))
    return joined.where(kept).select(*events.columns)


def outlier_winsorize(events: DataFrame, bounds: DataFrame, label: str, value: str) -> DataFrame:
    """Move values outside their label's bounds onto the bound."""
    joined = lookup_join(events, bounds.select(label, "lo", "hi"), label, "left", equal_rows=True)
    # Both skip nulls, so a row without a label keeps its value.
    clamped = F.greatest(F.col("lo"), F.least(F.col("hi"), F.col(value)))
    return (
        joined.where(F.col(value).isNotNull()).withColumn(value, clamped).select(*events.columns)
    )


def clean_outliers(
    events: DataFrame, label: str, value: str, low: float = 2, high: float = 98, impute: bool = False
) -> DataFrame:
    """Coerce to numbers, then trim or, with ``impute``, winsorise."""
    rows = coerce_numeric(events, value)
    bounds = percentile_bounds(rows, label, value, low, high)
    return (outlier_winsorize if impute else outlier_trim)(rows, bounds, label, value)
