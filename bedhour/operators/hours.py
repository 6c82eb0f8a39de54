"""Hour grid, time blocks and interval expansion.

A *block* is a fixed run of hours of one stay. Windows and pivots run per
(stay, block), so a stay of any length is spread over tasks; what a block needs
from earlier or later hours travels as a few extra rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import STAY

BLOCK_HOURS = 672


def block_of(hour: Column | str, block_hours: int = BLOCK_HOURS) -> Column:
    hour = F.col(hour) if isinstance(hour, str) else hour
    return F.floor(hour / F.lit(float(block_hours))).cast("bigint")


def stay_blocks(
    stays: DataFrame, block_hours: int = BLOCK_HOURS, hash_partitions: bool = True
) -> DataFrame:
    """One row per stay and block, with the columns of ``stays``.

    The rows are hashed over the shuffle partitions, so the hours made from
    them are even whatever the layout of ``stays``.
    """
    blocks = stays.where(F.col("los") > 0).withColumn(
        "block", F.explode(F.sequence(F.lit(0).cast("bigint"), block_of(F.col("los") - 1, block_hours)))
    )
    return blocks.repartition(STAY, "block") if hash_partitions else blocks


def hour_grid(stays: DataFrame, block_hours: int = BLOCK_HOURS) -> DataFrame:
    """Every hour ``0 .. los-1`` of every stay. No array is longer than a block."""
    first = F.col("block") * block_hours
    last = F.least(F.col("los"), first + block_hours) - 1
    return (
        stay_blocks(stays, block_hours)
        .withColumn("hour", F.explode(F.sequence(first, last)))
        .drop("block")
    )


def explode_hours(
    intervals: DataFrame, start: Column, last: Column, block_hours: int = BLOCK_HOURS
) -> DataFrame:
    """A row per hour ``start .. last`` of each interval (none if last < start)."""
    rows = intervals.withColumn("_s", start).withColumn("_e", last).where(F.col("_e") >= F.col("_s"))
    rows = rows.withColumn(
        "_b", F.explode(F.sequence(block_of("_s", block_hours), block_of("_e", block_hours)))
    )
    from_hour = F.greatest(F.col("_s"), F.col("_b") * block_hours)
    to_hour = F.least(F.col("_e"), (F.col("_b") + 1) * block_hours - 1)
    return rows.withColumn("hour", F.explode(F.sequence(from_hour, to_hour))).drop("_s", "_e", "_b")


def next_starts(
    cells: DataFrame, keys: list[str], start: str, block_hours: int = BLOCK_HOURS
) -> DataFrame:
    """Adds ``next_start``: the following start under the same keys.

    The order is taken per block. The first start of each block is also sent to
    the block before it that has rows, as a marker that closes its last row.
    """
    rows = cells.withColumn("_b", block_of(start, block_hours)).withColumn("_mark", F.lit(False))
    heads = rows.groupBy(*keys, "_b").agg(F.min(start).alias(start))
    markers = (
        heads.withColumn("_b", F.lag("_b").over(W.partitionBy(*keys).orderBy("_b")))
        .where(F.col("_b").isNotNull())
        .withColumn("_mark", F.lit(True))
    )
    order = W.partitionBy(*keys, "_b").orderBy(start)
    return (
        rows.unionByName(markers, allowMissingColumns=True)
        .withColumn("next_start", F.lead(start).over(order))
        .where(~F.col("_mark"))
        .drop("_b", "_mark")
    )


def expand_intervals(
    intervals: DataFrame, label: str, values: list[str], block_hours: int = BLOCK_HOURS
) -> DataFrame:
    """Active hours of intervals: ``stay, label, hour`` and the mean ``values``.

    Intervals of one label with the same start are averaged, doses and stops
    alike. At each hour the latest start counts, while its stop lies ahead; a
    later short interval therefore cuts an earlier long one.
    """
    keys = [STAY, label]
    cells = intervals.groupBy(*keys, "start_hour").agg(
        F.avg("stop_hour").alias("_stop"),
        *[F.avg(F.coalesce(F.col(v).cast("double"), F.lit(0.0))).alias(v) for v in values],
    )
    timed = next_starts(cells, keys, "start_hour", block_hours)
    last = F.least(F.ceil("_stop"), F.col("next_start")) - 1
    return explode_hours(timed, F.col("start_hour"), last, block_hours).select(*keys, "hour", *values)
