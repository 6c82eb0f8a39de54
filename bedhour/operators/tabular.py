"""Long hourly events to one wide row per stay and hour.

Shape of the job, whatever the number of families and labels:

1. all families in one stream, averaged per (stay, feature, hour). Rows are
   combined on the map side, so a hot stay or hour shuffles as a few cells;
2. the cells, with one marker row per block, shuffled once to (stay, block).
   Pivot and forward fill run in place over the hours that have cells;
3. each filled row is repeated over the hours up to the next one, which gives
   the full grid without ever shuffling it.

A block starts from what is known before it. Where a stay has several blocks,
the last cell of a feature is sent ahead to the blocks up to its next cell (a
prefix scan over the cells, before the pivot). There it is an ordinary cell of
the hour before the block, and fills like any other.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import STAY
from ..functions import col
from ..session import compiled_methods
from ..sources import Stages, stored_bytes, write_stage
from .hours import BLOCK_HOURS, block_of, stay_blocks
from .joins import lookup_join

SEP = "__"
# Bytes of written cells that one task of the wide shuffle should take.
CELL_BYTES = 16 << 20
# Bytes of hourly rows that one task of it should put in order: they fit its memory.
HOUR_BYTES = 256 << 20


@dataclass(frozen=True)
class Stream:
    """Hourly events of one family.

    ``rows`` holds the stay, ``los``, ``label`` and ``hour`` (for intervals
    ``start_hour`` and ``stop_hour``) plus one column per entry of ``values``,
    which maps an output family to its column. ``kind`` is ``hold`` (forward
    fill, missing until first seen), ``interval`` (value until its stop, else
    0), ``hourly`` (mean of the hour, else 0) or ``flag`` (1 in hours with an
    event, else 0).
    """

    rows: DataFrame
    kind: str
    values: Mapping[str, str]
    label: str = "label"


def _names(df: DataFrame) -> list[str]:
    """Sorted distinct names that become columns: what a plan can hold, the
    driver can. For more names than that there is ``long_table``."""
    return sorted(r[0] for r in df.distinct().collect())


def distinct_labels(df: DataFrame, label: str) -> list[str]:
    return _names(df.where(col(label).isNotNull()).select(col(label)))


def cell_labels(cells: DataFrame, streams: Mapping[str, Stream]) -> dict[str, list[str]]:
    """Labels of every stream, looked up in the cells in one job."""
    found: dict[str, list[str]] = {name: [] for name in streams}
    by_family = {next(iter(s.values)): name for name, s in streams.items()}
    for feature in _names(cells.select("feature")):
        family, _, label = feature.partition(SEP)
        if family in by_family and not label.endswith(f"{SEP}stop"):
            found[by_family[family]].append(label)
    return found


def feature_name(family: str, label: str) -> str:
    return f"{family}{SEP}{label}"


def hourly_mean_pivot(points: DataFrame, label: str, value: str, labels: list[str]) -> DataFrame:
    """Mean per stay, hour and label, one column per label."""
    wide = points.groupBy(STAY, "hour").pivot(label, labels).agg(F.avg(value))
    return wide


def presence_pivot(points: DataFrame, label: str, labels: list[str]) -> DataFrame:
    """1 for a label with any event in the hour, else 0."""
    wide = points.withColumn("_one", F.lit(1)).groupBy(STAY, "hour").pivot(label, labels).agg(F.max("_one"))
    return wide.na.fill(0, labels)


def _long(family_stream: Stream) -> DataFrame:
    """(stay, los, hour, feature, value) rows of one family. Intervals send
    their stop along as a feature of its own, so one average serves all."""
    s = family_stream
    label = col(s.label)
    at = F.col("start_hour") if s.kind == "interval" else F.col("hour")
    entries = []
    for family, source in s.values.items():
        name = F.concat(F.lit(family + SEP), label)
        if s.kind == "flag":
            value = F.lit(1.0)
        elif s.kind == "interval":
            value = F.coalesce(col(source).cast("double"), F.lit(0.0))
        else:
            value = col(source).cast("double")
        entries.append(F.struct(name.alias("feature"), value.alias("value")))
    if s.kind == "interval":
        first = next(iter(s.values))
        stop = F.concat(F.lit(f"{first}{SEP}"), label, F.lit(f"{SEP}stop"))
        entries.append(F.struct(stop.alias("feature"), F.col("stop_hour").cast("double").alias("value")))
    rows = s.rows.where(label.isNotNull())
    return rows.select(STAY, "los", at.alias("hour"), F.inline(F.array(*entries))).where(
        F.col("value").isNotNull()
    )


def hourly_cells(streams: Mapping[str, Stream]) -> DataFrame:
    """Mean value per (stay, feature, hour) over all families, in one shuffle."""
    rows = None
    for stream in streams.values():
        part = _long(stream)
        rows = part if rows is None else rows.unionByName(part)
    # The stay's length is not a key: tests on it stay above the shuffle, which
    # all readers of the cells can then share.
    return rows.groupBy(STAY, "feature", "hour").agg(F.avg("value").alias("value"), F.max("los").alias("los"))


def long_table(streams: Mapping[str, Stream]) -> DataFrame:
    """The table in long form, for more labels than a table has columns: one row
    per stay, hour, family and label with a value. Held values and intervals
    stand once, with the hour up to which they last (``until``, exclusive); the
    other kinds last one hour."""
    cells = hourly_cells(streams)
    family = F.substring_index("feature", SEP, 1)
    of_kind = {f: s.kind for s in streams.values() for f in s.values}
    main = {f: next(iter(s.values)) for s in streams.values() for f in s.values}
    label = F.expr(f"substring(feature, length(substring_index(feature, '{SEP}', 1)) + {1 + len(SEP)})")
    is_stop = F.lit(False)
    for f, kind in of_kind.items():
        if kind == "interval" and main[f] == f:
            is_stop = is_stop | ((family == f) & F.col("feature").endswith(f"{SEP}stop"))
    values = cells.where(~is_stop).select(STAY, "los", "hour", family.alias("family"), label.alias("label"), "value")
    stops = cells.where(is_stop).withColumn("_label", label).select(
        STAY,
        "hour",
        family.alias("_main"),
        F.expr(f"substring(_label, 1, length(_label) - {len(SEP) + 4})").alias("label"),
        F.col("value").alias("_stop"),
    )
    mains = F.create_map(*[F.lit(x) for pair in main.items() for x in pair])
    kinds = F.create_map(*[F.lit(x) for pair in of_kind.items() for x in pair])
    joined = values.withColumn("_main", mains[F.col("family")]).join(stops, [STAY, "hour", "_main", "label"], "left")
    following = F.lead("hour").over(W.partitionBy(STAY, "family", "label").orderBy("hour"))
    kind = kinds[F.col("family")]
    until = (
        F.when(kind == "hold", F.coalesce(following, F.col("los")))
        .when(kind == "interval", F.least(F.ceil("_stop"), F.coalesce(following, F.col("los")), F.col("los")))
        .otherwise(F.col("hour") + 1)
    )
    return joined.select(STAY, "family", "label", "hour", until.cast("bigint").alias("until"), "value").where("until > hour")


def _sent_ahead(
    cells: DataFrame, held: list[str], has: Mapping[str, list[str]], block_hours: int, back: int
) -> DataFrame:
    """Cells ``stay, block, feature, value`` that blocks get from earlier ones:
    the last value of each held feature, for the blocks up to its next value, and
    for every block of the stay which of the ``has`` groups have any value. Cells
    are combined to one per block and feature first, so the window over a stay
    is short however long it is."""
    name = F.col("feature")
    wanted = {*held, *(f for group in has.values() for f in group)}
    # What a block sees of the hours before it are cells of its own.
    known = cells.where(name.isin(sorted(wanted))).withColumn("_in", block_of(F.col("hour") + back, block_hours))
    tails = known.groupBy(STAY, "feature", "_in").agg(
        F.max_by("value", "hour").alias("value"), F.max(block_of(F.col("los") - 1, block_hours)).alias("_last")
    )
    order = W.partitionBy(STAY, "feature").orderBy("_in")
    tails = tails.withColumn("_until", F.least(F.lead("_in").over(order), "_last")).withColumn(
        "_nth", F.row_number().over(order)
    )

    def sent(condition: Column, feature: Column, first: Column, last: Column, value: Column) -> Column:
        return F.when(condition, F.struct(feature.alias("feature"), first.alias("_from"), last.alias("_to"), value.alias("value")))

    ahead = [sent(name.isin(held), name, F.col("_in") + 1, F.col("_until"), F.col("value"))] if held else []
    present = [
        sent((F.col("_nth") == 1) & name.isin(group), F.lit(flag), F.lit(0).cast("long"), F.col("_last"), F.lit(1.0))
        for flag, group in has.items()
        if group
    ]
    ranges = tails.select(STAY, F.inline(F.array_compact(F.array(*ahead, *present)))).where(F.col("_to") >= F.col("_from"))
    return ranges.select(STAY, F.explode(F.sequence("_from", "_to")).alias("block"), "feature", "value")


def tabularize(
    stays: DataFrame,
    streams: Mapping[str, Stream],
    labels: Mapping[str, list[str]] | None = None,
    static: list[str] | None = None,
    block_hours: int = BLOCK_HOURS,
    halo: tuple[int, int] = (0, 0),
    store_cells: bool | Stages = False,
) -> DataFrame:
    """Wide hourly table: exactly ``los`` rows per stay, hours ``0 .. los-1``.

    ``labels`` names the columns of each stream; without it they are looked up
    first. ``store_cells`` writes the hourly cells to the shared folder (to the
    run's stages if these are given), so the label lookup and the table itself
    read the raw events once. ``static`` stay
    columns are repeated on each hour. With a ``halo``
    of (back, ahead) hours each block also holds copies of its neighbours'
    nearest rows, marked ``halo``, for windows that look past its edges; the
    caller drops them. The result keeps ``block`` and is hashed by (stay, block).
    """
    back, ahead = halo
    static = static or []
    cells = hourly_cells(streams)
    if store_cells:
        cells = store_cells.write(cells, "cells") if isinstance(store_cells, Stages) else write_stage(cells)
    if labels is None:
        labels = cell_labels(cells, streams)
    columns, held, outputs, has = _plan_columns(streams, labels)

    # Hours of a block's rows: its own and the halo. The marker, and what was
    # sent ahead, stand one hour before.
    lower = F.greatest(F.lit(0), F.col("block") * block_hours - back)
    upper = F.least(F.col("los"), (F.col("block") + 1) * block_hours + ahead) - 1
    blocks = stay_blocks(stays.select(STAY, "los", *static), block_hours, hash_partitions=False)
    before = (lower - 1).alias("hour")
    markers = blocks.select(
        STAY, "block", before, F.lit(None).cast("string").alias("feature"), F.lit(None).cast("double").alias("value")
    )
    first_block = F.greatest(F.lit(0).cast("bigint"), block_of(F.col("hour") - ahead, block_hours))
    last_block = F.least(block_of(F.col("los") - 1, block_hours), block_of(F.col("hour") + back, block_hours))
    copies = F.explode(F.sequence(first_block, last_block)) if back or ahead else block_of("hour", block_hours)
    rows = markers.unionByName(cells.withColumn("block", copies).select(STAY, "block", "hour", "feature", "value"))
    if held or any(has.values()):
        rows = rows.unionByName(_sent_ahead(cells, held, has, block_hours, back).withColumn("hour", before))

    # The one shuffle that pivot, fill and everything keyed by (stay, block)
    # after it share. The number of partitions follows the written cells and the
    # hours they are repeated over, and is fixed then, as the rows grow afterwards.
    compiled_methods(stays.sparkSession)
    partitions = int(stays.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if store_cells:
        hours = stays.agg(F.sum(F.greatest("los", F.lit(0)))).first()[0] or 0
        row_bytes = 8 * (len(columns) + len(static) + len(outputs))
        partitions = max(partitions, -(-stored_bytes(cells) // CELL_BYTES), -(-int(hours) * row_bytes // HOUR_BYTES))
    rows = rows.repartition(partitions, STAY, "block")
    wide = rows.groupBy(STAY, "block", "hour").pivot("feature", [*columns, *has]).agg(F.first("value"))
    order = W.partitionBy(STAY, "block").orderBy("hour")
    so_far = order.rowsBetween(W.unboundedPreceding, W.currentRow)
    held_set = set(held)
    filled = wide.select(
        STAY,
        "block",
        F.col("hour").alias("_at"),
        F.lead("hour").over(order).alias("_next"),
        *[F.last(col(name), ignorenulls=True).over(so_far).isNotNull().alias(name) for name in has],
        *[(F.last(col(c), ignorenulls=True).over(so_far) if c in held_set else col(c)).alias(c) for c in columns],
    )
    # Both are hashed by (stay, block), and no block outgrows its hours.
    joined = filled.join(blocks, [STAY, "block"])
    first, last = F.greatest(F.col("_at"), lower), F.coalesce(F.col("_next") - 1, upper)
    known = joined.where(first <= last).select(
        STAY, "block", "_at", F.explode(F.sequence(first, last)).alias("hour"), "los", *static, *has, *map(col, columns)
    )
    is_halo = block_of("hour", block_hours) != F.col("block")
    return known.select(
        STAY,
        "block",
        "hour",
        *([is_halo.alias("halo")] if back or ahead else []),
        "los",
        *static,
        *[expr.alias(name) for name, expr in outputs.items()],
    )


def _plan_columns(
    streams: Mapping[str, Stream], labels: Mapping[str, list[str]]
) -> tuple[list[str], list[str], dict[str, Column], dict[str, list[str]]]:
    """Pivot columns, those to forward fill, the output expressions, and the
    column groups whose presence in a stay matters.

    The expressions see a row that starts at ``_at`` and is repeated for each
    ``hour`` up to the next row; a value that is not filled counts at ``_at``.
    """
    columns: list[str] = []
    held: list[str] = []
    outputs: dict[str, Column] = {}
    has: dict[str, list[str]] = {}
    here = F.col("hour") == F.col("_at")
    zero = F.lit(0.0)
    for name, s in streams.items():
        main = next(iter(s.values))
        if s.kind == "hold":
            has[f"_has_{name}"] = [feature_name(main, lab) for lab in labels[name]]
        for family in s.values:
            for lab in labels[name]:
                out = feature_name(family, lab)
                columns.append(out)
                value = col(out)
                if s.kind == "interval":
                    stop = f"{feature_name(main, lab)}{SEP}stop"
                    if family == main:
                        columns.append(stop)
                        held.append(stop)
                    held.append(out)
                    outputs[out] = F.when(col(stop) > F.col("hour"), value).otherwise(zero)
                elif s.kind in ("hourly", "flag"):
                    outputs[out] = F.when(here & value.isNotNull(), value).otherwise(zero)
                elif family == "chart" and lab == "ECMO":
                    has["_has_ECMO"] = [out]
                    charted = F.when(col("_has_ECMO"), (here & value.isNotNull()).cast("double"))
                    outputs[out] = F.when(col(f"_has_{name}"), charted).otherwise(zero)
                elif family == "chart" and lab == "MAP":
                    systolic, diastolic = (
                        col(feature_name(family, p)) if p in labels[name] else F.lit(None).cast("double")
                        for p in ("ABPs", "ABPd")
                    )
                    derived = F.coalesce(F.when(here, value), (systolic + 2 * diastolic) / 3)
                    outputs[out] = F.when(col(f"_has_{name}"), derived).otherwise(zero)
                else:
                    held.append(out)
                    # A stay without any row of the family has zeros throughout.
                    outputs[out] = F.when(col(f"_has_{name}"), value).otherwise(zero)
    return columns, held, outputs, has


def tabular_output(wide: DataFrame) -> DataFrame:
    """Drop the bookkeeping columns and halo rows of ``tabularize``."""
    if "halo" in wide.columns:
        wide = wide.where(~F.col("halo"))
    return wide.drop("block", "halo", "los")


def label_codes(df: DataFrame, column: str) -> DataFrame:
    """Code of each category: 0.. in sorted order, as ``column, code``.

    The categories are dealt to ranges by Spark's own sampling and written with
    their range; a category's rank is its place in its range plus the sizes of
    the ranges before, of which there are as many as shuffle partitions.
    """
    values = df.where(F.col(column).isNotNull()).select(column).distinct()
    ranged = write_stage(values.repartitionByRange(column).withColumn("_g", F.spark_partition_id()))
    sizes = ranged.groupBy("_g").agg(F.count(F.lit(1)).alias("_n"))
    shift = F.sum("_n").over(W.orderBy("_g").rowsBetween(W.unboundedPreceding, -1))
    offsets = sizes.select("_g", F.coalesce(shift, F.lit(0)).alias("_before"))
    within = F.row_number().over(W.partitionBy("_g").orderBy(column)) - 1
    return (
        ranged.withColumn("_r", within)
        .join(offsets, "_g")
        .select(column, (F.col("_r") + F.col("_before")).cast("int").alias("code"))
    )


def encode_labels(df: DataFrame, columns: list[str]) -> DataFrame:
    """Replace category columns by their codes; a missing category stays null."""
    out = df
    for c in columns:
        codes = label_codes(df, c)
        out = lookup_join(out, codes, c, "left").drop(c).withColumnRenamed("code", c)
    return out.select(*df.columns)
