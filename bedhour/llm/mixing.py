"""Operator 5: mix sources to target weights, DataFrame functions only.

A source's target is its weight's share of ``total * fraction`` words, but at
most ``max_epochs`` times its own size; what a capped source cannot take goes to
the others in proportion to their weights, until none is above its cap. The
fixed point of those rounds is found in one pass over the sources in order of
``cap / weight``: a source is capped exactly if, with the sources before it
capped, its share of the rest is above its cap.

A target is met by ``target // size`` copies of every document and a seeded
sample for the rest: documents stand in the order of a seeded hash, and those
that begin (by their middle) before the rest's length are taken once more. The
place where that happens is found by summing per hash bucket first, so only one
bucket of a source is ever ordered, however large the source is.

Defined results: a null or empty text has size 0 and is taken 0 words (its
copies still count as the others' do); null is a source of its own, after all
others; rows with the same id and text are ordered alike and taken or left
together, null ids by their text's hash; a source of size 0 has target 0; no
rows give no rows; further columns pass through ``copies`` unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Stage, word_count

HASH_BUCKETS = 1 << 12
CYCLE = (5, 2, 1)


def cycled_weights(sources: DataFrame, cycle: tuple[int, ...] = CYCLE) -> DataFrame:
    """Weights by place in code-point order, null last. One row per source."""
    place = F.row_number().over(W.orderBy(F.col("_source").asc_nulls_last())) - 1
    weights = F.array(*[F.lit(w) for w in cycle])
    return sources.withColumn("_weight", F.get(weights, F.pmod(place, F.lit(len(cycle)))))


def water_filling(sources: DataFrame, max_epochs: int = 3, fraction: float = 1.0) -> DataFrame:
    """``_target`` per source, from ``_size`` (long) and ``_weight``. Sums are
    exact integers, so the order of rows does not change a target."""
    caps = sources.withColumn("_cap", F.col("_size") * max_epochs)
    order = W.orderBy(F.col("_cap") / F.col("_weight"), "_cap", F.col("_source").asc_nulls_last())
    all_rows = W.partitionBy()
    before = order.rowsBetween(W.unboundedPreceding, -1)
    rest = order.rowsBetween(W.currentRow, W.unboundedFollowing)
    left = (F.sum("_size").over(all_rows) * F.lit(float(fraction))) - F.coalesce(F.sum("_cap").over(before), F.lit(0))
    level = left / F.sum("_weight").over(rest)
    levels = caps.withColumn("_level", level).withColumn("_open", F.col("_cap") > F.col("_level") * F.col("_weight"))
    # The first open source's level holds for it and all after it.
    water = F.max(F.when(F.col("_open"), F.col("_level"))).over(all_rows)
    return levels.withColumn(
        "_target", F.when(F.col("_open"), water * F.col("_weight")).otherwise(F.col("_cap").cast("double"))
    ).drop("_cap", "_level", "_open")


def mix(
    docs: DataFrame,
    seed: int = 17,
    max_epochs: int = 3,
    fraction: float = 1.0,
    cycle: tuple[int, ...] = CYCLE,
    size: Column | None = None,
) -> DataFrame:
    """Every row of ``docs`` (``doc_id, text, source``) as ``row``, with
    ``doc_id, size, source_size, target`` and ``copies``, the number of times
    the mix holds it."""
    size = word_count(F.col("text")) if size is None else size
    order = F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text"))
    rows = docs.select(
        F.struct("*").alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("_source"),
        size.cast("long").alias("size"),
        order.alias("_order"),
        F.pmod(F.shiftright(order, 40), F.lit(HASH_BUCKETS)).cast("int").alias("_bucket"),
    )
    sizes = Stage(
        rows.groupBy("_source", "_bucket", "_order").agg(F.sum("size").alias("_size")), "mix-sizes"
    )
    sources = sizes.df.groupBy("_source").agg(F.sum("_size").alias("_size"))
    epochs = F.floor(F.try_divide("_target", "_size"))
    plan = Stage(
        water_filling(cycled_weights(sources, cycle), max_epochs, fraction).select(
            F.col("_source").alias("_key"),
            "_size",
            "_target",
            F.coalesce(epochs, F.lit(0)).cast("int").alias("_whole"),
            F.coalesce(F.col("_target") - epochs * F.col("_size"), F.lit(0.0)).alias("_part"),
        ),
        "mix-plan",
    )
    same_source = F.col("_source").eqNullSafe(F.col("_key"))

    # Words before each bucket; the bucket that holds the cut is the only one put in order.
    running = W.partitionBy("_source").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    buckets = sizes.df.groupBy("_source", "_bucket").agg(F.sum("_size").alias("_words"))
    buckets = buckets.withColumn("_before", F.coalesce(F.sum("_words").over(running), F.lit(0)))
    cuts = Stage(
        buckets.join(plan.small().drop("_size"), same_source)
        .where((F.col("_before") < F.col("_part")) & (F.col("_before") + F.col("_words") >= F.col("_part")))
        .select("_key", F.col("_bucket").alias("_cut"), "_before", "_part"),
        "mix-cuts",
    )
    earlier = W.partitionBy("_source").orderBy("_order").rowsBetween(W.unboundedPreceding, -1)
    begun = F.col("_before") + F.coalesce(F.sum("_size").over(earlier), F.lit(0))
    limits = (
        sizes.df.join(cuts.small(), same_source & (F.col("_bucket") == F.col("_cut")))
        .withColumn("_middle", begun + F.col("_size") / 2)
        .groupBy("_key", "_cut")
        .agg(F.max(F.when(F.col("_middle") <= F.col("_part"), F.col("_order"))).alias("_last"))
        .withColumnRenamed("_key", "_limit_key")
    )
    final = Stage(
        plan.df.join(limits, F.col("_key").eqNullSafe(F.col("_limit_key")), "left").select(
            "_key", F.col("_size").alias("source_size"), F.col("_target").alias("target"), "_whole", "_cut", "_last"
        ),
        "mix-limits",
    )
    for stage in (sizes, plan, cuts):
        stage.drop()
    once_more = (F.col("_bucket") < F.col("_cut")) | (
        (F.col("_bucket") == F.col("_cut")) & (F.col("_order") <= F.col("_last"))
    )
    return rows.join(final.small(), same_source, "left").select(
        "row",
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("_whole") + F.coalesce(once_more, F.lit(False)).cast("int")).alias("copies"),
    )


def copies(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: the columns of ``docs``, each row as often as it is taken."""
    mixed = mix(docs, **options).where(F.col("copies") > 0)
    return mixed.select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).select("row.*")
