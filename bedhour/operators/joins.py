"""Equi joins of large fact tables with smaller keyed tables.

A stay or a label may own a third of all rows, so a plain shuffle join on that
key can put a third of the work into one task. Three ways avoid it:

* the keyed side is under the session's broadcast limit, by Catalyst's estimate
  or by the bytes of the stage it was written to: it is broadcast;
* both sides are stages in the same number of buckets of the key: they are joined
  bucket by bucket, without a shuffle, and hot keys apart;
* otherwise the rows of hot keys (more than one task should have) are dealt to
  as many salts as they make portions, and only their rows of the keyed side are
  repeated, once per salt. All other keys are joined as they are.

Which keys are hot is known from the stages the fact rows come from: each was
given a mergeable sketch of its frequent keys while it was written, so one pass
serves every join. Rows of other origin are sketched by a subquery of the join
itself. No job runs while a plan is built, but for writing small keyed tables.

Adaptive execution may split a partition further, from the real shuffle sizes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources import buckets_of, frequent_keys, frequent_keys_of, stored_bytes, write_stage

ROWS_PER_TASK = 1_000_000


def broadcast_limit(df: DataFrame) -> int:
    return df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


def fits_broadcast(df: DataFrame) -> bool:
    """True when Catalyst's estimate is under the session's broadcast limit."""
    return stored_bytes(df) <= broadcast_limit(df)


def _portions(rows: int, rows_per_task: int) -> int:
    return -(-rows // rows_per_task)


def hot_keys(facts: DataFrame, on: list[str], rows_per_task: int = ROWS_PER_TASK) -> Column | None:
    """Map from the hash of each hot key to the number of portions its rows make,
    or None if it is known that no key is hot."""
    known = frequent_keys_of(facts, on)
    if known is not None:
        hot = {k: _portions(n, rows_per_task) for k, n in known.items() if n > rows_per_task}
        entries = [F.lit(x) for k, n in hot.items() for x in (F.lit(k).cast("long"), F.lit(n))]
        return F.create_map(*entries) if hot else None
    sketch = facts.agg(frequent_keys(on).alias("top")).select(
        F.map_from_entries(
            F.transform(
                F.filter("top", lambda t: t["count"] > rows_per_task),
                lambda t: F.struct(t["item"], F.ceil(t["count"] / rows_per_task).cast("int")),
            )
        )
    )
    return sketch.scalar()


def salted_join(
    facts: DataFrame,
    keyed: DataFrame,
    on: list[str],
    how: str = "inner",
    rows_per_task: int = ROWS_PER_TASK,
    spread: Column | None = None,
    equal_rows: bool = False,
) -> DataFrame:
    """Join with hot keys spread over salts. ``how``: inner, left, left_semi or
    left_anti; every fact row meets all keyed rows of its key, as each salt of a
    hot key has a full copy of them.

    ``spread`` tells rows of a key apart; it must give a row the same value
    again when a task is repeated. By default it is the row's content; where many
    rows may be equal in all columns, ``equal_rows`` counts them first and gives
    them back after the join, so they are one row in between.
    """
    if equal_rows:
        counted = facts.groupBy(*[F.col(f"`{c}`") for c in facts.columns]).agg(F.count(F.lit(1)).alias("_copies"))
        joined = salted_join(counted, keyed, on, how, rows_per_task, spread)
        return joined.withColumn("_copies", F.explode(F.sequence(F.lit(1).cast("long"), "_copies"))).drop("_copies")
    hot = hot_keys(facts, on, rows_per_task)
    if hot is None:
        return facts.join(keyed, on, how)
    key = F.xxhash64(*[F.col(f"`{c}`").cast(facts.schema[c].dataType) for c in on])
    salts = F.coalesce(F.element_at(hot, key), F.lit(1))
    spread = F.xxhash64(*[F.col(f"`{c}`") for c in facts.columns]) if spread is None else spread
    left = facts.withColumn("_salt", F.pmod(spread, salts).cast("int"))
    right = keyed.withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    return left.join(right, [*on, "_salt"], how).drop("_salt")


def bucketed_join(
    facts: DataFrame, keyed: DataFrame, key: str, how: str = "inner", rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Join of two tables in buckets of ``key``; ``keyed`` has few rows per key.
    A bucket is one task, so rows of keys known to be hot are dealt out by their
    content and meet their keyed rows as a broadcast (of at most as many keys as
    a sketch keeps). No other row is shuffled."""
    hot = [k for k, n in (frequent_keys_of(facts, [key]) or {}).items() if n > rows_per_task]
    if not hot:
        return facts.join(keyed, key, how)
    is_hot = F.coalesce(F.xxhash64(key).isin(hot), F.lit(False))
    cold = facts.where(~is_hot).join(keyed.where(~is_hot), key, how)
    dealt = facts.where(is_hot).repartition(F.xxhash64(*[F.col(f"`{c}`") for c in facts.columns]))
    return cold.unionByName(dealt.join(F.broadcast(keyed.where(is_hot)), key, how))


def balanced_join(
    facts: DataFrame,
    keyed: DataFrame,
    on: str | list[str],
    how: str = "inner",
    rows_per_task: int = ROWS_PER_TASK,
    equal_rows: bool = False,
) -> DataFrame:
    """Join that keeps hot keys spread, see the module text."""
    on = [on] if isinstance(on, str) else list(on)
    if fits_broadcast(keyed):
        # Said, so that a small fact table is not the one that is broadcast.
        return facts.join(F.broadcast(keyed), on, how)
    if len(on) == 1 and (found := buckets_of(facts)) and found[1] == on and found == buckets_of(keyed):
        return bucketed_join(facts, keyed, on[0], how, rows_per_task)
    return salted_join(facts, keyed, on, how, rows_per_task, equal_rows=equal_rows)


def lookup_join(
    facts: DataFrame,
    derived: DataFrame,
    on: str | list[str],
    how: str = "inner",
    rows_per_task: int = ROWS_PER_TASK,
    equal_rows: bool = False,
) -> DataFrame:
    """Join with a keyed table that was itself aggregated from large data (one
    row per label, say), where Catalyst's estimate says nothing. Such a table is
    written first; the bytes written decide."""
    on = [on] if isinstance(on, str) else list(on)
    if fits_broadcast(derived):
        return facts.join(F.broadcast(derived), on, how)
    return balanced_join(facts, write_stage(derived), on, how, rows_per_task, equal_rows)


def stays_without(events: DataFrame, stays: DataFrame, key: str) -> DataFrame:
    """Anti join: drop every row of the stays listed in ``stays``."""
    return balanced_join(events, stays.select(key).distinct(), key, "left_anti")


def stays_within(events: DataFrame, stays: DataFrame, key: str) -> DataFrame:
    """Semi join: keep only rows of the stays listed in ``stays``."""
    return balanced_join(events, stays.select(key), key, "left_semi")
