"""Operator 4: URL rules, and exact list membership by a cascade of Bloom filters.

The cascade answers for the corpus's complete universe of hosts. Level 0 holds
the listed hosts; level 1 holds the unlisted hosts level 0 takes for listed;
level 2 the listed hosts that level 1 takes for unlisted; and so on until a
level makes no mistake. A host is listed if the first level that rejects it is
odd, or if none rejects it and the number of levels is odd. For every host of
the universe this is exact, and no join is needed: the cascade is a few bits per
listed host.

Levels are built by Spark: keys set bits, bits are or-ed per 64-bit word. Only
the list and its mistakes are encoded, so the size is bounded by the list, not
by the corpus; a list whose cascade is over ``MOST_BYTES`` is an error.

Rules are (host, path) pairs. A rule fits its host and all subdomains if the
url's path starts with the rule's; the longest host wins, then the longest path.

Defined results: a null url, or one without ``://``, has an empty host and path
and is judged like any other, so it is allowed unless the empty host is listed;
a listed host outside the universe changes nothing; rows stay as they are,
repeated rows and null ids included; further columns are ignored; a url of any
length is judged whole; no pages give no rows, an empty list blocks nothing.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import MIX_1, Stage, ascii_lower, in_tasks, mix

HASHES = 3
MOST_BYTES = 32 << 20
MOST_LEVELS = 64

# Host and path of each rule, and what it says.
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return ascii_lower(rest)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_column(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """The rule that fits, as ``host/path``, and its verdict; else null."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    # Shortest first, so that the longest one is asked last and wins.
    for name, start, says in sorted(rules, key=lambda r: (len(r[0]), len(r[1]))):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        rule = F.when(fits, F.lit(name + start)).otherwise(rule)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


@dataclass(frozen=True)
class Bloom:
    seed: int
    bits: int
    words: np.ndarray  # uint64


def positions(key: np.ndarray, seed: int, bits: int) -> list[np.ndarray]:
    """Bit positions of 64-bit keys. Each level mixes the key anew, so two keys
    that meet at one level part at the next."""
    own = mix(key + np.uint64((seed + 1) * int(MIX_1) % (1 << 64)))
    first, second = own & np.uint64(0x7FFFFFFF), own >> np.uint64(33) | np.uint64(1)
    return [((first + second * np.uint64(i)) % np.uint64(bits)).astype(np.int64) for i in range(HASHES)]


def passes(bloom: Bloom, key: np.ndarray) -> np.ndarray:
    ok = np.ones(len(key), bool)
    for at in positions(key, bloom.seed, bloom.bits):
        ok &= (bloom.words[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)).astype(bool)
    return ok


def build_level(keys: DataFrame, seed: int, bits: int) -> Bloom:
    """Bits of all ``key`` values: a task sets those of its keys, and Spark ors
    them per 64-bit word. One row per word comes back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            at = np.unique(np.concatenate(positions(key, seed, bits)))
            word, first = np.unique(at >> 6, return_index=True)
            mask = np.uint64(1) << (at & 63).astype(np.uint64)
            ored = np.bitwise_or.reduceat(mask, first) if len(mask) else mask
            yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(ored.view(np.int64))], ["word", "mask"])

    set_bits = keys.select("key").transform(in_tasks, run, "word long, mask long")
    words = set_bits.groupBy("word").agg(F.bit_or("mask").alias("mask")).toPandas()
    table = np.zeros((bits + 63) // 64, np.uint64)
    table[words["word"].to_numpy(np.int64)] = words["mask"].to_numpy(np.int64).view(np.uint64)
    return Bloom(seed, bits, table)


def cascade(universe: DataFrame, listed: DataFrame, most_bytes: int = MOST_BYTES, rate: float = 0.5) -> list[Bloom]:
    """Levels for the listed ones among the distinct ``key`` values of
    ``universe``. The first level is sized so that about as many unlisted keys
    pass it as are listed; the later ones let half pass."""
    inside = Stage(listed.select("key").distinct().join(universe.select("key").distinct(), "key", "left_semi"), "url-listed")
    outside = Stage(universe.select("key").distinct().join(inside.df, "key", "left_anti"), "url-unlisted")
    encode, others = inside, outside
    levels: list[Bloom] = []
    total = 0
    while n := encode.df.count():
        against = others.df.count()
        wrong = rate if levels else min(rate, n / max(against, 1))
        # Share of set bits at which HASHES of them are all set with that rate.
        bits = max(64, math.ceil(-HASHES * n / math.log(1 - wrong ** (1 / HASHES))))
        total += bits // 8
        if total > most_bytes:
            raise ValueError(f"the cascade takes over {most_bytes} bytes; split the list")
        if len(levels) == MOST_LEVELS:
            raise ValueError("a listed and an unlisted host share a key")
        bloom = build_level(encode.df, len(levels), bits)
        levels.append(bloom)
        keys = others.df.transform(in_tasks, _passing(bloom), "key long")
        mistaken = Stage(keys, "url-level")
        others.drop()
        encode, others = mistaken, encode
    encode.drop()
    others.drop()
    return levels


def _passing(bloom: Bloom):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(key[passes(bloom, key)].view(np.int64))], ["key"])

    return run


def member(levels: list[Bloom], key: np.ndarray) -> np.ndarray:
    """Whether each key of the universe is listed."""
    listed = np.zeros(len(key), bool)
    undecided = np.arange(len(key))
    for number, bloom in enumerate(levels):
        ok = passes(bloom, key[undecided])
        listed[undecided[~ok]] = number % 2 == 1
        undecided = undecided[ok]
    listed[undecided] = len(levels) % 2 == 1
    return listed


def host_key(host: Column) -> Column:
    """64-bit key of a host. Two hosts of one key would be taken for the same."""
    return F.xxhash64(host)


def judge_urls(
    pages: DataFrame, listed_hosts: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES
) -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every row. ``listed_hosts`` has
    a column ``host``; its hosts are blocked where no rule says otherwise."""
    url = F.col("url").cast("string")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    universe = rows.select(host_key(F.col("host")).alias("key"))
    levels = cascade(universe, listed_hosts.select(host_key(F.col("host")).alias("key")))
    shared = pages.sparkSession.sparkContext.broadcast(levels)
    rule, verdict = rule_column(F.col("host"), F.col("path"), rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(member(shared.value, key))],
                ["page_id", "host", "path", "rule", "verdict", "listed"],
            )

    ruled = rows.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("verdict"), host_key(F.col("host")).alias("key"))
    told = ruled.transform(in_tasks, run, "page_id long, host string, path string, rule string, verdict string, listed boolean")
    by_list = F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow"))
    return told.select("page_id", "host", "path", "rule", F.coalesce("verdict", by_list).alias("verdict"))
