"""What a written table was made from, and what was seen while it was written.

The fingerprint of a DataFrame covers its analysed plan (so every option that
reaches a column, a filter or a join), the files it reads with their sizes and
times, the code of this package, and the session settings that change results.
A table that was itself written here stands for what it was made from, so a
change anywhere reaches all that depends on it, and nothing else.

Observed values are aggregates taken by the write itself (``DataFrame.observe``):
row counts, values that failed their cast, and the most frequent keys.
"""

from __future__ import annotations

import hashlib
import importlib.resources
import json
import re
from collections.abc import Sequence
from functools import cache

from pyspark import __version__ as spark_version
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings that change what an expression gives.
SETTINGS = ("spark.sql.session.timeZone", "spark.sql.ansi.enabled", "spark.sql.caseSensitive")
TEXT_FIELDS = "spark.sql.debug.maxToStringFields"
# The sketch of frequent keys: how many are kept, and how many are counted.
FREQUENT, TRACKED = 1_000, 65_536
CODE = ("constants.py", "functions", "operators", "plans", "sources")

# Tables written in this session, by their folder: what they were made from
# (a DataFrame until someone asks, then its fingerprint), and what was observed.
# DataFrames are kept only once some run has a name.
_made: dict[str, DataFrame | str] = {}
_tracking = False
_observed: dict[str, dict] = {}


def digest(*parts: str) -> str:
    return hashlib.sha256("\0".join(parts).encode()).hexdigest()


@cache
def code_version() -> str:
    """Digest of the package's modules, also when they come from an archive."""
    root = importlib.resources.files(__package__.partition(".")[0])

    def modules(at, name: str):
        if at.is_dir():
            for child in sorted(at.iterdir(), key=lambda c: c.name):
                yield from modules(child, f"{name}/{child.name}")
        elif name.endswith(".py"):
            yield f"{name}\0{at.read_text(encoding='utf-8')}"

    return digest(*(text for name in CODE for text in modules(root.joinpath(name), name)))


def plan_text(df: DataFrame) -> str:
    """The analysed plan, with expression numbers in order of appearance."""
    spark = df.sparkSession
    before = spark.conf.get(TEXT_FIELDS)
    spark.conf.set(TEXT_FIELDS, str(2**31 - 1))
    try:
        text = df._jdf.queryExecution().analyzed().toString()
    finally:
        spark.conf.set(TEXT_FIELDS, before)
    numbers: dict[str, str] = {}
    text = re.sub(r"#(\d+)", lambda m: "#" + numbers.setdefault(m.group(1), str(len(numbers))), text)
    # The last argument of an observation numbers the DataFrame.
    return re.sub(r"(CollectMetrics .*), \d+$", r"\1", text, flags=re.MULTILINE)


def _leaves(df: DataFrame) -> list:
    found = df._jdf.queryExecution().analyzed().collectLeaves()
    return [found.apply(i) for i in range(found.size())]


def _roots(leaf) -> list[str] | None:
    """Folders or files a leaf of a plan reads; None if it reads none."""
    if leaf.getClass().getSimpleName() != "LogicalRelation":
        return None
    relation = leaf.relation()
    if relation.getClass().getSimpleName() != "HadoopFsRelation":
        return None
    paths = relation.location().rootPaths()
    return [paths.apply(i).toString() for i in range(paths.size())]


def _plain(path: str) -> str:
    return re.sub(r"^file:/+", "/", path.rstrip("/"))


def files_digest(spark: SparkSession, roots: list[str]) -> str:
    """Names, sizes and times of all files under the roots. They are listed and
    added up by Spark; no content is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(roots)
    each = F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")
    n, size, total = files.agg(F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0)), F.sum(each)).first()
    return digest(*sorted(roots), str(n), str(size), str(total))


def _rows_digest(spark: SparkSession, leaf) -> str:
    """A table held in memory, by its rows."""
    jdf = spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(spark._jsparkSession, leaf)
    rows = DataFrame(jdf, spark)
    each = F.xxhash64(*[F.to_json(F.struct(F.col(f"`{c}`"))) for c in rows.columns]).cast("decimal(38,0)")
    n, total = rows.agg(F.count(F.lit(1)), F.sum(each)).first()
    return digest(str(n), str(total))


def parts_of(df: DataFrame, seen: dict[tuple[str, ...], str] | None = None) -> dict[str, str]:
    """Digests of all that decides a table, by kind. ``seen`` keeps the digests
    of inputs that several tables read."""
    spark = df.sparkSession
    seen = {} if seen is None else seen
    inputs = []
    for leaf in _leaves(df):
        roots = _roots(leaf)
        if roots is None:
            kind = leaf.getClass().getSimpleName()
            inputs.append(_rows_digest(spark, leaf) if kind in ("LocalRelation", "LogicalRDD") else leaf.toString())
        elif len(roots) == 1 and _plain(roots[0]) in _made:
            inputs.append(made_from(roots[0], seen))
        else:
            if tuple(roots) not in seen:
                seen[tuple(roots)] = files_digest(spark, roots)
            inputs.append(digest(seen[tuple(roots)], str(leaf.relation().options())))
    return {
        "code": digest(spark_version, code_version()),
        "settings": digest(*(str(spark.conf.get(s)) for s in SETTINGS)),
        "plan": digest(plan_text(df), df.schema.json()),
        "inputs": digest(*inputs),
    }


def fingerprint(parts: dict[str, str]) -> str:
    return digest(json.dumps(parts, sort_keys=True))


def track() -> None:
    """From now on, know what unnamed stages are made from."""
    global _tracking
    _tracking = True


def remember(path: str, made: DataFrame | str, observed: dict | None = None) -> None:
    if _tracking:
        _made[_plain(path)] = made
    if observed:
        _observed[_plain(path)] = observed


def made_from(path: str, seen: dict[tuple[str, ...], str] | None = None) -> str:
    known = _made[_plain(path)]
    if isinstance(known, DataFrame):
        known = _made[_plain(path)] = fingerprint(parts_of(known, seen))
    return known


def buckets_of(df: DataFrame) -> tuple[int, list[str]] | None:
    """Number and columns of the buckets of the one table a DataFrame reads."""
    leaves = _leaves(df)
    if len(leaves) != 1 or _roots(leaves[0]) is None or not leaves[0].relation().bucketSpec().isDefined():
        return None
    spec = leaves[0].relation().bucketSpec().get()
    names = spec.bucketColumnNames()
    return spec.numBuckets(), [names.apply(i) for i in range(names.size())]


def frequent_keys(on: Sequence[str]) -> Column:
    """Aggregate: the most frequent keys by hash, as ``(item, count)`` pairs. The
    sketch is mergeable; with ``TRACKED`` counters, a key that has more than
    about four in ``TRACKED`` of the rows is always among them."""
    names = ", ".join(f"`{c}`" for c in on)
    return F.expr(f"approx_top_k(xxhash64({names}), {FREQUENT}, {TRACKED})")


def key_name(on: Sequence[str]) -> str:
    return "keys " + ", ".join(on)


def frequent_keys_of(df: DataFrame, on: Sequence[str]) -> dict[int, int] | None:
    """Rows per frequent key (by hash), added up over the written tables that a
    DataFrame reads; None if one of them has no sketch of these columns."""
    total: dict[int, int] = {}
    for seen in observed_in(df) or [{}]:
        if key_name(on) not in seen:
            return None
        for entry in seen[key_name(on)]:
            total[entry["item"]] = total.get(entry["item"], 0) + entry["count"]
    return total


def observed_in(df: DataFrame) -> list[dict] | None:
    """What was observed of each written table a DataFrame reads; None if it
    reads a table that nothing is known of."""
    found = []
    for leaf in _leaves(df):
        roots = _roots(leaf)
        if roots is None or len(roots) != 1 or _plain(roots[0]) not in _observed:
            return None
        found.append(_observed[_plain(roots[0])])
    return found
