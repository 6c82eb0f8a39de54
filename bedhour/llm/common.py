"""Helpers the operators of this subpackage share: stages in the shared folder,
size-checked broadcasts, and texts as UTF-8 bytes inside tasks."""

from __future__ import annotations

import ctypes
import re
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import hadoop_path, shared_folder

# White space of the word rules: blank, tab, line feed, vertical tab, form feed, return.
SPACE_CLASS = r"[^\x20\x09-\x0D]+"
SPACES = re.compile("[\x20\x09-\x0d]+")
# A stage whose files are larger than this is joined by a shuffle, not broadcast.
BROADCAST_BYTES = 8 << 20
CHUNK_BYTES = 1 << 19
# Rows of an Arrow batch: texts are wide, and both sides hold whole batches.
BATCH_ROWS = 1_000
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the queries run inside go as each one ends, instead of
    when the driver next collects garbage."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


class Stage:
    """A DataFrame written to the shared folder. Its lineage ends there, so a
    lost executor costs only the tasks it was running."""

    def __init__(self, df: DataFrame, name: str):
        self.spark = df.sparkSession
        self.path = f"{shared_folder(self.spark)}/llm-{name}-{uuid.uuid4().hex}"
        schema = df.schema
        files, at = hadoop_path(self.spark, self.path)
        files.deleteOnExit(at)
        with shuffles_removed(self.spark):
            df.write.parquet(self.path)
        self.df = self.spark.read.schema(schema).parquet(self.path)

    def bytes(self) -> int:
        files, at = hadoop_path(self.spark, self.path)
        return int(files.getContentSummary(at).getLength())

    def small(self, most: int = BROADCAST_BYTES) -> DataFrame:
        """Marked for broadcast if its files are no larger than ``most``; else
        as it is, and a join with it shuffles."""
        return F.broadcast(self.df) if self.bytes() <= most else self.df

    def drop(self) -> None:
        """Remove the files, once what was made from them is written too."""
        files, at = hadoop_path(self.spark, self.path)
        files.delete(at, True)


_shipped: set[str] = set()


def on_workers(spark: SparkSession) -> None:
    """Let Python workers import this package, wherever the driver found it, and
    unless the session says otherwise hand them texts in small batches."""
    application = spark.sparkContext.applicationId
    if application not in _shipped:
        if spark.conf.get(BATCH) == "10000":
            spark.conf.set(BATCH, str(BATCH_ROWS))
        package = Path(__file__).resolve().parent.parent
        archive = shutil.make_archive(
            str(Path(tempfile.mkdtemp(prefix="package-")) / package.name), "zip", package.parent, package.name
        )
        spark.sparkContext.addPyFile(archive)
        _shipped.add(application)


def release() -> None:
    """Give freed memory back to the system. A Python worker outlives its task,
    and would keep it beside the tasks of later stages."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError, TypeError):  # only glibc has it
        pass


_kept: list[dict] = []
_kept_by: list[int] = []


def kept_by_stage() -> dict:
    """A dictionary for what the tasks of a stage share in a Python worker; it is
    emptied before the worker's first task of another one."""
    _kept.append({})
    return _kept[-1]


def begin_task(stage: int | None) -> None:
    """Let go what tasks of another stage have kept in this worker."""
    if stage is None or _kept_by == [stage]:
        return
    _kept_by[:] = [stage]
    if any(_kept):
        for kept in _kept:
            kept.clear()
        release()


def released(run: Callable) -> Callable:
    """``run`` without what earlier stages kept, and at the end of its task ``release``."""

    def until_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        begin_task(context.stageId() if context else None)
        try:
            yield from run(batches)
        finally:
            release()

    return until_end


def in_tasks(df: DataFrame, run: Callable, schema) -> DataFrame:
    """``df`` through a function over its Arrow batches."""
    on_workers(df.sparkSession)
    return df.mapInArrow(released(run), schema)


def apart(key: Column) -> Column:
    """The same long, but another column to the planner. A table aggregated by a
    key and then joined by it would lend its partitioning to the join; under
    ``apart`` both sides are shuffled for the join itself, and only then may
    adaptive execution split a hot key."""
    return key + F.lit(0).cast("long")


def ascii_lower(text: Column) -> Column:
    """Lower case for A-Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(SPACE_CLASS)).cast("long")


def words_of(text: str) -> list[str]:
    """Words between runs of blanks, tabs and line ends (and no other white space)."""
    return [w for w in SPACES.split(text) if w]


def long_column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name)).cast(pa.int64())


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column end to end, and where each row starts (one
    entry more than rows). A null is an empty text."""
    column = column.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    if not len(offsets):
        return raw[:0], np.zeros(1, np.int64)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def row_chunks(starts: np.ndarray, limit: int = CHUNK_BYTES, rows: int | None = None) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes and at most ``rows`` rows each; a longer
    text is a range of its own."""
    first, n = 0, len(starts) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(starts, starts[first] + limit, side="right")) - 1)
        if rows is not None:
            last = min(last, first + rows)
        yield first, last
        first = last


MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
MIX_2 = np.uint64(0x94D049BB133111EB)
BASE = 0x9E3779B97F4A7C15 | 1
BASE_INVERSE = pow(BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = kept_by_stage()


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (splitmix finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * MIX_1
    x = x ^ (x >> np.uint64(27))
    x = x * MIX_2
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, CHUNK_BYTES + 1024), base, np.uint64)
        steps[0] = 1
        have = np.multiply.accumulate(steps)
        if n <= 4 * CHUNK_BYTES:
            _powers[base] = have
    return have[:n]


BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Polynomial prefix sums of bytes: any substring's hash by one subtraction."""
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(BYTE_VALUES[data] * powers(BASE, len(data)), out=sums[1:])
    return sums


def substring_hashes(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each ``data[start:end]``, whatever its place."""
    inverse = powers(BASE_INVERSE, len(sums))
    return mix((sums[end] - sums[start]) * inverse[start] + (end - start).astype(np.uint64) * MIX_1)


IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def word_spans(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, end and row of every word in the bytes of several texts. No byte of
    a longer UTF-8 letter looks like white space."""
    space = IS_SPACE[data]
    before, after = np.empty(len(data) + 1, bool), np.empty(len(data) + 1, bool)
    before[0] = after[-1] = True
    before[1:], after[:-1] = space, space
    before[starts] = True
    # after[i] tells of byte i: whether a word that includes byte i - 1 ends there.
    after[starts] = True
    begin = np.flatnonzero(~space & before[:-1])
    end = np.flatnonzero(~space & after[1:]) + 1
    return begin, end, np.searchsorted(starts, begin, side="right") - 1


def per_row(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sum of per-byte values over each row."""
    sums = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=sums[1:])
    return sums[starts[1:]] - sums[starts[:-1]]
