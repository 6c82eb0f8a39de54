"""Stage outputs: Parquet in the folder all executors share."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from .. import STAY
from . import manifest


# Rows of a stay that more than one task should write.
HOT_ROWS = 1_000_000
# Columns that large tables are joined by.
KEYS = (STAY, "celllabel", "drugname", "labname", "nursingchartcelltypevallabel", "treatmentstring")


def shared_folder(spark: SparkSession) -> str:
    """Folder for stage outputs, as the cluster names it in
    ``spark.checkpoint.dir``. A local session without that setting uses its
    warehouse folder; elsewhere the setting must be there."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/stages"


def hadoop_path(spark: SparkSession, path: str):
    """The file system of a path, and the path, as Spark itself opens them."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), at


def stored_bytes(df: DataFrame) -> int:
    """Size of a written table as the planner knows it: that of its files."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


class Stages:
    """The stages of one run, in a folder of their own.

    With a ``run`` name the folder is the same each time. A stage that is
    complete there is read instead of written if its manifest says that it was
    made from the same inputs, options, settings and code (see ``manifest``); if
    not, it is written anew, and so is all that depends on it. So a run that was
    stopped goes on where it was, and one that was changed does over what the
    change reaches. ``history`` tells, for each stage of this run, why it was
    written. Without a name every stage is new, and the folder goes when the
    application ends. ``remove`` deletes it at the end of a run.

    With a number of ``buckets``, stages that are joined by stay are written as
    that many buckets of stays, so that such joins need no shuffle.
    """

    def __init__(
        self, spark: SparkSession, run: str | None = None, keys: Sequence[str] = KEYS, buckets: int | None = None
    ):
        self.spark = spark
        self.keys = keys
        self.buckets = buckets
        self.named = run is not None
        self.folder = f"{shared_folder(spark)}/bedhour-{run or uuid.uuid4().hex}"
        self.history: dict[str, str] = {}
        self.observed: dict[str, dict] = {}
        self._seen: dict[tuple[str, ...], str] = {}
        if self.named:
            manifest.track()
        else:
            files, at = hadoop_path(spark, self.folder)
            files.deleteOnExit(at)

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def complete(self, name: str) -> bool:
        return self._manifest(name) is not None

    def _manifest(self, name: str) -> dict | None:
        """The manifest of a stage whose files are all there."""
        files, at = hadoop_path(self.spark, f"{self.path(name)}.json")
        if not files.exists(at):
            return None
        found = json.loads("\n".join(r[0] for r in self.spark.read.text(self.path(name) + ".json").collect()))
        return found if found["stored"] == self._stored(name) else None

    def _stored(self, name: str) -> list[int]:
        """Number and bytes of the files of a stage."""
        files, at = hadoop_path(self.spark, self.path(name))
        if not files.exists(at):
            return [0, 0]
        summary = files.getContentSummary(at)
        return [summary.getFileCount(), summary.getLength()]

    def _reason(self, name: str, parts: dict[str, str]) -> str | None:
        """Why a stage has to be written; None if it need not be."""
        found = self._manifest(name)
        if found is None:
            return "new"
        changed = sorted(k for k, v in parts.items() if found["parts"].get(k) != v)
        return ", ".join(changed) or None

    def write(
        self,
        df: DataFrame,
        name: str | None = None,
        columns: list[str] | None = None,
        cluster_by: list[str] | None = None,
        observations: Sequence[Observation] = (),
        by_stay: bool = False,
    ) -> DataFrame:
        """A stage by its name, written unless it is there as wanted. The write
        counts the rows and sketches the frequent keys of ``keys``; that, and
        what the ``observations`` on ``df`` saw, is kept under ``observed``, also
        when the stage was written by an earlier run."""
        name = name or f"stage-{uuid.uuid4().hex}"
        out = df.select(*columns) if columns else df
        counted = Observation(f"rows of {name}")
        sketches = [manifest.frequent_keys([k]).alias(manifest.key_name([k])) for k in self.keys if k in out.columns]
        path = self.path(name)
        buckets = self.buckets if by_stay else None
        parts: dict[str, str] = {}
        reason: str | None = "not a named run"
        if self.named:
            parts = manifest.parts_of(out, self._seen)
            parts["layout"] = manifest.digest(*(cluster_by or []), f"{buckets} buckets")
            reason = self._reason(name, parts)
        self.history[name] = reason or "reused"
        made = manifest.fingerprint(parts) if self.named else out
        if reason is None:
            self.observed[name] = self._manifest(name)["observed"]
            manifest.remember(path, made, self.observed[name])
            if buckets:
                return bucketed_table(self.spark, out, path, buckets)
            return self.spark.read.schema(out.schema).parquet(path)
        if self.named:
            # From here on until the new manifest stands, the stage is incomplete.
            files, at = hadoop_path(self.spark, path + ".json")
            files.delete(at, False)
        seen = (counted, F.count(F.lit(1)).alias("rows"), *sketches)
        mode = "overwrite" if self.named else "errorifexists"
        if buckets:
            written = write_bucketed(out, path, buckets, seen)
        else:
            written = write_stage(out, path, None, cluster_by, mode, seen)
        self.observed[name] = {k: plain(v) for o in (*observations, counted) for k, v in o.get.items()}
        manifest.remember(path, made, self.observed[name])
        if self.named:
            self._put(path + ".json", {"parts": parts, "stored": self._stored(name), "observed": self.observed[name]})
        return written

    def _put(self, path: str, content: dict) -> None:
        """A file that is either whole or not there."""
        files, part = hadoop_path(self.spark, path + ".part")
        _, at = hadoop_path(self.spark, path)
        stream = files.create(part, True)
        try:
            stream.write(bytearray(json.dumps(content, sort_keys=True).encode()))
        finally:
            stream.close()
        if not files.rename(part, at):
            raise OSError(f"cannot write {path}")

    def remove(self) -> None:
        files, at = hadoop_path(self.spark, self.folder)
        files.delete(at, True)


def table_name(path: str) -> str:
    return f"bedhour_{manifest.digest(path)[:32]}"


def write_bucketed(out: DataFrame, path: str, buckets: int, observe: tuple) -> DataFrame:
    """A stage as a table of the session, in buckets of stays, sorted by stay.
    Stays that are known to be hot are written by several tasks."""
    spark = out.sparkSession
    bucket = F.pmod(F.hash(STAY), F.lit(buckets))
    hot = [k for k, n in (manifest.frequent_keys_of(out, [STAY]) or {}).items() if n > HOT_ROWS]
    rows = F.xxhash64(*[F.col(f"`{c}`") for c in out.columns])
    spread = F.when(F.xxhash64(STAY).isin(hot), F.pmod(rows, F.lit(buckets))).otherwise(0) if hot else F.lit(0)
    spark.sql(f"DROP TABLE IF EXISTS {table_name(path)}")
    dealt = out.repartition(buckets, bucket, spread).observe(*observe)
    writer = dealt.write.mode("overwrite").option("path", path).bucketBy(buckets, STAY).sortBy(STAY)
    writer.format("parquet").saveAsTable(table_name(path))
    return spark.table(table_name(path))


def bucketed_table(spark: SparkSession, out: DataFrame, path: str, buckets: int) -> DataFrame:
    """A bucketed stage that is there already, as a table of this session."""
    name = table_name(path)
    if not spark.catalog.tableExists(name):
        columns = out._jdf.schema().toDDL()
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({STAY}) SORTED BY ({STAY}) "
            f"INTO {buckets} BUCKETS LOCATION '{path}'"
        )
    return spark.table(name)


def plain(value):
    """An observed value as JSON knows it."""
    if isinstance(value, Row):
        return {k: plain(v) for k, v in value.asDict().items()}
    return [plain(v) for v in value] if isinstance(value, list) else value


def write_stage(
    df: DataFrame,
    path: str | None = None,
    columns: list[str] | None = None,
    cluster_by: list[str] | None = None,
    mode: str = "errorifexists",
    observe: tuple | None = None,
) -> DataFrame:
    """Write a stage as Parquet and return it as read back, with its lineage cut.

    ``cluster_by`` puts rows of the same key side by side in the files (one
    shuffle), so readers that filter on the key skip row groups. A hash of the
    row breaks ties between range bounds, so a hot key spreads over several
    neighbouring files. There is never a file per stay. Without a ``path`` the
    stage goes to the shared folder and is removed when the application ends.
    ``observe`` is an observation and its aggregates, taken by the tasks that
    write, so a repeated task counts once.
    """
    spark = df.sparkSession
    out = df.select(*columns) if columns else df
    schema = out.schema
    if path is None:
        path = f"{shared_folder(spark)}/stage-{uuid.uuid4().hex}"
        files, at = hadoop_path(spark, path)
        files.deleteOnExit(at)
    if cluster_by:
        spread = F.xxhash64(*[F.col(f"`{c}`") for c in out.columns])
        out = out.repartitionByRange(*cluster_by, spread).sortWithinPartitions(*cluster_by)
    if observe:
        out = out.observe(*observe)
    out.write.mode(mode).parquet(path)
    manifest.remember(path, df.select(*columns) if columns else df)
    return spark.read.schema(schema).parquet(path)
