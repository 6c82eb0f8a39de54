"""Spark session with the settings the library is tuned for.

Every operator also works on a session made elsewhere; these are only the
settings worth having on a cluster.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"
# Size up to which Java compiles a method, and Spark's own limit.
COMPILED_BYTES, SPARK_BYTES = 8000, 65535

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Row-preserving joins on a hot stay are split by the actual shuffle sizes,
    # also where the split costs one more exchange downstream.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.ui.enabled": "false",
    # Java compiles no method above this size; see ``compiled_methods``.
    METHOD_LIMIT: str(COMPILED_BYTES),
    # Plans here have hundreds of expressions; do not record a call site for each.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def compiled_methods(spark: SparkSession) -> None:
    """Let Spark generate no method that Java would only interpret: the columns
    of a wide row then go through smaller ones. A limit that the session has
    chosen itself stays."""
    if spark.conf.get(METHOD_LIMIT) == str(SPARK_BYTES):
        spark.conf.set(METHOD_LIMIT, str(COMPILED_BYTES))


def build_session(
    app: str = "bedhour",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **extra: str,
) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(SETTINGS)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(extra)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
