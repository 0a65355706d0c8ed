"""Session settings the engine relies on, and the shared folder for written intermediates."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every plan of this package assumes. Each can be set on a live session.
RUNTIME_CONF = {
    # Text timestamps carry no zone, and day arithmetic must not meet 23 or 25 hour days.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A hot customer or product makes one shuffle partition large: split it even where
    # the split costs one more exchange.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Staged inputs have few bytes a row (7 to 12): at Spark's 128 and 64 MB a task would add up or sort over ten million
    # rows, and spill. With these its memory stays the same from some hundred MB of input on.
    "spark.sql.files.maxPartitionBytes": str(24 * 1024 * 1024),
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(24 * 1024 * 1024),
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session and return it."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "refillcast", master: str | None = None, **conf: str) -> SparkSession:
    """Create (or get) a session with the package settings; ``conf`` adds or overrides."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        **RUNTIME_CONF,
        "spark.sql.parquet.datetimeRebaseModeInWrite": "CORRECTED",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach: the cluster's ``spark.checkpoint.dir``.

    A machine-local folder is made only where the setting is missing and the master is local.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    base = tempfile.mkdtemp(prefix="refillcast-")
    spark.conf.set("spark.checkpoint.dir", base)
    return base


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no earlier run has used."""
    return f"{shared_dir(spark)}/refillcast/{name}-{uuid.uuid4().hex}"


#: Shuffle files go when the query that made them ends, not when the driver's JVM next collects garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def settle(df: DataFrame, path: str) -> DataFrame:
    """Write rows that later steps read, replacing what the path held; the table, with what its columns know.

    Of the write nothing but the table is left on disk: what it shuffled is dropped as it ends. ``df`` itself should
    not run again, it would have to shuffle anew.
    """
    spark = df.sparkSession
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)
