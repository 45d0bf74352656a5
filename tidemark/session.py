"""Session helpers: local session for tests, shared checkpoint folder, size guards."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Upper bound for anything this library ships to every executor.
DEFAULT_BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024


# Settings this library expects on a cluster (the session owner sets them):
CLUSTER_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 << 20),
    "spark.sql.files.maxPartitionBytes": str(256 << 20),
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.shuffle.partitions": "auto-sized by AQE from a high start, e.g. 20000 at 100 TB",
    "spark.checkpoint.dir": "a shared folder (HDFS/S3) for lineage cuts and written intermediates",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tidemark") -> SparkSession:
    """Session for tests and the local bench (UI off, AQE on, small shuffles)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # page bodies and chunk texts are wide: keep Arrow batches to Python small
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", os.environ.get("TIDEMARK_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    On a cluster this is set by the operator and only read here; without it a job
    on a cluster fails, as executors cannot share a machine's own folder.  Only a
    ``local`` session gets a private scratch folder.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        conf_dir = spark.sparkContext.getCheckpointDir()
    if not conf_dir:
        master = spark.sparkContext.master
        if not re.match(r"local(\[|$)", master):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")
        conf_dir = tempfile.mkdtemp(prefix="tidemark-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(conf_dir)
    return conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written intermediate tables."""
    import uuid

    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: columns can still be
    pruned, lost executors lose nothing, and the files go when the session's JVM ends."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hpath)
    return spark.read.schema(df.schema).parquet(path)


_SHARED: dict[tuple, tuple[str, DataFrame]] = {}


def folder_state(spark: SparkSession, path: str) -> str:
    """What the entries of a folder are now: name, bytes, number of files and time of each, as one digest."""
    import hashlib

    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    seen = []
    for entry in fs.listStatus(folder):
        held = fs.getContentSummary(entry.getPath())
        seen.append((entry.getPath().getName(), held.getLength(), held.getFileCount(), entry.getModificationTime()))
    return hashlib.sha256(repr(sorted(seen)).encode()).hexdigest()


def shared_table(spark: SparkSession, key: tuple, inputs: str, build) -> DataFrame:
    """The table ``build()`` makes from the tables in the folder ``inputs``, written once for each session and key and read by every query that needs it.

    A folder that has changed since gives a new table."""
    own, now = (spark.sparkContext.applicationId, *key, inputs), folder_state(spark, inputs)
    had = _SHARED.get(own)
    if had is None or had[0] != now:
        _SHARED[own] = now, materialise(build(), key[0])
    return _SHARED[own][1]


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def spread_for_cpu(df: DataFrame) -> DataFrame:
    """Round-robin rows over the cluster when a scan yields fewer partitions than
    cores (e.g. one big row group) ahead of CPU-heavy per-row work.  At scale the
    file splits already exceed the parallelism and nothing is added."""
    try:
        want = df.sparkSession.sparkContext.defaultParallelism
        have = df.rdd.getNumPartitions()
    except Exception:  # pragma: no cover - sessions without RDD access (Spark Connect)
        return df
    return df.repartition(want) if have < want else df
