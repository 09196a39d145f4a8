"""Session construction and the shared scratch folder.

On a cluster the shared folder is whatever ``spark.checkpoint.dir`` names; a
machine-local temporary folder is only created when that setting is absent
(local runs and tests).
"""

from __future__ import annotations

import hashlib
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # remove checkpoint files once their DataFrame is garbage collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


_made: set[str] = set()        # application folders of this process


def get_session(master: str | None = None, app: str = "tessera",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with AQE and skew-join handling switched on."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def scale_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20,
               shuffle_ratio: float = 0.1, max_shuffle_partitions: int = 100_000) -> dict[str, str]:
    """Settings sized to the input so every task's share fits executor memory.

    * scan splits of ``target_partition_bytes``;
    * shuffle partitions = expected shuffle bytes / target, where the
      expected shuffle is ``shuffle_ratio`` x input (column pruning and
      map-side partial aggregation shrink every shuffle here), clamped to
      [2 x cores, ``max_shuffle_partitions``] -- more reducers would multiply
      the map x reduce block count without making tasks useful; AQE then
      coalesces small partitions and splits skewed ones;
    * Arrow batches of 2048 records for the per-partition NumPy kernels
      (one record can hold a vocabulary-sized array).
    """
    want = int(input_bytes * shuffle_ratio // target_partition_bytes) + 1
    parts = min(max(2 * total_cores, want), max_shuffle_partitions)
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.maxRecordsPerBatch": "2048",
    }


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder for checkpoints and intermediate tables.

    Read from ``spark.checkpoint.dir``.  Where it is unset a private temporary
    folder is created and registered, but only under a local master: on a
    cluster every executor would write to its own disk, so there it raises.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not base:
        current = sc.getCheckpointDir()
        if current:
            return current
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="tessera-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(base)
    return base


def _app_dir(spark: SparkSession) -> str:
    """This application's folder below the shared one; it is deleted when the
    driver's JVM ends in order."""
    base = shared_dir(spark)
    sc = spark.sparkContext
    path = f"{base.rstrip('/')}/tessera/{sc.applicationId}"
    if path not in _made:
        folder = sc._jvm.org.apache.hadoop.fs.Path(path)
        fs = folder.getFileSystem(sc._jsc.hadoopConfiguration())
        fs.mkdirs(folder)
        fs.deleteOnExit(folder)
        _made.add(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the application's folder."""
    return f"{_app_dir(spark)}/{name}-{uuid.uuid4().hex}"


def input_path(spark: SparkSession, name: str, sf_dir: str) -> str:
    """One stable path below the application's folder per name and input directory, so
    that a query which renders its input as files overwrites its own copy
    instead of leaving a new one each time."""
    return f"{_app_dir(spark)}/{name}-{hashlib.md5(sf_dir.encode()).hexdigest()[:16]}"


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def load(spark: SparkSession, sf_dir: str, name: str):
    """Parquet table of the driver's data set (column pruning and filter
    pushdown happen at this scan)."""
    return spark.read.parquet(table_path(sf_dir, name))


SPREAD = "spark.tessera.spread"


def spread(df):
    """``df`` dealt evenly to as many partitions as the session setting
    ``spark.tessera.spread`` names; ``df`` as it is where that is unset.

    A Parquet file is read by a task per row group at the least, so a table of
    one row group keeps one core busy whatever the cluster.  The setting is for
    such small tables only: at scale a file has many row groups, and the
    setting stays off, for it would add an exchange of the whole texts.
    """
    n = df.sparkSession.conf.get(SPREAD, None)
    return df.repartition(int(n)) if n else df


ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def large_rows(spark, size: str = "8m"):
    """Arrow batches of ``size`` from now on, unless the session names another.

    Spark fills a batch with rows up to 64 MB by default.  Of rows of many MB the
    JVM then holds 256 MB a task beside its heap, and the Python worker two
    batches.  Spark reads the setting when a plan runs, so it stays.
    """
    if spark.conf.get(ARROW_BYTES, None) is None:
        spark.conf.set(ARROW_BYTES, size)


def checkpoint(df):
    """Reliable checkpoint into the shared folder (lineage cut; the data
    survive the loss of the executors that computed them)."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


TASK_ROWS = 50_000      # rows of a few numbers that a task of an iterated fit works on


def dealt(df):
    """A table that many jobs work on, checkpointed and dealt evenly to a task per
    TASK_ROWS rows; ``df`` as it is where one task does.

    Narrow rows pack so well that a Parquet split holds millions of them, and
    every step of a fit over it would keep one core busy whatever the cluster.
    """
    n = -(-df.count() // TASK_ROWS)
    return checkpoint(df.repartition(n)) if n > 1 else df
