"""SparkSession construction and the few settings the library relies on."""

from __future__ import annotations

import re
import tempfile

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

# Settings every session of the library should carry. AQE re-plans joins
# from runtime sizes (broadcast only when the measured side is small),
# coalesces small shuffle partitions and splits skewed join partitions.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot key's join partition even when that costs a later shuffle
    # (e.g. one player with a third of all games feeding a season aggregate)
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.showConsoleProgress": "false",
    # checkpoint files of tables no longer referenced are removed
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


_SCRATCH: list[tempfile.TemporaryDirectory] = []


def build_session(master: str | None = None, *, app_name: str = "seasonlab",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library defaults.

    On a cluster pass ``master=None`` and let spark-submit decide; size
    ``shuffle_partitions`` to input bytes / ~128 MB (AQE coalesces the rest).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``; a missing setting is an error.

    A machine-local folder would not survive the loss of the executor that
    wrote it, so the library never picks one. Sessions of one machine (tests,
    a laptop) can take one from ``use_local_scratch``.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        raise ValueError("set spark.checkpoint.dir to a folder on shared storage (HDFS, S3, ...)")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def use_local_scratch(spark: SparkSession) -> None:
    """Give a one-machine session (``local`` or ``local[...]``) without ``spark.checkpoint.dir`` a scratch folder.

    The folder is removed when the process ends. Any other master is left alone.
    """
    sc = spark.sparkContext
    configured = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured or not re.fullmatch(r"local(\[.*\])?", sc.master):
        return
    folder = tempfile.TemporaryDirectory(prefix="seasonlab-")
    _SCRATCH.append(folder)  # removed with the interpreter
    sc.setCheckpointDir(folder.name)


def materialize(df: DataFrame, how: str = "checkpoint") -> DataFrame:
    """Materialize a table that several later passes read.

    ``checkpoint`` (default) writes it to the shared checkpoint folder and cuts
    the lineage: later jobs, and retries after a lost executor, read the
    written files instead of recomputing the upstream scans and shuffles.
    ``persist`` keeps it in executor memory/disk (lost blocks are recomputed
    from lineage). ``none`` returns ``df`` unchanged.
    """
    if how == "checkpoint":
        ensure_checkpoint_dir(df.sparkSession)
        return df.checkpoint(eager=True)
    if how == "persist":
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    if how == "none":
        return df
    raise ValueError(f"unknown materialization {how!r}")
