"""Session helpers.

Library code never sets a master. ``local_session`` is for tests, the bench
and the smoke entry point only; on a cluster the caller passes its own session.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the jobs rely on. AQE re-plans joins from runtime sizes (broadcast
# only when the measured side is small, skew splitting otherwise).
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Checkpointed rows go through the RDD serializer; Kryo is faster than Java.
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
}


def local_session(cpus: int | str = "*", partitions: int = 8, app: str = "adlens",
                  extra: dict | None = None) -> SparkSession:
    builder = (SparkSession.builder.master(f"local[{cpus}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(partitions))
               .config("spark.driver.memory", "16g"))
    for k, v in {**BASE_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    Taken from ``spark.checkpoint.dir`` when the cluster names one. Only a local
    master (tests, local runs) gets a private folder when it is unset; a cluster
    without the setting is an error.
    """
    conf = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # a remote (Connect) session: the server owns the setting
        return conf or ""
    current = sc.getCheckpointDir()
    if current:
        return current
    if not conf:
        if not sc.master.startswith("local"):
            # A machine-local folder is not visible to executors on other hosts.
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        conf = tempfile.mkdtemp(prefix="adlens-ckpt-")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh location under the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark)
    if not root:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    return os.path.join(root, f"{name}-{uuid.uuid4().hex[:12]}")


def read_or_none(spark: SparkSession, path: str, schema=None, options: dict | None = None):
    """The parquet table at ``path``, or None if nothing is there yet. Only a missing path
    counts as "not there": an emptied or damaged table raises."""
    from pyspark.errors import AnalysisException
    try:
        reader = spark.read.options(**(options or {}))
        return (reader.schema(schema) if schema is not None else reader).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def cluster_conf(input_bytes: int, split_bytes: int = 256 << 20, shuffle_bytes: int = 1 << 30,
                 max_shuffle_partitions: int = 100_000) -> dict[str, str]:
    """Settings for a cluster run over ``input_bytes`` of input (to pass to spark-submit).

    Initial shuffle partitions: about one per GB of input (shuffles after partial
    aggregation are much smaller than the input), capped so map-output bookkeeping
    stays small; AQE coalesces small partitions to the advisory size and splits
    skewed ones. File splits are 256 MB. The checkpoint folder must be set by the
    cluster to shared storage.
    """
    parts = min(max_shuffle_partitions, max(200, -(-input_bytes // shuffle_bytes)))
    return {
        **{k: v for k, v in BASE_CONF.items() if k != "spark.ui.enabled"},
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(split_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(split_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * split_bytes),
    }
