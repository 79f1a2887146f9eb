"""Session construction and cluster-safe scratch locations."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every session of this library wants; a cluster's own values win.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpoint files go once nothing refers to them any more
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # HotSpot does not JIT methods over 8000 bytes; past that, fall back from
    # whole-stage codegen to per-operator code (split into small methods).
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "creditspark", extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting points at shared storage and is used as is; if it
    is missing there, this fails rather than writing to a machine-local folder.
    Only a local master (tests, single-node runs) gets a fresh local folder.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # sessions without driver-side context access: the server owns the setting
        return spark.conf.get("spark.checkpoint.dir", None) or ""
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (checkpoints must survive executor loss)")
    local = tempfile.mkdtemp(prefix="creditspark-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(local)
    return local


def recommended_conf(input_bytes: int, total_cores: int, *, target_shuffle_partition_bytes: int = 1 << 30,
                     max_split_bytes: int = 512 << 20, most_partitions: int = 40_000) -> dict:
    """Shuffle and split sizing for a cluster run (a starting point; AQE coalesces below it).

    ``input_bytes``: the pruned columns of the largest shuffled input (the orders side of the
    loan-tape join), not the files. Shuffle partitions hold about ``target_shuffle_partition_bytes``
    of it, with two waves of tasks over the cluster's cores at least; ``most_partitions`` bounds
    map tasks x partitions, and with it the driver's table of shuffle blocks (partitions then grow
    instead, and AQE splits skewed ones).
    """
    parts = max(2 * total_cores, -(-int(input_bytes) // int(target_shuffle_partition_bytes)))
    parts = min(parts, max(most_partitions, 2 * total_cores))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(max_split_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 << 20),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_shuffle_partition_bytes),
    }
