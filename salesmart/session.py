"""Session helpers: a local builder for tests/bench and the shared scratch folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter for every job in this package.  On a cluster these belong in
# spark-defaults; ``apply_job_conf`` only fills what the session leaves unset.
JOB_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # strict CSV extracts: a short row must fail even when columns are pruned
    "spark.sql.csv.parser.columnPruning.enabled": "false",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "salesmart") -> SparkSession:
    """A local session for tests and the bench (UI off, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for k, v in JOB_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_job_conf(spark)
    return spark


def apply_job_conf(spark: SparkSession) -> None:
    """Set the job settings the session does not already carry."""
    for k, v in JOB_CONF.items():
        if k in ("spark.sql.session.timeZone", "spark.sql.csv.parser.columnPruning.enabled"):
            # correctness settings: always pinned
            spark.conf.set(k, v)
        elif spark.conf.get(k, None) is None:
            spark.conf.set(k, v)


TARGET_PARTITION_BYTES = 128 * 1024 * 1024
MAX_SHUFFLE_PARTITIONS = 200_000


def size_shuffles(spark: SparkSession, input_bytes: int) -> int:
    """Start shuffles with about one partition per 128 MB of input; AQE then coalesces
    small ones.  A fixed ``spark.sql.shuffle.partitions`` cannot grow with the data
    (AQE only merges), so at 100 TB each partition would hold hundreds of GB.  Leaves
    an explicit ``initialPartitionNum`` alone; returns the number in effect."""
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    if spark.conf.get(key, None):
        return int(spark.conf.get(key))
    base = int(spark.conf.get("spark.sql.shuffle.partitions"))
    want = min(MAX_SHUFFLE_PARTITIONS, max(base, -(-input_bytes // TARGET_PARTITION_BYTES)))
    if want > base:
        spark.conf.set(key, str(want))
    return want


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names storage every executor can reach, so it is read
    from the session, and its absence is an error there: a folder of the driver's own
    disk would lose data.  Only a local master, where driver and executor are one
    process, gets a temporary folder of its own (registered as the checkpoint folder).
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise RuntimeError(f"spark.checkpoint.dir is not set on master {master!r}: name a "
                               "folder that the driver and every executor can reach")
        root = tempfile.mkdtemp(prefix="salesmart-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
        root = spark.sparkContext.getCheckpointDir() or root
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str, fresh: bool = False) -> str:
    """A path below the shared checkpoint folder (``fresh`` adds a unique leaf)."""
    segs = [checkpoint_root(spark), "salesmart", *parts]
    if fresh:
        segs.append(uuid.uuid4().hex)
    return "/".join(s.strip("/") if i else s for i, s in enumerate(segs))


def path_key(path: str) -> str:
    """Short stable folder name for an input directory."""
    base = os.path.basename(path.rstrip("/")) or "root"
    import hashlib
    return f"{base}-{hashlib.sha1(path.encode()).hexdigest()[:8]}"
