"""Session construction and tuning knobs.

Library functions never create sessions; tests, the bench and the entry
point use :func:`local_session`.  On a cluster the session comes from the
caller and its settings (``spark.checkpoint.dir`` among them) are read,
never overridden.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

#: Upper bound on rows handled by one window group in the session scan.
#: Sessions larger than this are split into ordered chunks (see
#: :mod:`logsift.operators.sessions`).
DEFAULT_CHUNK_ROWS = 1_000_000

#: In the default ``auto`` file mode, session files larger than this are
#: read in blocks (``split``) instead of as one value per file.
SPLIT_ABOVE_BYTES = 64 << 20

#: This many of the largest sessions are cut into segments (one short row each
#: is broadcast); any other holds less than the total rows over this number.
MAX_LISTED_SESSIONS = 100_000


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "logsift") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("LOGSIFT_DRIVER_MEMORY", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint directory: the session's own, else the
    ``spark.checkpoint.dir`` setting.  Only a local-mode session without
    either gets a scratch folder (tests); on a cluster a machine-local
    folder would be wrong, so the shared folder must be configured."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        configured = tempfile.mkdtemp(prefix="logsift-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def cluster_settings(input_bytes: int, *, target_partition_bytes: int = 256 << 20, executors_cores: int = 4000) -> dict[str, str]:
    """Spark settings a cluster run of the jobs should start from.

    Scan splits and shuffle partitions are sized so one task handles about
    ``target_partition_bytes``; adaptive execution then coalesces small
    shuffle partitions, splits skewed join partitions and converts joins to
    broadcast only below its measured-size threshold."""
    shuffle = max(executors_cores * 2, input_bytes // target_partition_bytes)
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(int(shuffle)),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.autoBroadcastJoinThreshold": str(16 << 20),
    }
