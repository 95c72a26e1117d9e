"""Session defaults and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime settings only: they apply to any session, local or cluster. Partition counts are
# left to adaptive execution, which coalesces from the initial number.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: str = "8", app: str = "newsvault", memory: str = "16g",
                  **conf: str) -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.driver.memory", memory)
               .config("spark.sql.shuffle.partitions", "8"))
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local-mode session without the setting falls back to a temporary folder; a
    cluster must name a shared one, because executors come and go.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    sc = spark.sparkContext
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    if sc.applicationId not in _local_folders:
        _local_folders[sc.applicationId] = tempfile.mkdtemp(prefix="newsvault-")
        sc.setCheckpointDir(_local_folders[sc.applicationId])
    return _local_folders[sc.applicationId]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"
