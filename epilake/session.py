"""Session-level helpers: where scratch tables live, and a test/bench session.

Library code never changes global session settings. The only thing it reads
is ``spark.checkpoint.dir``: the shared folder the cluster names for
lineage cuts. Materialised intermediate tables go there, never to a
machine-local temporary folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the session.

    Reads ``spark.checkpoint.dir``; falls back to the SparkContext's
    checkpoint dir. Only a *local-mode* session with neither set gets a
    private temporary folder (tests); a cluster session without one is an
    error, because executors could not see a machine-local path.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.sparkContext.getCheckpointDir()
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a folder every "
            "executor can reach (HDFS/object store)"
        )
    path = tempfile.mkdtemp(prefix="epilake-ckpt-")
    spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused folder under the shared dir for one table."""
    return f"{shared_dir(spark)}/epilake/{name}-{uuid.uuid4().hex[:12]}"


def local_session(cores: int | str = "*", app: str = "epilake",
                  shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and the local benchmark (not used by the library).

    AQE stays on so a skewed join key is split at run time, and the UI is
    off. A checkpoint folder is set only when the environment has none.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("EPILAKE_DRIVER_MEM", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark
