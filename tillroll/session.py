"""Session construction (tests, bench) and the shared work folder.

Library code never builds its own session; it receives one.  Scratch data
(CSV landing zones, stream checkpoints, versioned state tables) lives under
the folder the cluster names in ``spark.checkpoint.dir``.  Only a local master
may leave that setting out; one is then set.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_folder() -> str:
    """A folder of this process for local runs, removed when it ends."""
    path = tempfile.mkdtemp(prefix="tillroll-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    return path


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "tillroll") -> SparkSession:
    """Local session for tests and the bench (UI off, UTC, AQE on)."""
    return (
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
        .config("spark.driver.memory", "16g")
        .config("spark.checkpoint.dir", scratch_folder())
        .getOrCreate()
    )


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder that the session names.

    Without that setting only a local master gets a folder of its own; on a
    cluster every machine would write to its own disk, so that is an error."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    sc = None
    try:  # classic sessions; a Spark Connect session has no SparkContext
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001
        sc = None
    if not root and sc is not None:
        root = sc.getCheckpointDir()
    if not root:
        master = sc.master if sc is not None else ""
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder that all machines share")
        root = scratch_folder()
        spark.conf.set("spark.checkpoint.dir", root)
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    root = checkpoint_root(spark)
    path = f"{root}/tillroll/{name}-{uuid.uuid4().hex[:12]}"
    if path.startswith("file:"):
        os.makedirs("/" + path.removeprefix("file:").lstrip("/"), exist_ok=True)
    return path
