"""Session helpers shared by the whole library."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_HERE = os.path.dirname(os.path.abspath(__file__))


def ship(spark: SparkSession) -> None:
    """Make this package importable in every Python worker.

    The sources are zipped once per application and handed to Spark's own file server, so executors
    need neither a shared folder nor a PYTHONPATH entry.
    """
    sc = spark.sparkContext
    if getattr(sc, "_loomlog_shipped", False):
        return
    path = os.path.join(tempfile.mkdtemp(prefix="loomlog-"), "loomlog_src.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(_HERE):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("loomlog", os.path.relpath(full, _HERE)))
    sc.addPyFile(path)
    sc._loomlog_shipped = True


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints: the cluster's own setting, else, only where master and executors are one process, a temporary one."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured and not sc.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        sc.setCheckpointDir(configured or tempfile.mkdtemp(prefix="loomlog-checkpoint-"))
        current = sc.getCheckpointDir()
    return current
