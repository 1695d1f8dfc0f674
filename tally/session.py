"""Session helpers.

The library never hard-codes cluster settings into the operators; this module
only offers a builder for scripts/tests and a resolver for the shared
checkpoint folder the cluster names in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

# Settings that matter at scale: AQE re-plans joins from runtime sizes,
# coalesces small shuffle partitions and splits skewed ones.
SCALE_CONFS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(
    master: str = "local[*]",
    shuffle_partitions: int = 8,
    app_name: str = "tally",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the settings the library assumes."""
    builder = SparkSession.builder.master(master).appName(app_name)
    confs = dict(SCALE_CONFS)
    confs["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    confs.setdefault("spark.driver.memory", "8g")
    if extra:
        confs.update(extra)
    for k, v in confs.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting must point at shared storage and is only read;
    if it is missing there, this raises instead of inventing a folder that
    only one machine can see. Where it is unset on a ``local`` master (tests,
    a laptop) a fallback is set once for the session: the given folder, or a
    fresh temporary folder. On a cluster no folder is ever created.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(current)
        return current
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder on shared storage")
    folder = fallback or tempfile.mkdtemp(prefix="tally-ckpt-")
    os.makedirs(folder, exist_ok=True)
    spark.conf.set("spark.checkpoint.dir", folder)
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written tables."""
    base = checkpoint_dir(spark)
    return base.rstrip("/") + "/" + name


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per Spark context.

    Functions that run in Python tasks are imported there by name; without
    this (or the package on the executors' path) such a task cannot start.
    """
    sc = spark.sparkContext
    if getattr(sc, "_tally_shipped", False):
        return
    folder = tempfile.mkdtemp(prefix="tally-package-")  # the driver serves the file from here
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(folder, "tally.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as zf:
        for base, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(base, name)
                    zf.write(full, os.path.join("tally", os.path.relpath(full, root)))
    sc.addPyFile(archive)
    sc._tally_shipped = True
