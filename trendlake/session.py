"""Spark session and shared-folder helpers.

The library never builds its own cluster layout: on a cluster the session is
handed in and its settings win. ``local_session`` is for tests, the bench and
the smoke entry only.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

# Settings a job needs whatever the cluster: ANSI-safe parsing is done with
# try_* functions, so the only hard requirement is a fixed session zone for
# reproducible dates.
_JOB_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "trendlake") -> SparkSession:
    """A local session for tests and the bench (never used on a cluster)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in _JOB_DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting points at shared storage and is only read. When
    it is unset (tests, local runs) a fresh local folder is taken and set.
    """
    sc = spark.sparkContext
    conf_dir = (spark.conf.get("spark.checkpoint.dir", None)
                or sc.getConf().get("spark.checkpoint.dir", None))
    if not conf_dir:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        # local runs only: the cluster names its shared folder in the config
        conf_dir = tempfile.mkdtemp(prefix="trendlake-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(conf_dir)
    return conf_dir


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A fresh path under the shared checkpoint folder (for lineage cuts,
    stream checkpoints and hand-off tables)."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, *parts, uuid.uuid4().hex)


def ship(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of any cluster (as
    ``--py-files`` would), once for each session and state of the code."""
    package = Path(__file__).resolve().parent
    files = sorted(package.rglob("*.py"))
    digest = hashlib.sha256(b"".join(f.read_bytes() for f in files)).hexdigest()[:12]
    name = f"{package.name}-{digest}.zip"
    if name in spark.sparkContext._python_includes:
        return
    path = os.path.join(tempfile.mkdtemp(prefix="trendlake-package-"), name)
    with zipfile.ZipFile(path, "w") as z:
        for f in files:
            z.write(f, f.relative_to(package.parent).as_posix())
    spark.sparkContext.addPyFile(path)
