"""Session construction and the shared working folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

# Settings every job relies on for correct results (not tuning):
# UTC so month starts / day cuts are stable; ANSI so bad casts fail loudly
# (tolerant parsing uses try_cast explicitly).
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# Tuning defaults for local runs; a cluster session brings its own.
LOCAL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.memory": "8g",
}


def get_session(master: str | None = None, shuffle_partitions: int = 8,
                app_name: str = "cohortlab", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the operators assume."""
    master = master or os.environ.get("COHORTLAB_MASTER", "local[8]")
    b = SparkSession.builder.master(master).appName(app_name)
    conf = dict(LOCAL_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(REQUIRED_CONF)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_required_conf(spark)
    return spark


def apply_required_conf(spark: SparkSession) -> None:
    """Pin the settings results depend on, also on a session we did not build."""
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)


def shared_dir(spark: SparkSession) -> str:
    """Folder shared by all executors: the cluster's ``spark.checkpoint.dir``.

    Only a local session (one machine) that names none gets a folder of its
    own; elsewhere the executors would each write to their own disk, so a
    missing setting is an error.
    """
    d = None
    try:
        d = spark.sparkContext.getCheckpointDir()
    except Exception:  # no SparkContext access (e.g. a remote session)
        d = None
    if not d:
        d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        master = spark.conf.get("spark.master", "")
        if not re.match(r"local(\[|$)", master):
            raise RuntimeError(f"spark.checkpoint.dir must name a folder that all executors share (master {master!r})")
        d = tempfile.mkdtemp(prefix="cohortlab-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", d)
        except Exception:  # core conf may be read-only at runtime; the context setter below suffices
            pass
    try:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(d)
        d = spark.sparkContext.getCheckpointDir() or d
    except Exception:
        pass
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, run-unique path under the shared folder."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete an intermediate folder that this package wrote."""
    if not path.startswith(shared_dir(spark).rstrip("/")):
        raise ValueError(f"{path} is not under the shared folder")
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


_SHIPPED: dict[str, tempfile.TemporaryDirectory] = {}


def ship_package(spark: SparkSession) -> None:
    """Give the executors' Python workers this package (once per application).

    The driver serves the archive, so no folder has to be shared for it."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    folder = tempfile.TemporaryDirectory(prefix="cohortlab-code-")
    root = Path(__file__).resolve().parent
    archive = Path(folder.name) / f"{root.name}.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(archive))
    _SHIPPED[app] = folder
