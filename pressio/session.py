"""Spark session settings the pipeline relies on."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings whose values change results or plans; applied to every session.
SESSION_CONF = {
    # calendar days are taken as written; timestamps never shift zone
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Whole-stage code for a subtree whose method would exceed the JIT's
    # huge-method limit runs interpreted; fall back to per-operator code
    # generation for such subtrees instead (the wide KPI projections).
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(master: str | None = None, app: str = "pressio",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the pipeline's settings.

    On a cluster ``master`` stays ``None`` and the launcher decides; local
    runs pass ``local[N]``. The web UI is off: nothing here opens a port.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_CONF)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    # checkpoint copies go when nothing refers to them any more
    conf["spark.cleaner.referenceTracking.cleanCheckpoints"] = "true"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k, v in SESSION_CONF.items():
        spark.conf.set(k, v)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder of this session.

    A cluster names it in ``spark.checkpoint.dir``; only where that is unset
    (local runs, tests) a scratch folder is taken so ``checkpoint()`` works.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # a remote (Connect) session: the server names the folder
        return ""
    current = sc.getCheckpointDir()
    if current:
        return current
    named = sc.getConf().get("spark.checkpoint.dir", None)
    if not named:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):  # executors in other processes
            raise RuntimeError(
                "set spark.checkpoint.dir to a folder shared by all executors; "
                "a machine-local folder cannot hold checkpoints on a cluster")
        named = tempfile.mkdtemp(prefix="pressio-ckpt-")
    sc.setCheckpointDir(named)
    return sc.getCheckpointDir()


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the session's checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def drop_folder(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def apply_conf(spark: SparkSession) -> SparkSession:
    for k, v in SESSION_CONF.items():
        spark.conf.set(k, v)
    return spark

