"""Session construction and cluster-shared folders."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on: UTC wall clock for timestamp_ntz arithmetic,
# ANSI errors (a zero sampling rate must fail, not yield inf), AQE for runtime
# coalescing / skew splitting, dynamic partition overwrite for key-replace
# loads that land whole event_dt partitions.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, app: str = "consentflow",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings above.

    ``master`` is only given in tests / local runs; on a cluster the launcher
    decides. The UI stays off: no port beyond what Spark itself needs.
    """
    builder = (SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false"))
    if master:
        builder = builder.master(master)
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    # an existing session keeps its startup conf: apply the runtime settings,
    # caller-supplied values last so they win over the defaults
    for k, v in {**BASE_CONF, **(extra or {})}.items():
        try:
            spark.conf.set(k, v)
        except Exception:  # noqa: BLE001 - static settings cannot change at runtime
            pass
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and staged tables.

    Read ``spark.checkpoint.dir`` from the session (the cluster names a shared
    folder there). Only when it is unset in a local session -- tests -- a scratch
    folder is created and registered; elsewhere that is an error, because a
    folder of one machine would not be seen by the others.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    sc = None
    try:
        sc = spark.sparkContext  # unavailable on Spark Connect sessions
    except Exception:  # noqa: BLE001
        sc = None
    if not path and sc is not None:
        path = sc.getConf().get("spark.checkpoint.dir", None)
    if not path:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        path = tempfile.mkdtemp(prefix="consentflow-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for staged writes."""
    base = checkpoint_dir(spark)
    return os.path.join(base, "consentflow", name) if "://" not in base else f"{base.rstrip('/')}/consentflow/{name}"
