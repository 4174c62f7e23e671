"""Session helpers: one place for the settings every job relies on.

Jobs never build their own session; they take the caller's ``SparkSession``.
``get_session`` is for scripts and tests. ``ensure_checkpoint_dir`` reads the
cluster's ``spark.checkpoint.dir`` and only invents a local one when it is
unset (tests, laptops).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the library depends on for correct results (time zone, ANSI) and
# for plans that survive scale (AQE, skew handling, partition sizing).
CORE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # LAST_WIN makes map_concat behave like a dict update (AR10).
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "canvass") -> SparkSession:
    """A session with the library's settings. Master and shuffle partitions
    stay the caller's (spark-submit, cluster defaults) unless given here."""
    builder = (SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false"))
    if master:
        builder = builder.master(master).config("spark.driver.memory", os.environ.get("CANVASS_DRIVER_MEMORY", "16g"))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in CORE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def local_session(app_name: str = "canvass") -> SparkSession:
    """``local[BENCH_CPUS]`` with as many shuffle partitions, for bench and tools."""
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    return get_session(f"local[{cpus}]", cpus, app_name)


def apply_core_conf(spark: SparkSession) -> SparkSession:
    """Pin the settings results depend on in an existing session."""
    for k in ("spark.sql.session.timeZone", "spark.sql.mapKeyDedupPolicy"):
        spark.conf.set(k, CORE_CONF[k])
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` must name a shared (HDFS/S3/...)
    folder; without it this raises. Only a local session (tests, laptops) that
    has none gets a fresh temporary folder.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - e.g. a Spark Connect session: no local context to set
        return spark.conf.get("spark.checkpoint.dir", "") or ""
    current = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir is not set: name a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="canvass-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return conf_dir
