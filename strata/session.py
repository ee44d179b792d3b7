"""SparkSession helpers.

On a cluster the session is built by the platform; ``spark.checkpoint.dir``
then points at a shared folder and is used as is.  Only when it is unset
(local runs, tests) do we set a scratch folder of our own.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "strata", extra: dict | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # wide cohort rows make long generated methods; above 8000 bytes of
        # bytecode the JVM never JIT-compiles them, so let Spark split them
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # metric histograms are checkpointed; drop the files with their RDDs
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", "16g")
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the session's checkpoint folder.

    On a cluster it must be a shared folder named by ``spark.checkpoint.dir``
    (a machine-local folder would not survive a lost executor); only a local
    master (tests, single-machine runs) gets a scratch folder of our own."""
    current = spark.conf.get("spark.checkpoint.dir", None)
    sc = getattr(spark, "sparkContext", None)
    if not current and sc is not None:
        try:
            current = sc.getCheckpointDir()
        except Exception:  # noqa: BLE001 - not available on every session type
            current = None
    if not current:
        master = spark.conf.get("spark.master", "") or (sc.master if sc is not None else "")
        if fallback is None and not str(master).startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/object store) "
                               "before running strata operators on a cluster")
        current = fallback or tempfile.mkdtemp(prefix="strata-ckpt-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", current)
    if sc is not None:
        sc.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "tables", name)
