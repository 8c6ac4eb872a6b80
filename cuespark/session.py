"""Session helpers: building a session for local runs, and locating the shared
folder used for checkpoints and written intermediate tables."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter for the plans in this package.  AQE re-plans joins at
# runtime (a shuffled side that turns out small becomes a broadcast; skewed
# partitions of a sort-merge join are split), so no join here needs a blind
# broadcast hint on a data-derived table.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

# Runtime SQL settings applied to an existing session where it still has
# Spark's default.  The feature projections (many string expressions over
# one row) compile to methods above HotSpot's 8000-byte JIT limit; Spark
# then keeps the stage in interpreted bytecode unless it falls back to
# per-expression code generation, which this limit makes it do (3x faster
# measured on the feature table).  Results are unaffected.
RUNTIME_DEFAULTS = {
    "spark.sql.codegen.hugeMethodLimit": ("65535", "8000"),
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "cuespark", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the package defaults.

    On a cluster ``master`` is left to spark-submit; locally pass ``local[N]``.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    conf.update({k: v for k, (_, v) in RUNTIME_DEFAULTS.items()})
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.ui.enabled", "false")
    conf.setdefault("spark.ui.showConsoleProgress", "false")
    conf.setdefault("spark.driver.memory", "16g")
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_runtime_defaults(spark: SparkSession) -> None:
    """Set the runtime settings above where the session still has Spark's
    own default (a value chosen by the user is kept).  They stay set: plans
    are lazy, so the setting must hold when the caller runs the result."""
    for key, (spark_default, ours) in RUNTIME_DEFAULTS.items():
        try:
            current = spark.conf.get(key)
        except Exception:  # noqa: BLE001
            current = spark_default
        if current == spark_default:
            spark.conf.set(key, ours)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder.

    The cluster names it in ``spark.checkpoint.dir``; that value is used as
    is.  Only when it is unset on a ``local`` master (tests) a private folder
    is created, and removed when the process ends; on a cluster every executor
    would write to its own disk, so there it is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - conf lookup raises when unset
            configured = None
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="cuespark-ckpt-")
        atexit.register(shutil.rmtree, configured, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder for written
    intermediate tables (never a machine-local folder on a cluster)."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "tables", f"{name}-{uuid.uuid4().hex[:12]}")


def materialize(df, name: str = "table"):
    """Write ``df`` as parquet under the shared checkpoint folder and return
    the re-read table: lineage is cut (a lost executor re-reads files instead
    of recomputing the plan) and later scans prune columns."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
