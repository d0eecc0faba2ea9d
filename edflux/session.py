"""Session settings the library relies on, and the shared checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings every run needs: naive timestamps compared in UTC, ANSI casts that fail
# loudly on bad text, adaptive execution for partition coalescing and skew joins.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(
    master: str | None = None,
    app_name: str = "edflux",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the settings of ``REQUIRED_CONF``.

    On a cluster pass ``master=None`` and let spark-submit decide; tests and the
    bench pass ``local[N]``. The web UI stays off.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.ui.enabled", "false")
        # Checkpoints of edition-sized tables are removed once their DataFrames are gone.
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in REQUIRED_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra_conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    apply_required_conf(spark, skip=set(extra_conf or ()))
    return spark


def apply_required_conf(spark: SparkSession, skip: set[str] | None = None) -> None:
    """Set the runtime SQL settings on an existing session (e.g. the driver's)."""
    for key, value in REQUIRED_CONF.items():
        if key not in (skip or ()):
            spark.conf.set(key, value)


def checkpoint_folder(spark: SparkSession) -> str | None:
    """The checkpoint folder that the session names, if any."""
    try:
        current = spark.sparkContext.getCheckpointDir()
    except Exception:  # Spark Connect has no context
        current = None
    return current or spark.conf.get("spark.checkpoint.dir", None)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster must name a shared folder (HDFS, object store). Only a local-mode
    session that names none (tests, bench) gets a fresh temporary folder.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server's spark.checkpoint.dir applies
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("spark.checkpoint.dir is not set on the Spark Connect server")
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; name a shared folder for checkpoints on a cluster"
        )
    folder = tempfile.mkdtemp(prefix="edflux-ckpt-")
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir() or folder
