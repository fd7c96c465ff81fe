"""Session defaults the jobs rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Set at run time on any session, also one the caller made. Timestamps are
# rendered into row identities, so every run must read them in the same zone.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to ``spark`` and return it."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: str = "*", name: str = "tripguard") -> SparkSession:
    """A session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    return prepare(builder.getOrCreate())


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's ``spark.checkpoint.dir``; a scratch one only if unset."""
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    shared = context.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if shared is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a shared folder")
        import tempfile

        shared = tempfile.mkdtemp(prefix="tripguard-checkpoint-")
    context.setCheckpointDir(shared)
