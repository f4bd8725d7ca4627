"""Session helpers: the settings every job in this package assumes.

Only settings that are *semantic* (time zone, ANSI) are forced. Sizing knobs
(shuffle partitions, broadcast threshold, file sizes) are left to whoever builds
the session for the cluster; ``local_session`` picks values for tests and the
bench on one machine.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings the results depend on (timestamps in the test tables are naive and
# the reference engines treat them as UTC wall-clock values).
SEMANTIC_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# Settings the plans are designed around (runtime re-planning, skew splits,
# rebalance before partitioned writes).
PLAN_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the semantic and plan settings to an existing session."""
    for key, value in {**SEMANTIC_CONF, **PLAN_CONF}.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "stratum", conf: dict[str, str] | None = None) -> SparkSession:
    """A single-JVM session for tests and the local bench; ``conf`` adds settings."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in {**SEMANTIC_CONF, **PLAN_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``, which whoever launches the job sets
    to a folder every executor can reach."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        raise RuntimeError(
            "spark.checkpoint.dir is not set; set it to a shared folder "
            "(checkpoints and staging tables are written there)")
    spark.sparkContext.setCheckpointDir(configured)
    return configured
