"""Session settings the jobs are designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Runtime SQL settings; each is only set where the cluster has not set it.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split skewed partitions even if that costs a later shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    launched = {key for key, _ in spark.sparkContext.getConf().getAll()}
    for key, value in RUNTIME_CONF.items():
        if key not in launched:
            spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = 8, memory: str = "16g") -> SparkSession:
    """A single-machine session for tests and the bench."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("quernstone")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
