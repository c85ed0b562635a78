"""Session settings the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Wall-clock values are TIMESTAMP_NTZ columns computed from UTC instants, so the session zone must be UTC.
REQUIRED = {"spark.sql.session.timeZone": "UTC"}

# Run-time re-planning: broadcast by measured size, split skewed join partitions, coalesce small ones.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def local_session(cores: int | str = "*", app: str = "parceltrail", shuffle_partitions: int = 8) -> SparkSession:
    """A single-JVM session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in {**REQUIRED, **RECOMMENDED}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session somebody else created."""
    for key, value in {**REQUIRED, **RECOMMENDED}.items():
        spark.conf.set(key, value)
    return spark


def require_utc(spark: SparkSession) -> None:
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise ValueError(f"spark.sql.session.timeZone must be UTC, found {zone}")
