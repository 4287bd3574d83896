"""Session settings that the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def shuffle_partitions(input_bytes: int) -> int:
    """Shuffle partitions for a job over ``input_bytes``: about 200 MB each, at most 100,000.

    Adaptive execution merges partitions that turn out small but never adds any, so the
    starting number has to suit the largest shuffle.
    """
    return max(200, min(100_000, input_bytes // 200_000_000))


def build_session(
    app_name: str = "starmart", master: str | None = None, input_bytes: int | None = None, **conf: str
) -> SparkSession:
    """A session in UTC with adaptive execution; everything else stays the cluster's choice."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    }
    if input_bytes:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions(input_bytes))
    settings |= conf
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
