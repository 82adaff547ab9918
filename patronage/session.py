"""A session with the settings the operators are planned for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build(app: str = "patronage", master: str | None = None, **conf: str) -> SparkSession:
    """Adaptive execution with skew handling; extra settings as key_with_underscores=value.

    Shuffle partitions are left to the cluster: set spark.sql.shuffle.partitions to a
    few times its cores (adaptive execution merges small ones), and
    spark.checkpoint.dir to a folder all executors share (stages are stored there;
    functions.stages.drop_stages removes them at the end of a run).
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        # Call-site capture costs several JVM round trips per column expression.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    settings |= conf
    for key, value in settings.items():
        b = b.config(key, value)
    return b.getOrCreate()
