"""Session settings for local runs; on a cluster the submitted conf wins."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(app: str = "sparkmart", cores: int | str = "*", **conf: str) -> SparkSession:
    """A local session with AQE on, UTC time and no web page."""
    cpus = 8 if cores == "*" else int(cores)
    settings = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": str(cpus),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Folder-per-value writes keep a few files open instead of sorting every task first.
        "spark.sql.maxConcurrentOutputFileWriters": "32",
        "spark.driver.memory": "8g",
        **{k.replace("__", "."): v for k, v in conf.items()},
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
