"""Runtime settings that the plans profit from."""

from __future__ import annotations

from pyspark.sql import SparkSession


def tune(spark: SparkSession) -> SparkSession:
    """Settings for wide cleaning projections; safe to repeat.

    The JVM never compiles a method above 8000 bytecodes. Spark fuses a wide projection into one method that can be
    longer; with this limit such a stage runs operator by operator, in small compiled methods, several times faster.
    """
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    return spark


def local_session(cores="*", name="wattfold", **settings) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(name)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
    )
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)
