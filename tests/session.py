"""Local session used by tests and checks."""

import os

from pyspark.sql import SparkSession

#: Settings under which no input counts as small.
LARGE = {"spark.tidemark.singleTaskRows": "-1", "spark.sql.autoBroadcastJoinThreshold": "-1"}


def build(**extra: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{os.environ.get('TEST_CPUS', '8')}]")
        .appName("tidemark-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in extra.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
