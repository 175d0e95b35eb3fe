"""A local session for tests and timing. On a cluster, jobs use the session they are given."""

from pyspark.sql import SparkSession


def local_session(
    cores: int | str = "*", shuffle_partitions: int = 8, conf: dict[str, str] | None = None
) -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("stipend")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        # Plans name whole paths, which tests look for, however long these are.
        .config("spark.sql.maxMetadataStringLength", "1000")
        .config(map=conf or {})
        .getOrCreate()
    )
