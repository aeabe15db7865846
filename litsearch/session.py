"""Session settings the library is tuned for."""

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app_name: str = "litsearch",
                  settings: dict[str, str] | None = None) -> SparkSession:
    """A session with adaptive execution on.

    Partition counts, memory and ``spark.checkpoint.dir`` belong to the cluster;
    pass them in ``settings`` only where the cluster does not set them.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
    }
    for name, value in {**defaults, **(settings or {})}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
