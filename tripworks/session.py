"""Session settings the library relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(
    cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tripworks", shared: str | None = None
) -> SparkSession:
    """Session for tests and benches on one machine; a cluster brings its own. ``shared``: folder for scratch tables."""
    builder = SparkSession.builder
    if shared is not None:
        builder = builder.config("spark.checkpoint.dir", shared).config("spark.sql.warehouse.dir", f"{shared}/warehouse")
    return prepare(
        builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


# HotSpot never compiles a method above this size, so such generated code would be interpreted.
JIT_METHOD_LIMIT = 8000


def prepare(spark: SparkSession) -> SparkSession:
    """Set what the library relies on in a session it was given.

    Trip times are UTC wall-clock times, so the session must read them as such. Stages whose
    generated code would be too big for the JIT fall back to separately compiled projections.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", str(JIT_METHOD_LIMIT))
    return spark
