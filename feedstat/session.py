"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Bytes of rows that Spark hands to a Python task at once, where a job asks for small batches.
ARROW_BYTES = 2 << 20
ARROW_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def build_session(app_name: str = "feedstat", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library is written for.

    Shuffle width is left to the cluster and AQE: pass
    ``**{"spark.sql.shuffle.partitions": "..."}`` to set the width AQE starts from.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables: the one ``spark.checkpoint.dir`` names.

    Where that is unset, as in tests, a folder of this application under the
    session's warehouse, which every executor reaches as it reaches the tables there.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    return f"{warehouse}/_scratch/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path in the scratch folder that no other call gets."""
    return f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs run inside hand ``ARROW_BYTES`` of rows to Python tasks at once, or one longer row.

    Without it a batch has 10,000 rows, which are held several times, by the executor and by its
    Python tasks: texts of some KB make that much memory. A limit set by the session's user stays.
    """
    own = spark.conf.get(ARROW_SETTING, None) is None
    if own:
        spark.conf.set(ARROW_SETTING, ARROW_BYTES)
    try:
        yield
    finally:
        if own:
            spark.conf.unset(ARROW_SETTING)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared scratch folder and read it back.

    The result survives the loss of executors, is never computed a second time,
    has a row count that comes from the file footers, and a known size, so
    Catalyst broadcasts it only below ``spark.sql.autoBroadcastJoinThreshold``.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
