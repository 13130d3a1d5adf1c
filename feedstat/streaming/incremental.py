"""Archives picked up as they arrive.

This runs the same expansion as
:func:`feedstat.plans.jobs.archive_job`, with Structured Streaming keeping the list
of archives already seen.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from feedstat.plans.jobs import ingest_archives

# Fixed value: columns of Spark's binaryFile source.
BINARY_FILE = "path string, modificationTime timestamp, length bigint, content binary"


def expand_arrivals(
    spark: SparkSession, inbound: str, landing: str, ledger: str, checkpoint: str,
    archives_per_batch: int = 1_000,
) -> StreamingQuery:
    """Expand the archives that arrived since the last run, then stop.

    ``checkpoint`` is a shared folder that belongs to this query. A batch that is
    repeated after a failure replaces its own folders in ``landing``.
    """
    arrivals = (
        spark.readStream.format("binaryFile")
        .schema(BINARY_FILE)
        .options(pathGlobFilter="*.zip", recursiveFileLookup=True, maxFilesPerTrigger=archives_per_batch)
        .load(inbound)
        .select("path", "content")
    )

    def expand(batch: DataFrame, _: int) -> None:
        ingest_archives(batch.sparkSession, batch, landing, ledger)

    return (
        arrivals.writeStream.foreachBatch(expand)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
