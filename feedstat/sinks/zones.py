"""Movement of datasets between zones, and rotation of snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedstat.operators.quality import block_records, record_counts
from feedstat.session import materialize
from feedstat.sinks.files import together
from feedstat.sinks.tables import newest_periods, register_table
from feedstat.sources.listing import dataset_name


def promote(
    spark: SparkSession, source: str, target: str, sep: str = ",", dataset_pattern: str | None = None
) -> DataFrame:
    """Carry the files of one zone to the next, in one folder per dataset.

    A dataset is named by its file, up to the first dot, or by the group of a regular
    expression on the file path. Lines are carried as they are, each file into a folder of its
    own below its dataset's: every file keeps its header, its columns and its quoted line breaks. A file of
    several blocks becomes a part per block, each with the header (which ends in the first block) and
    whole records, so a large file is many tasks. Only the folders of files carried over are replaced in ``target``; other datasets stay. Returns
    the datasets of ``source`` with their number of rows in ``target``.
    """
    read = spark.read.options(recursiveFileLookup=True, lineSep="\n").text(source)
    path = F.col("_metadata.file_path")
    name = (
        F.regexp_extract(path, dataset_pattern, 1) if dataset_pattern
        else dataset_name(F.col("_metadata.file_name"))
    )
    folder = ["dataset", "source_file"]
    lines = read.select(
        name.alias("dataset"), F.col("_metadata.file_name").alias("source_file"), path.alias("file"),
        F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("place"), "value",
    )
    plain = lines.withColumn("value", F.rtrim("value", F.lit("\r")))
    parts = materialize(part_plan(block_records(plain, sep), lines.select(*folder, "file").distinct()), "promoted-parts")
    spread = parts.agg(F.max("part")).first()[0] or 0
    width = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spread + 1)
    keyed = lines.join(parts.drop(*folder), ["file", "start"])
    line = F.col("place") - F.col("first_place")
    of_header = (line < F.col("head")) & (F.col("last_part") > F.col("part"))
    own = F.when(line < F.col("lead"), F.col("lead_part")).otherwise(F.col("part"))
    dealt = keyed.select(
        *folder, "file", "start", "place", "value",
        F.explode(F.when(of_header, F.sequence("part", "last_part")).otherwise(F.array(own))).alias("part"),
    )
    # no task gets two parts of a folder, so a header stands only at the top of what is written
    task = F.pmod(F.hash(*folder).cast("long") + F.col("part"), F.lit(width)).cast("int")
    ordered = dealt.repartitionById(width, task).sortWithinPartitions(*folder, "part", "file", "start", "place")
    writer = ordered.select(*folder, "value").write.partitionBy(*folder)
    writer.mode("overwrite").options(partitionOverwriteMode="dynamic", lineSep="\n").text(target)
    carried = materialize(parts.select("dataset").distinct(), "carried-datasets")
    # paths have no line breaks, so the name of the dataset can follow them
    written = spark.read.schema("value string, dataset string, source_file string").text(target).select(
        F.concat_ws("\n", path, "dataset").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("place"), "value",
    )
    rows = record_counts(written, sep).select(
        F.regexp_extract("file", "^.*\n?([\\s\\S]*)$", 1).alias("dataset"), F.greatest(F.col("n_records") - 1, F.lit(0)).alias("n_rows")
    )
    counts = rows.groupBy("dataset").agg(F.sum("n_rows").alias("n_rows"))
    return carried.join(counts, "dataset", "left").select("dataset", F.coalesce("n_rows", F.lit(0)).alias("n_rows"))


def part_plan(blocks: DataFrame, names: DataFrame) -> DataFrame:
    """Which part of its folder each block of a file goes to, from ``block_records`` and (dataset, source_file, file).

    ``part`` takes the lines from the block's first record on, ``lead_part`` those before; ``head`` is
    set in the first block of a file, with ``last_part`` the last part of the file. One row per block.
    """
    whole = Window.partitionBy("dataset", "source_file").orderBy("file", "start")
    file = Window.partitionBy("dataset", "source_file", "file")
    begins = (F.col("lead") < F.col("n_lines")).cast("int")
    numbered = blocks.join(names, "file").withColumn("part", F.sum(begins).over(whole) - 1)
    first = F.col("start") == F.min("start").over(file)
    return numbered.select(
        "dataset", "source_file", "file", "start", F.col("place").alias("first_place"), "lead",
        (F.col("part") - begins).alias("lead_part"), "part", F.max("part").over(file).alias("last_part"),
        F.when(first, F.coalesce("head", F.lit(0))).otherwise(F.lit(0)).alias("head"),
    )


def rotate(
    spark: SparkSession, table: str, rows: DataFrame, current: str, archive: str,
    ticker: str = "ticker", period: str = "period", manifest: DataFrame | None = None,
) -> DataFrame:
    """Keep the newest period of every ticker in ``current`` and add the rest to ``archive``.

    The newest period is the greatest one or, with a ``manifest`` (ticker, period, modified) of the
    files, the one delivered last.

    Both are new paths or append targets, never the one ``rows`` are read from; the
    table is pointed at ``current`` only after it is complete.
    """
    # written first, so its size is known where it is joined and large tables stay where they are
    if manifest is None:
        newest = materialize(rows.groupBy(ticker).agg(F.max(period).alias(period)), "newest-periods")
    else:
        newest = newest_periods(manifest).withColumnsRenamed({"ticker": ticker, "period": period})
    for how, path, mode in (("left_anti", archive, "overwrite"), ("left_semi", current, "errorifexists")):
        part = together(rows.join(newest, [ticker, period], how), [ticker, period])
        # a retry replaces the folders of its own periods in the archive and adds no row twice
        part.write.partitionBy(ticker, period).mode(mode).option("partitionOverwriteMode", "dynamic").parquet(path)
    return register_table(
        spark, table, current, schema=rows.schema, partitioned_by=[ticker, period]
    )
