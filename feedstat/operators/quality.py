"""Gates on feeds: column names and control totals."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedstat.sources.sidecars import first_lines, split_header

#: From inside a quoted cell to behind the quote that ends it; a doubled quote stays inside.
CLOSING = re.compile(r'[^"]*(?:""[^"]*)*"(?!")')


def ends_inside(line: str, inside: bool, sep: str) -> bool:
    """Whether a line leaves a quoted cell open, if it starts inside one or not.

    A quote opens a cell only where the cell starts; elsewhere it is a letter like others.
    """
    place = 0 if inside else -1
    if not inside and line.startswith('"'):
        place = 1
    while True:
        if place >= 0:
            closed = CLOSING.match(line, place)
            if closed is None:
                return True
            place = closed.end()
        opens = line.find(sep + '"', max(place, 0))
        if opens < 0:
            return False
        place = opens + len(sep) + 1


def block_records(lines: DataFrame, sep: str) -> DataFrame:
    """The records of each block of a file, from lines (file, start, place, value) in the order in which a scan gives them.

    A record is a line that is not blank and does not start inside a quoted cell. Whether a
    block of a file starts inside one is known only from the blocks before, so each block is
    counted for both cases, with the case it leaves to the next; running sums over the blocks
    of a file then pick one. Only lines with quotes leave the JVM.

    Returns (file, start, place, n_lines, n_records, lead, head): the place of the block's first line,
    its number of lines, the records that start in it, the lines in front that end a record of a
    block before, and the lines up to the end of its first record (null where that isn't in it).
    """
    counted = "outside long, inside long, then_outside int, then_inside int, lead long, head long"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, now, counts = None, [0, 1], [0, 0]  # state and records, by the state at the block's start
        place, seen, lead, opened, head = 0, 0, None, False, None

        def out() -> pa.RecordBatch:
            kinds = [pa.string(), *[pa.int64()] * 5, *[pa.int32()] * 2, *[pa.int64()] * 2]
            names = ["file", "start", "place", "n_lines", "outside", "inside", "then_outside", "then_inside", "lead", "head"]
            row = (*block, place, seen, *counts, *now, seen if lead is None else lead, head)
            return pa.RecordBatch.from_arrays([pa.array([v], kind) for v, kind in zip(row, kinds)], names)

        for batch in batches:
            if not batch.num_rows:
                continue
            start, file = batch["start"].to_numpy(), batch["file"]
            filled = np.concatenate(([0], np.cumsum(batch["filled"].to_numpy(zero_copy_only=False))))
            quoted = np.flatnonzero(batch["quoted"].is_valid().to_numpy(zero_copy_only=False))
            other = pc.not_equal(file.slice(1), file.slice(0, len(file) - 1)).to_numpy(zero_copy_only=False)
            edges = np.flatnonzero(other | (start[1:] != start[:-1])) + 1
            for a, b in zip([0, *edges.tolist()], [*edges.tolist(), batch.num_rows]):
                own = file[a].as_py(), int(start[a])
                if own != block:
                    if block is not None:
                        yield out()
                    block, now, counts = own, [0, 1], [0, 0]
                    place, seen, lead, opened, head = batch["place"][a].as_py(), 0, None, False, None
                done = a
                for line in [*quoted[np.searchsorted(quoted, a) : np.searchsorted(quoted, b)].tolist(), None]:
                    # the line with quotes itself is counted by the state before it
                    stop = b if line is None else line + 1
                    for k in (0, 1):
                        counts[k] += int(filled[stop] - filled[done]) if now[k] == 0 else 0
                    if now[0] == 0 and not opened and filled[stop] > filled[done]:
                        first = int(np.searchsorted(filled, filled[done] + 1))  # behind the first line that is not blank
                        opened, head = True, seen + first - done if first < stop or line is None else None
                    seen, done = seen + stop - done, stop
                    if line is not None:
                        text = batch["quoted"][line].as_py()
                        after = [int(ends_inside(text, inside, sep)) for inside in (False, True)]
                        now = [after[now[0]], after[now[1]]]
                    if opened and head is None and now[0] == 0:
                        head = seen
                    if lead is None and now[1] == 0:
                        lead = seen
        if block is not None:
            yield out()

    narrow = lines.select(
        "file", "start", "place", (F.length(F.trim("value")) > 0).alias("filled"),
        F.when(F.contains("value", F.lit('"')), F.col("value")).alias("quoted"),
    )
    blocks = narrow.mapInArrow(count, f"file string, start long, place long, n_lines long, {counted}")
    upto = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    # a block sets the state, keeps it, or turns it over
    sets, turns = F.col("then_outside") == F.col("then_inside"), (F.col("then_outside") > F.col("then_inside")).cast("int")
    states = blocks.withColumn("turns", F.sum(turns).over(upto)).withColumns({
        "set": F.coalesce(F.last(F.when(sets, F.col("then_outside")), ignorenulls=True).over(before), F.lit(0)),
        "since": F.coalesce(F.last("turns").over(before), F.lit(0))
        - F.coalesce(F.last(F.when(sets, F.col("turns")), ignorenulls=True).over(before), F.lit(0)),
    })
    inside = (F.col("set") + F.col("since")) % 2 == 1
    return states.select(
        "file", "start", "place", "n_lines", F.when(inside, F.col("inside")).otherwise(F.col("outside")).alias("n_records"),
        F.when(inside, F.col("lead")).otherwise(F.lit(0)).alias("lead"), F.when(~inside, F.col("head")).alias("head"),
    )


def record_counts(lines: DataFrame, sep: str) -> DataFrame:
    """(file, n_records) from lines as :func:`block_records` takes them."""
    return block_records(lines, sep).groupBy("file").agg(F.sum("n_records").alias("n_records"))


def feed_facts(spark: SparkSession, path: str, dataset_pattern: str, sep: str = "|") -> DataFrame:
    """(dataset, headers, n_rows) of delimited files with a header line, in one text scan.

    A dataset can have many files, and a file many splits: the header is the first
    line of a file's first split. Rows are records as the delimited reader counts them: blank
    lines are none, and a quoted cell may hold line breaks. Lines are only counted, never sorted.
    """
    lines = spark.read.option("recursiveFileLookup", True).text(path)
    lines = lines.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("place"), "value",
    )
    dataset = F.regexp_extract("file", dataset_pattern, 1).alias("dataset")
    rows = record_counts(lines, sep).select(dataset, F.greatest(F.col("n_records") - 1, F.lit(0)).alias("n_rows"))
    counts = rows.groupBy("dataset").agg(F.sum("n_rows").alias("n_rows"))
    headers = first_lines(spark, path, dataset_pattern).groupBy("dataset").agg(F.collect_set("value").alias("headers"))
    return headers.join(counts, "dataset", "left").select("dataset", "headers", F.coalesce("n_rows", F.lit(0)).cast("long").alias("n_rows"))


def row_counts(df: DataFrame, dataset: str) -> DataFrame:
    """(dataset, n_rows) of a parsed table."""
    return df.groupBy(F.col(dataset).alias("dataset")).agg(F.count(F.lit(1)).alias("n_rows"))


def feed_columns(facts: DataFrame, sep: str = "|") -> DataFrame:
    """(dataset, column_name) found in the header lines of :func:`feed_facts`."""
    return (
        facts.select("dataset", F.explode("headers").alias("header"))
        .select("dataset", F.explode(split_header(F.col("header"), sep)).alias("column_name"))
        .distinct()
    )


def check_headers(found: DataFrame, expected: DataFrame, fail: bool = False) -> DataFrame:
    """(dataset, passed, missing, extra): both name sets must be equal, in any order.

    ``fail`` stops the job at the first dataset that does not pass.
    """
    both = found.withColumn("in_feed", F.lit(True)).join(
        expected.distinct().withColumn("in_header_file", F.lit(True)),
        ["dataset", "column_name"],
        "full_outer",
    )
    missing = F.array_sort(F.collect_set(F.when(F.col("in_feed").isNull(), F.col("column_name"))))
    extra = F.array_sort(F.collect_set(F.when(F.col("in_header_file").isNull(), F.col("column_name"))))
    checks = both.groupBy("dataset").agg(missing.alias("missing"), extra.alias("extra"))
    checks = checks.select(
        "dataset", ((F.size("missing") == 0) & (F.size("extra") == 0)).alias("passed"), "missing", "extra"
    )
    return _stop(checks, "header check failed for ") if fail else checks


def check_counts(found: DataFrame, expected: DataFrame, fail: bool = False) -> DataFrame:
    """(dataset, expected, actual, passed): the control total must be the raw row count.

    A total that is no number, or has no feed, does not pass.
    """
    checks = found.join(expected, "dataset", "full_outer").select(
        "dataset",
        "expected",
        F.coalesce("n_rows", F.lit(0)).cast("bigint").alias("actual"),
        F.coalesce(F.col("expected") == F.col("n_rows"), F.lit(False)).alias("passed"),
    )
    return _stop(checks, "row count check failed for ") if fail else checks


def _stop(checks: DataFrame, message: str) -> DataFrame:
    error = F.raise_error(F.concat(F.lit(message), F.col("dataset"))).cast("boolean")
    return checks.withColumn("passed", F.when(F.col("passed"), F.lit(True)).otherwise(error))
