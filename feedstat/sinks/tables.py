"""Catalog tables over written data."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pyspark.sql.types import StructType

from feedstat.session import materialize, scratch_path
from feedstat.sources.listing import list_files


def _quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _location(spark: SparkSession, name: str) -> str:
    details = spark.sql(f"DESCRIBE TABLE EXTENDED {_quoted(name)}")
    return details.where("col_name = 'Location'").first().data_type


def _same_place(one: str, other: str) -> bool:
    plain = [re.sub(r"^[A-Za-z0-9]+:/*", "/", p).rstrip("/") for p in (one, other)]
    return plain[0] == plain[1]


def register_table(
    spark: SparkSession,
    name: str,
    path: str,
    fmt: str = "parquet",
    schema: StructType | None = None,
    partitioned_by: Sequence[str] = (),
    **options: str,
) -> DataFrame:
    """Make ``name`` a table over ``path``: created when absent, re-pointed when present.

    A partitioned table needs its ``schema``, which fixes the types of the partition
    columns; its folders are found on creation and again on every refresh. When it
    moves to another path its old partitions must not stay, so its definition, not its
    data, is replaced.
    """
    table = _quoted(name)
    exists = spark.catalog.tableExists(name)
    if exists and not _same_place(_location(spark, name), path):
        if not partitioned_by:
            spark.sql(f"ALTER TABLE {table} SET LOCATION {_text(path)}")
        elif spark.catalog.getTable(name).tableType == "EXTERNAL":
            spark.sql(f"DROP TABLE {table}")
            exists = False
        else:
            raise ValueError(f"{name} owns its data and cannot be moved")
    if not exists:
        columns = f"({schema.toDDL()})" if schema is not None else ""
        settings = ", ".join(f"{_text(k)} {_text(str(v))}" for k, v in options.items())
        settings = f"OPTIONS ({settings})" if settings else ""
        folders = f"PARTITIONED BY ({', '.join(map(_quoted, partitioned_by))})" if partitioned_by else ""
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table} {columns} USING {fmt} {settings} {folders} "
            f"LOCATION {_text(path)}"
        )
    if partitioned_by:
        spark.sql(f"MSCK REPAIR TABLE {table} SYNC PARTITIONS")
    spark.catalog.refreshTable(name)
    return spark.table(name)


def escaped(name: str) -> str:
    """A partition value as part of a path."""
    special = set("\"#%'*/:=?\\{}[]^")
    return "".join(f"%{ord(c):02X}" if c in special or ord(c) < 32 else c for c in name)


def file_manifest(spark: SparkSession, root: str) -> DataFrame:
    """(ticker, period, modified) of the folders ``ticker=.../period=...`` below ``root``, by their last modified file."""
    files = list_files(spark, root)
    raw = {name: F.regexp_extract("path", f"/{name}=([^/]+)/", 1) for name in ("ticker", "period")}
    parts = [F.url_decode(F.replace(value, F.lit("+"), F.lit("%2B"))).alias(name) for name, value in raw.items()]
    return files.select(*parts, "modified").groupBy("ticker", "period").agg(F.max("modified").alias("modified"))


def newest_periods(manifest: DataFrame) -> DataFrame:
    """Written (ticker, period): the period of every ticker that was delivered last, of several the latest period."""
    last = manifest.groupBy("ticker").agg(F.max(F.struct("modified", "period")).alias("last"))
    return materialize(last.select("ticker", F.col("last.period").alias("period")), "newest-periods")


def register_current(
    spark: SparkSession, name: str, table: str, ticker: str = "ticker", period: str = "period",
    manifest: DataFrame | None = None,
) -> DataFrame:
    """A view of the newest period of every ticker.

    Without a ``manifest`` the newest period is the greatest one, whenever the view is read. With
    the (ticker, period, modified) rows of one it is the period delivered last, as of now, so a
    month that is delivered again becomes current.
    """
    t, p = f"`{ticker}`", f"`{period}`"
    newest = f"SELECT {t}, max({p}) AS {p} FROM {_quoted(table)} GROUP BY {t}"
    if manifest is not None:
        path = scratch_path(spark, "current-periods")
        newest_periods(manifest).write.parquet(path)
        newest = f"SELECT `ticker` AS {t}, `period` AS {p} FROM parquet.`{path}`"
    spark.sql(
        f"CREATE OR REPLACE VIEW {_quoted(name)} AS SELECT a.* FROM {_quoted(table)} a "
        f"LEFT SEMI JOIN ({newest}) b ON a.{t} = b.{t} AND a.{p} = b.{p}"
    )
    return spark.table(name)


def register_ticker_tables(
    spark: SparkSession, newest: DataFrame, prefix: str, root: str, fmt: str = "csv", **options: str
) -> list[str]:
    """One table per ticker over the folder of its newest period.

    ``newest`` holds one (ticker, period) row per ticker. Catalog commands run on
    the driver, one per ticker, streamed. Two tickers whose table names would be the same
    stop the job before the second takes the first one's table.
    """
    names: dict[str, str] = {}
    for row in newest.select("ticker", "period").toLocalIterator():
        name = f"{prefix}_{row.ticker}".lower().replace("-", "_").replace(" ", "_")
        if name in names:
            raise ValueError(f"two tickers would have the table {name}, {names[name]} and {row.ticker}")
        folder = f"ticker={escaped(row.ticker)}/period={escaped(row.period)}"
        register_table(spark, name, f"{root}/{folder}", fmt, **options)
        names[name] = row.ticker
    return list(names)
