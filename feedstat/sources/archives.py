"""Members of zip archives.

There are two ways in. :func:`read_members` is a data source with a partition per member: a
task opens its archive, seeks to its member and streams it, so an archive of any size is
never held and never read twice. It needs a path that Python reaches as Spark does (a shared
file system, or a store that pyarrow knows). Elsewhere archives come as rows (path, content),
the form Spark's ``binaryFile`` source gives: one row holds one compressed archive, which must
stay below ``spark.sql.sources.binaryFile.maxLength`` (2 GB at most). Members stay compressed
until they are read as a stream, in batches.
"""

from __future__ import annotations

import csv as lines_of_cells
import gzip
import io
import re
import zipfile
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
import pyarrow as pa
from pyarrow import csv, fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StringType, StructField, StructType

from feedstat.session import materialize

#: Bytes of text decoded at a time; a member with a longer line is read in larger blocks.
BLOCK_BYTES = 4 << 20
#: Archives whose directories the driver reads at the same time.
LISTING_THREADS = 16


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The zip files below ``path``."""
    return (
        spark.read.format("binaryFile")
        .options(pathGlobFilter="*.zip", recursiveFileLookup=True)
        .load(path)
        .select("path", "content")
    )


def _member_names(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"]):
            with zipfile.ZipFile(io.BytesIO(content)) as archive:
                infos = [i for i in archive.infolist() if not i.is_dir()]
                yield pd.DataFrame({
                    "archive": [path] * len(infos),
                    "member": [i.filename for i in infos],
                    "n_bytes": [i.file_size for i in infos],
                })


def list_members(archives: DataFrame) -> DataFrame:
    """(archive, member, n_bytes) for every member of every archive."""
    return archives.select("path", "content").mapInPandas(
        _member_names, "archive string, member string, n_bytes bigint"
    )


def _members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        wanted = batch["members"] if "members" in batch else [None] * len(batch)
        for path, content, names in zip(batch["path"], batch["content"], wanted):
            with zipfile.ZipFile(io.BytesIO(content)) as archive:
                for info in archive.infolist():
                    if not info.is_dir() and (names is None or info.filename in names):
                        yield pd.DataFrame({
                            "archive": [path],
                            "member": [info.filename],
                            "content": [archive.read(info)],
                        })


def expand_archives(archives: DataFrame, chosen: DataFrame | None = None) -> DataFrame:
    """(archive, member, content) for every member, one member in memory at a time.

    ``chosen`` from :func:`choose_members` restricts the work to those members. It is a
    written table of names, so Spark knows its size and broadcasts it to the archives
    only if it is small.
    """
    rows = archives.select("path", "content")
    if chosen is not None:
        rows = rows.join(chosen, "path")
    return rows.mapInPandas(_members, "archive string, member string, content binary")


def new_members(members: DataFrame, ledger: DataFrame) -> DataFrame:
    """Members whose name is not in the ledger of those already expanded."""
    return members.join(ledger.select("member").distinct(), "member", "left_anti")


def choose_members(
    archives: DataFrame, ledger: DataFrame | None = None, suffix: str = ".csv.gz"
) -> DataFrame:
    """Written table (path, members) of the members to read, without those in the ledger.

    A member that several archives hold is taken from the last of them by path.
    """
    members = list_members(archives).where(F.col("member").endswith(suffix))
    if ledger is not None:
        members = new_members(members, ledger)
    chosen = members.groupBy("member").agg(F.max("archive").alias("path"))
    return materialize(
        chosen.groupBy("path").agg(F.collect_list("member").alias("members")), "chosen-members"
    )


def cell_batches(open_text: Callable[[], io.BufferedIOBase], names: list[str], sep: str = ",") -> Iterator[pa.RecordBatch]:
    """The cells of ``names`` as text, in batches, from delimited text with a header line.

    Columns are found by the names in the header. An empty cell is null, and so are a column
    the text lacks and the cells that a short line lacks; quoted cells may hold line breaks and
    blank lines are skipped. A line with more cells than its header fails. Short lines come
    last. ``open_text`` is called again, with larger blocks, where a line did not fit one.
    """
    convert = csv.ConvertOptions(
        column_types={name: pa.string() for name in names}, include_columns=names,
        include_missing_columns=True, strings_can_be_null=True, null_values=[""],
    )
    block, done = BLOCK_BYTES, 0
    while True:
        short: list[str] = []

        def keep_short(row) -> str:
            if row.actual_columns > row.expected_columns:
                return "error"
            short.append(row.text)
            return "skip"

        parse = csv.ParseOptions(
            delimiter=sep, newlines_in_values=True, ignore_empty_lines=True, invalid_row_handler=keep_short
        )
        seen = 0
        try:
            with open_text() as text:
                if not text.peek(1):
                    return
                for rows in csv.open_csv(text, csv.ReadOptions(use_threads=False, block_size=block), parse, convert):
                    seen += rows.num_rows
                    if seen > done:
                        new = rows.slice(max(0, rows.num_rows - (seen - done)))
                        done = seen
                        yield new
            break
        except pa.ArrowInvalid as error:
            if "straddling" not in str(error):
                raise
            block *= 4
    if short:
        with open_text() as text:
            header = next(lines_of_cells.reader(io.TextIOWrapper(text, "utf-8-sig", newline=""), delimiter=sep))
        place = [header.index(name) if name in header else len(header) for name in names]
        cells = [next(lines_of_cells.reader(io.StringIO(line, newline=""), delimiter=sep)) for line in short]
        columns = [[own[k] if k < len(own) and own[k] else None for own in cells] for k in place]
        yield pa.RecordBatch.from_arrays([pa.array(column, pa.string()) for column in columns], names)


def _typed(cells: DataFrame, schema: StructType) -> DataFrame:
    """Text cells in the types of ``schema``; a bad cell becomes null."""
    typed = [F.trim(F.col(f"`{f.name}`")).try_cast(f.dataType).alias(f.name) for f in schema.fields]
    return cells.select("archive", "member", *typed)


def _text_schema(names: list[str]) -> StructType:
    return StructType([StructField(name, StringType()) for name in ("archive", "member", *names)])


def _keyed(rows: pa.RecordBatch, archive: str, member: str, names: list[str]) -> pa.RecordBatch:
    keys = [pa.array([key] * rows.num_rows, pa.string()) for key in (archive, member)]
    return pa.RecordBatch.from_arrays([*keys, *rows.columns], ["archive", "member", *names])


def member_rows(archives: DataFrame, chosen: DataFrame, schema: StructType, sep: str = ",") -> DataFrame:
    """(archive, member) and the typed columns of ``schema`` of the chosen gzip members.

    Cells are read as :func:`cell_batches` says; a bad one becomes null. Members are spread over
    the cluster while still compressed, so an archive that holds much of the data is decoded by
    many tasks, each in batches; types are given in the JVM.
    """
    names = schema.names

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, name, content in zip(*(batch[c].to_pylist() for c in ("archive", "member", "content"))):
                for rows in cell_batches(lambda: gzip.open(io.BytesIO(content)), names, sep):
                    yield _keyed(rows, path, name, names)

    cells = expand_archives(archives, chosen).repartition("archive", "member").mapInArrow(decode, _text_schema(names))
    return _typed(cells, schema)


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of ``path`` and the path in it; one without a scheme is a local or mounted folder."""
    local = re.sub(r"^file:/+", "/", path)
    return (fs.LocalFileSystem(), local) if local.startswith("/") else fs.FileSystem.from_uri(path)


class ZipMember(InputPartition):
    def __init__(self, archive: str, member: str):
        self.archive, self.member = archive, member


class ZipMemberReader(DataSourceReader):
    """One partition per member that is read; the driver reads the archives' directories only."""

    def __init__(self, options: dict, schema: StructType):
        self.path, self.suffix, self.sep = options["path"], options.get("suffix", ".csv.gz"), options.get("sep", ",")
        self.names = [name for name in schema.names if name not in ("archive", "member")]

    def partitions(self) -> list[ZipMember]:
        system, root = file_system(self.path)
        info = system.get_file_info(root)
        found = [info] if info.is_file else system.get_file_info(fs.FileSelector(root, recursive=True))
        paths = sorted(x.path for x in found if x.is_file and x.path.endswith(".zip"))

        def members(path: str) -> list[str]:
            with system.open_input_file(path) as file, zipfile.ZipFile(file) as archive:
                return [i.filename for i in archive.infolist() if not i.is_dir() and i.filename.endswith(self.suffix)]

        last = {}  # a member that several archives hold is taken from the last of them by path
        with ThreadPoolExecutor(LISTING_THREADS) as pool:
            for path, own in zip(paths, pool.map(members, paths)):
                last.update(dict.fromkeys(own, path))
        return [ZipMember(path, member) for member, path in last.items()]

    def read(self, partition: ZipMember) -> Iterator[pa.RecordBatch]:
        if partition is None:  # no members
            return
        system, _ = file_system(self.path)
        with system.open_input_file(partition.archive) as file, zipfile.ZipFile(file) as archive:
            def open_text():
                packed = archive.open(partition.member)
                return gzip.open(packed) if partition.member.endswith(".gz") else io.BufferedReader(packed)

            for rows in cell_batches(open_text, self.names, self.sep):
                yield _keyed(rows, partition.archive, partition.member, self.names)


class ZipMembers(DataSource):
    """Format ``zip_members``: text cells of delimited members of the zip files below ``path``.

    Options: ``suffix`` of the members that are read (``.csv.gz``), ``sep`` (``,``).
    """

    @classmethod
    def name(cls) -> str:
        return "zip_members"

    def reader(self, schema: StructType) -> DataSourceReader:
        return ZipMemberReader(self.options, schema)


def read_members(spark: SparkSession, path: str, schema: StructType, **options: str) -> DataFrame:
    """(archive, member) and the typed columns of ``schema`` of the members of the zip files below ``path``.

    See :class:`ZipMembers` for ``options`` and :func:`cell_batches` for how cells are read. A member
    that several archives hold is read from the last of them by path. A folder without archives gives no rows.
    """
    spark.dataSource.register(ZipMembers)
    cells = spark.read.format("zip_members").schema(_text_schema(schema.names)).options(**options).load(path)
    return _typed(cells, schema)


def write_archives(archives: DataFrame, path: str) -> None:
    """Write rows (path, content) as files below ``path``, each by the task that holds it."""
    system, root = file_system(path)
    system.create_dir(root)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = file_system(path)
        for batch in batches:
            for name, content in zip(batch["path"].to_pylist(), batch["content"].to_pylist()):
                with system.open_output_stream(f"{root}/{name}") as file:
                    file.write(content)
            yield pa.RecordBatch.from_arrays([batch["path"]], ["path"])

    archives.select("path", "content").mapInArrow(write, "path string").write.format("noop").mode("overwrite").save()
