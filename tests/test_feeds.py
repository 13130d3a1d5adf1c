import csv
import gzip
import io
import os
import random
import time
import zipfile

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import Window
from pyspark.sql import functions as F

from feedstat.functions.casting import rename_columns
from feedstat.operators import bars, quality
from feedstat.plans import jobs
from feedstat.sinks import files, tables, zones
from feedstat.sources import archives, delimited, listing, sidecars
from feedstat.streaming.incremental import expand_arrivals

HEADER = "Script name,Date,Open,High,Low,Close,Adj Close,Volume"
FOLDER = jobs.FOLDER


def member(ticker, day, close="10.5", header=HEADER):
    if header == HEADER:
        line = f'"{ticker}",{day},10.0,11.0,9.5,{close},10.4,1000'
    else:
        line = f"{close},{day},{ticker},10.0"
    return gzip.compress(f"{header}\n{line}\n".encode())


def make_zip(path, members):
    with zipfile.ZipFile(path, "w") as archive:
        for name, content in members.items():
            archive.writestr(name, content)


@pytest.fixture
def inbound(tmp_path):
    folder = tmp_path / "inbound"
    folder.mkdir()
    make_zip(folder / "one.zip", {
        "AAA_202001.csv.gz": member("AAA", "2020-01-05"),
        "AAA_202002.csv.gz": member("AAA", "2020-02-05", "abc"),
        "BBB_202001.csv.gz": member("BBB", "2020-01-06"),
        "notes.txt": b"not a feed",
    })
    make_zip(folder / "two.zip", {
        "BBB_202002.csv.gz": member("BBB", "2020-02-06", "20.5", "Close,Date,Script name,Open"),
        "AAA_202001.csv.gz": member("AAA", "2020-01-05", "99.0"),
    })
    (folder / "ignored.csv").write_text("x\n1\n")
    return folder


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


PIPE = """Script name|Date|Open|High|Low|Close|Adj Close|Volume
AAA|2019-12-30|10.0|11.0|9.5|10.5|10.4|1000
AAA|2019-01-01|12.0|12.5|11.0|abc|11.9|500
AAA|2019-01-02|13.0|13.5|12.0|13.1|12.9|700
BBB|2019-01-02|1.0|1.5|0.5|1.2|1.1|10
BBB|2019-01-02|2.0|2.5|1.5|2.2|2.1|20
"""


def test_fixed_scan_nulls_bad_cells_and_keeps_the_line(spark, tmp_path):
    write(tmp_path / "f.csv", PIPE)
    rows = delimited.read_fixed(spark, str(tmp_path), corrupt_column="_bad").cache()
    bad = rows.where(F.col("_bad").isNotNull()).collect()
    assert [(r.Date, r.Close, r.Open) for r in bad] == [("2019-01-01", None, 12.0)]
    assert rename_columns(rows).columns[0] == "Script_name"


def test_inferred_scan_keeps_a_column_with_bad_text_as_text(spark, tmp_path):
    write(tmp_path / "f.csv", "Scrip name,Date,Open,Adj Close\nA,1/5/2020,1.5,2.5\nA,1/6/2020,2.5,null\n")
    types = dict(delimited.read_inferred(spark, str(tmp_path)).dtypes)
    assert types == {"Scrip name": "string", "Date": "string", "Open": "double", "Adj Close": "string"}


def test_archives_list_every_member(spark, inbound):
    members = archives.list_members(archives.read_archives(spark, str(inbound))).collect()
    assert sorted(r.member for r in members) == [
        "AAA_202001.csv.gz", "AAA_202001.csv.gz", "AAA_202002.csv.gz",
        "BBB_202001.csv.gz", "BBB_202002.csv.gz", "notes.txt",
    ]
    whole = archives.expand_archives(archives.read_archives(spark, str(inbound))).collect()
    assert {bytes(r.content) for r in whole if r.member == "notes.txt"} == {b"not a feed"}


def test_member_rows_follow_their_own_header_and_the_last_archive(spark, inbound):
    zipped = archives.read_archives(spark, str(inbound))
    found = archives.member_rows(zipped, archives.choose_members(zipped), delimited.PRICE_FEED)
    rows = {r.member: r for r in found.collect()}
    assert len(rows) == 4
    assert rows["AAA_202001.csv.gz"].Close == 99.0 and rows["AAA_202001.csv.gz"]["Script name"] == "AAA"
    assert rows["AAA_202002.csv.gz"].Close is None
    assert rows["BBB_202002.csv.gz"].Close == 20.5 and rows["BBB_202002.csv.gz"].Volume is None


def test_long_members_are_read_in_batches(spark, tmp_path, monkeypatch):
    lines = "\n".join([HEADER, *[f"AAA,2020-01-05,{i},1,1,1,1,1" for i in range(50_000)]]) + "\n"
    make_zip(tmp_path / "big.zip", {"AAA_202001.csv.gz": gzip.compress(lines.encode())})
    zipped = archives.read_archives(spark, str(tmp_path))
    rows = archives.member_rows(zipped, archives.choose_members(zipped), delimited.PRICE_FEED)
    assert rows.agg(F.count("Open"), F.sum("Open")).first() == (50_000, 50_000 * 49_999 / 2)


def test_members_with_quoted_breaks_blank_lines_and_many_columns(spark, tmp_path):
    names = ["Script name", "Close", *[f"extra{i}" for i in range(70)]]
    lines = ",".join(names) + '\n"A\nB",1.5' + ",x" * 70 + "\n\nC,bad" + "," * 70 + "\n"
    make_zip(tmp_path / "wide.zip", {"AAA_202001.csv.gz": gzip.compress(lines.encode()), "BBB_202001.csv.gz": gzip.compress(b"")})
    zipped = archives.read_archives(spark, str(tmp_path))
    rows = archives.member_rows(zipped, archives.choose_members(zipped), delimited.PRICE_FEED)
    assert sorted((r["Script name"], r.Close, r.Open) for r in rows.collect()) == [("A\nB", 1.5, None), ("C", None, None)]


def test_short_lines_are_filled_and_long_ones_fail(spark, tmp_path):
    text = HEADER + '\nA,2020-01-05,1,2\n"B\n""b""",2020-01-06\nC,2020-01-07,1,2,3,4,5,6\n\nD\n'
    make_zip(tmp_path / "one.zip", {"AAA_202001.csv.gz": gzip.compress(text.encode())})
    zipped = archives.read_archives(spark, str(tmp_path))
    expected = [("A", "2020-01-05", 2.0, None), ('B\n"b"', "2020-01-06", None, None), ("C", "2020-01-07", 2.0, 6.0), ("D", None, None, None)]
    for rows in (archives.member_rows(zipped, archives.choose_members(zipped), delimited.PRICE_FEED),
                 archives.read_members(spark, str(tmp_path), delimited.PRICE_FEED)):
        assert sorted((r["Script name"], r.Date, r.High, r.Volume) for r in rows.collect()) == expected
    make_zip(tmp_path / "two.zip", {"BBB_202001.csv.gz": gzip.compress((HEADER + "\n" + "1," * 9 + "\n").encode())})
    with pytest.raises(Exception, match="Expected 8 columns, got 10"):
        archives.read_members(spark, str(tmp_path), delimited.PRICE_FEED).collect()


def test_lines_longer_than_a_block(tmp_path):
    lines = [f"{k},{'x' * (300_000 if k in (3, 90) else 5)}" for k in range(100)] + ["100"]
    own = archives.BLOCK_BYTES
    archives.BLOCK_BYTES = 1 << 10
    try:
        text = ("a,b\n" + "\n".join(lines) + "\n").encode()
        rows = [row for batch in archives.cell_batches(lambda: io.BufferedReader(io.BytesIO(text)), ["a", "b"]) for row in batch.to_pylist()]
    finally:
        archives.BLOCK_BYTES = own
    assert [(r["a"], r["b"]) for r in rows] == [tuple(line.split(",")) for line in lines[:-1]] + [("100", None)]


def test_zip_source_has_a_partition_per_member(spark, inbound):
    rows = archives.read_members(spark, str(inbound), delimited.PRICE_FEED)
    assert rows.rdd.getNumPartitions() == 4
    got = {r.member: r for r in rows.collect()}
    assert got["AAA_202001.csv.gz"].Close == 99.0 and got["AAA_202001.csv.gz"].archive.endswith("two.zip")
    assert got["AAA_202002.csv.gz"].Close is None and got["BBB_202002.csv.gz"].Close == 20.5
    plain = inbound / "more" / "plain.zip"
    plain.parent.mkdir()
    make_zip(plain, {"folder/CCC.csv": f"{HEADER}\nC,2020-01-05,1,2,3,4,5,6\n".encode(), "empty.csv": b""})
    assert archives.read_members(spark, f"file:{inbound}", delimited.PRICE_FEED, suffix=".csv").collect()[0].Volume == 6.0
    (inbound / "none").mkdir()
    assert archives.read_members(spark, str(inbound / "none"), delimited.PRICE_FEED).count() == 0


def test_archive_job_adds_no_rows_the_second_time(spark, inbound, tmp_path):
    landing, ledger = str(tmp_path / "landing"), str(tmp_path / "ledger")
    current = jobs.archive_job(spark, str(inbound), landing, ledger, "feed_rows")
    assert sorted((r.ticker, r.period) for r in current.collect()) == [("AAA", "202002"), ("BBB", "202002")]
    assert spark.table("feed_rows").count() == 4
    jobs.archive_job(spark, str(inbound), landing, ledger, "feed_rows")
    assert spark.table("feed_rows").count() == 4
    make_zip(inbound / "three.zip", {"BBB_202003.csv.gz": member("BBB", "2020-03-06")})
    current = jobs.archive_job(spark, str(inbound), landing, ledger, "feed_rows")
    assert sorted((r.ticker, r.period) for r in current.collect()) == [("AAA", "202002"), ("BBB", "202003")]
    assert spark.table("feed_rows").count() == 5


def test_a_run_lost_before_its_ledger_is_repeated_cleanly(spark, inbound, tmp_path):
    landing, ledger = str(tmp_path / "landing"), str(tmp_path / "ledger")
    zipped = archives.read_archives(spark, str(inbound))
    jobs.ingest_archives(spark, zipped, landing, str(tmp_path / "lost-ledger"))
    jobs.ingest_archives(spark, zipped, landing, ledger)
    assert spark.read.schema(jobs.LANDED).parquet(landing).count() == 4


def test_arriving_archives_are_expanded_once(spark, inbound, tmp_path):
    paths = [str(tmp_path / name) for name in ("landing", "ledger", "checkpoint")]
    for expected in (4, 4, 5):
        if expected == 5:
            make_zip(inbound / "three.zip", {"BBB_202003.csv.gz": member("BBB", "2020-03-06")})
        query = expand_arrivals(spark, str(inbound), *paths)
        assert query.awaitTermination(120)
        assert query.exception() is None
        assert spark.read.schema(jobs.LANDED).parquet(paths[0]).count() == expected


def test_listing_newest_and_older_files(spark, tmp_path):
    now = time.time()
    for i, name in enumerate(["AAA_202001.csv", "AAA_202003.csv", "AAA_202002.csv", "BBB_202001.csv", "x.xls"]):
        write(tmp_path / name, "x\n")
        os.utime(tmp_path / name, (now + i, now + i))
    found = listing.list_files(spark, str(tmp_path))
    assert found.count() == 5
    names = listing.add_ticker_period(listing.with_suffix(found, ".csv"))
    assert {r.file_name for r in listing.newest_files(names).collect()} == {"AAA_202002.csv", "BBB_202001.csv"}
    assert {r.period for r in listing.older_files(names).collect()} == {"202001", "202003"}
    stems = names.select(listing.dataset_name(F.col("path")).alias("d"))
    assert {r.d for r in stems.collect()} == {"AAA_202001", "AAA_202002", "AAA_202003", "BBB_202001"}


def test_gates(spark, tmp_path):
    good = "a|b\n1|2\n3|4\n"
    for name in ("equal", "missing", "wrong", "text"):
        write(tmp_path / "feed" / name / "part1.csv", good)
    write(tmp_path / "feed" / "equal" / "part2.csv", "a|b\n5|6\n")
    for name, header, counter in (
        ("equal", "b,a", "Count:3"), ("missing", "a,b,c", "Count:2"), ("wrong", "a", "Count:7"), ("text", "a,b", "Count:x"),
    ):
        write(tmp_path / "headers" / name / "Header.csv", header + "\n")
        write(tmp_path / "counters" / name / "Counter.txt", counter + "\n")
    facts = quality.feed_facts(spark, str(tmp_path / "feed"), FOLDER)
    names = quality.check_headers(
        quality.feed_columns(facts), sidecars.read_headers(spark, str(tmp_path / "headers"), FOLDER)
    )
    assert {r.dataset: (r.passed, r.missing, r.extra) for r in names.collect()} == {
        "equal": (True, [], []), "missing": (False, ["c"], []), "wrong": (False, [], ["b"]), "text": (True, [], []),
    }
    counters = sidecars.read_counters(spark, str(tmp_path / "counters"), FOLDER)
    counts = quality.check_counts(facts, counters)
    assert {r.dataset: (r.expected, r.actual, r.passed) for r in counts.collect()} == {
        "equal": (3, 3, True), "missing": (2, 2, True), "wrong": (7, 2, False), "text": (None, 2, False),
    }
    with pytest.raises(Exception, match="row count check failed for"):
        quality.check_counts(facts, counters, fail=True).collect()
    assert sidecars.read_header_names(spark, str(tmp_path / "headers" / "equal")) == ["b", "a"]


@pytest.mark.parametrize("split", [7, 40, 333, 100_000])
def test_records_with_breaks_that_cross_splits(spark, tmp_path, split):
    """Against the csv module, whatever the splits: quotes, doubled ones, stray ones, blank lines inside and outside."""
    rng = random.Random(split)
    cells = ["", "x", "5\" pipe", "\n", "\n\n", 'a"b\n"', '"', '""\n', "|", "a|b\n\nc", "x\n   \ny", '\n"|"\n']
    expected = {}
    for name in ("one", "two"):
        text = "a|b|c\n"
        for _ in range(60):
            row = [rng.choice(cells) for _ in range(3)]
            quoted = ['"' + c.replace('"', '""') + '"' if "\n" in c or "|" in c or c.startswith('"') or rng.random() < 0.3 else c for c in row]
            text += "|".join(quoted) + "\n" + ("\n" if rng.random() < 0.1 else "")
        write(tmp_path / "feed" / name / "f.csv", text)
        expected[name] = sum(1 for row in csv.reader(io.StringIO(text, newline=""), delimiter="|") if row) - 1
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    try:
        facts = quality.feed_facts(spark, str(tmp_path / "feed"), FOLDER).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert {r.dataset: r.n_rows for r in facts} == expected


def test_header_of_a_file_with_many_splits(spark, tmp_path):
    write(tmp_path / "feed" / "d" / "f.csv", "a|b\n" + "".join(f"{i}|x\n" for i in range(20_000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        facts = quality.feed_facts(spark, str(tmp_path / "feed"), FOLDER).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [(r.dataset, r.headers, r.n_rows) for r in facts] == [("d", ["a|b"], 20_000)]


def test_weekly_bars_keep_tickers_apart_and_follow_the_tie_key(spark):
    rows = spark.createDataFrame(
        [("A", "2020-01-06", 1.0, 1), ("A", "2020-01-06", 2.0, 0), ("A", "2020-01-07", 3.0, 2), ("B", "2020-01-06", 9.0, 3)],
        "Script_name string, d string, v double, seq int",
    ).select("Script_name", F.to_date("d").alias("Date"), *[F.col("v").alias(c) for c in ("Open", "High", "Low", "Close", "Adj_Close", "Volume")], "seq")
    got = {r.Script_Name: r for r in bars.weekly_bars(rows, tie="seq").collect()}
    assert (got["A"].Open, got["A"].Close, got["A"].Low, got["A"].High, got["A"].Volume) == (2.0, 3.0, 1.0, 3.0, 6.0)
    assert got["B"].Open == 9.0 and got["A"].Week_No == "Week-2_2020"
    shuffled = {r.Script_Name: r for r in bars.weekly_bars(rows.repartition(7), tie="seq").collect()}
    assert shuffled == got


def test_rows_with_bad_dates_stay_and_pieces_number_like_one_window(spark):
    rows = spark.createDataFrame(
        [(None if i % 7 == 0 else "AB"[i % 3 == 0], None if i % 11 == 0 else f"2020-01-{6 + i % 3:02d}", float(i), i) for i in range(500)],
        "Script_name string, d string, v double, seq int",
    ).select("Script_name", F.to_date("d").alias("Date"), *[F.col("v").alias(c) for c in ("Open", "High", "Low", "Close", "Adj_Close", "Volume")], "seq")
    weeks = bars.label_weeks(rows)
    got = bars.add_week_columns(weeks, tie="seq", rows_per_bucket=40)
    assert got.count() == 500
    keys = Window.partitionBy("Script_name", "Week_No").orderBy("Date", "seq")
    expected = {r.seq: r.n for r in weeks.select("seq", F.row_number().over(keys).alias("n")).collect()}
    assert {r.seq: r["row"] for r in got.collect()} == expected


def test_delimited_write_refuses_an_existing_path(spark, tmp_path):
    rows = spark.range(3)
    path = str(tmp_path / "out")
    assert files.write_delimited(rows, path, ";") == path
    with pytest.raises(AnalysisException):
        files.write_delimited(rows, path, ";")


def test_register_table_moves_with_new_data(spark, tmp_path):
    for name, n in (("one", 2), ("two", 5)):
        rows = spark.range(n)
        path = files.write_flat(rows, str(tmp_path / name))
        assert tables.register_table(spark, "moving", path, schema=rows.schema).count() == n


def test_ticker_tables_point_at_the_newest_period(spark, tmp_path):
    rows = spark.createDataFrame(
        [("AAA", "202001", 1), ("AAA", "202002", 2), ("BBB", "202001", 3)], "ticker string, period string, v int"
    )
    root = files.write_by_period(rows, str(tmp_path / "landing"))
    newest = rows.groupBy("ticker").agg(F.max("period").alias("period"))
    names = tables.register_ticker_tables(spark, newest, "px", root, header="true")
    assert sorted(names) == ["px_aaa", "px_bbb"]
    assert [r.v for r in spark.table("px_aaa").collect()] == ["2"]


def test_promote_names_datasets_by_file(spark, tmp_path):
    for name in ("alpha", "beta"):
        write(tmp_path / "in" / f"{name}.2020.csv", f"a,b\n{name},1\n{name},2\n")
    done = zones.promote(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert {(r.dataset, r.n_rows) for r in done.collect()} == {("alpha", 2), ("beta", 2)}


def test_rotation_keeps_newest_and_adds_to_archive(spark, tmp_path):
    rows = spark.createDataFrame([("A", "1", 1), ("A", "2", 2), ("B", "1", 3)], "ticker string, period string, v int")
    one = files.write_partitioned(rows, str(tmp_path / "rows"), ["ticker", "period"])
    stored = spark.read.schema(rows.schema).parquet(one)
    archive = str(tmp_path / "archive")
    current = zones.rotate(spark, "rotating", stored, str(tmp_path / "current1"), archive)
    assert sorted(r.v for r in current.collect()) == [2, 3]
    more = current.unionByName(spark.createDataFrame([("B", "2", 4)], rows.schema))
    current = zones.rotate(spark, "rotating", more, str(tmp_path / "current2"), archive)
    assert sorted(r.v for r in current.collect()) == [2, 4]
    assert sorted(r.v for r in spark.read.schema(rows.schema).parquet(archive).collect()) == [1, 3]


def test_a_period_delivered_again_becomes_current(spark, tmp_path):
    rows = spark.createDataFrame(
        [("A", "1", 1), ("A", "2", 2), ("A", "3", 3), ("B b", "1", 4), ("B b", "2", 5)], "ticker string, period string, v int"
    )
    path = files.write_partitioned(rows, str(tmp_path / "rows"), ["ticker", "period"])
    later = time.time() + 100
    for file in (tmp_path / "rows").glob("ticker=A/period=2/*.parquet"):
        os.utime(file, (later, later))
    for file in (tmp_path / "rows").glob("ticker=B*/*/*.parquet"):
        os.utime(file, (later, later))  # of the same time the later period counts
    manifest = tables.file_manifest(spark, path)
    stored = spark.read.schema(rows.schema).parquet(path)
    current = zones.rotate(spark, "again", stored, str(tmp_path / "now"), str(tmp_path / "old"), manifest=manifest)
    assert sorted(r.v for r in current.collect()) == [2, 5]
    assert sorted(r.v for r in spark.read.schema(rows.schema).parquet(str(tmp_path / "old")).collect()) == [1, 3, 4]
    tables.register_table(spark, "all_periods", path, schema=rows.schema, partitioned_by=["ticker", "period"])
    assert sorted(r.v for r in tables.register_current(spark, "last_periods", "all_periods", manifest=manifest).collect()) == [2, 5]
    assert sorted(r.v for r in tables.register_current(spark, "last_periods", "all_periods").collect()) == [3, 5]


def test_weekly_job(spark, tmp_path):
    write(tmp_path / "feed" / "prices" / "f.csv", PIPE)
    write(tmp_path / "headers" / "prices" / "h.csv", HEADER + "\n")
    write(tmp_path / "counters" / "prices" / "c.txt", "Count:5\n")
    checks = jobs.weekly_job(
        spark, *[str(tmp_path / n) for n in ("feed", "headers", "counters", "standardized", "outbound")]
    ).first()
    assert checks.dataset == "prices" and checks.header_passed and checks.count_passed
    weeks = spark.read.options(header=True).csv(str(tmp_path / "outbound")).collect()
    got = {(r.Script_Name, r.Week_No): r for r in weeks}
    assert set(got) == {("AAA", "Week-1_2019"), ("BBB", "Week-1_2019")}
    assert got[("AAA", "Week-1_2019")].Volume == "2200.0" and got[("AAA", "Week-1_2019")].Open == "12.0"


def test_dated_job(spark, tmp_path):
    write(tmp_path / "feed" / "dated" / "f.csv", "Scrip name,Date,Open,Adj Close\nA,2/29/2020,1,2\nA,13/45/2020,1,3\nA,,1,4\n")
    write(tmp_path / "headers" / "dated" / "h.csv", "Scrip name,Date,Open,Adj Close\n")
    write(tmp_path / "counters" / "dated" / "c.txt", "Count:3\n")
    checks = jobs.dated_job(
        spark, *[str(tmp_path / n) for n in ("feed", "headers", "counters", "standardized", "outbound")], "dated_rows"
    ).first()
    assert checks.header_passed and checks.count_passed
    rows = {str(r.Date): (r.Script_name, r.Day, r.Year, r.Month, r.Quarter) for r in spark.table("dated_rows").collect()}
    assert rows == {"2020-02-29": ("A", 29, 2020, 2, 1), "None": ("A", None, None, None, None)}
    assert spark.read.options(header=True).csv(str(tmp_path / "outbound")).count() == 3
    paths = [str(tmp_path / n) for n in ("feed", "headers", "counters", "standardized", "outbound2")]
    assert jobs.dated_job(spark, *paths, "dated_rows", drop_gaps=True).first().count_passed
    assert spark.table("dated_rows").count() == 2


def test_study_runs_every_part(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").withColumn("id", F.monotonically_increasing_id())
    results = jobs.study(rows, ["l_quantity", "l_tax"], ["l_returnflag", "l_linestatus"], "l_quantity", ["id"])
    assert len(results) == 21 and all(r.count() > 0 for r in results.values())


def test_promote_keeps_each_header_and_other_datasets(spark, tmp_path):
    write(tmp_path / "one" / "A.csv", "x,y\n1,2\n3,4\n")
    write(tmp_path / "one" / "B.csv", 'y,x\n5,"6\n6"\n\n7,8\n')
    write(tmp_path / "two" / "C.csv", "z\n9\n")
    write(tmp_path / "two" / "A.csv", "x,y\n0,0\n")
    out = str(tmp_path / "out")
    done = zones.promote(spark, str(tmp_path / "one"), out)
    assert {(r.dataset, r.n_rows) for r in done.collect()} == {("A", 2), ("B", 2)}
    done = zones.promote(spark, str(tmp_path / "two"), out)
    assert {(r.dataset, r.n_rows) for r in done.collect()} == {("A", 1), ("C", 1)}
    read = lambda name: spark.read.options(header=True, multiLine=True).csv(f"{out}/dataset={name}/source_file={name}.csv")
    assert [r.asDict() for r in read("B").collect()] == [{"y": "5", "x": "6\n6"}, {"y": "7", "x": "8"}]
    assert [r.asDict() for r in read("A").collect()] == [{"x": "0", "y": "0"}]
    assert [r.asDict() for r in read("C").collect()] == [{"z": "9"}]


@pytest.mark.parametrize("split", [40, 97, 1000])
def test_promote_cuts_files_between_records(spark, tmp_path, split):
    """Against the csv module: parts by block, each with the header, hold the records of the file in order and whole."""
    rng = random.Random(split)
    cells = ["", "x", "\n", "\n\n\n", 'a"b\n"', "a,b\n\nc", "long " * 30, "y\n" * 40]
    texts = {}
    for name, header in (("one", "a,b,c\r\n"), ("two", '"a\n1",b,c\n'), ("three", "a,b,c\n")):
        text = header
        for _ in range(0 if name == "three" else 80):
            row = [rng.choice(cells) for _ in range(3)]
            text += ",".join('"' + c.replace('"', '""') + '"' for c in row) + ("\r\n" if rng.random() < 0.2 else "\n")
            text += "\n" if rng.random() < 0.1 else ""
        texts[name] = text
        write(tmp_path / "in" / f"{name}.csv", text)
    records = {name: [row for row in csv.reader(io.StringIO(text, newline="")) if row] for name, text in texts.items()}
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    try:
        done = {r.dataset: r.n_rows for r in zones.promote(spark, str(tmp_path / "in"), str(tmp_path / "out")).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert done == {name: len(rows) - 1 for name, rows in records.items()}
    for name, rows in records.items():
        parts = list((tmp_path / "out" / f"dataset={name}").glob("source_file=*/part-*"))
        assert name == "three" or len(parts) > 3
        found = []
        for part in parts:
            own = [row for row in csv.reader(io.StringIO(part.read_bytes().decode(), newline="")) if row]
            assert own[0] == rows[0]
            found.append(own[1:])
        wanted = [str(row) for row in rows[1:]]
        assert sorted(str(row) for own in found for row in own) == sorted(wanted)
        # each part is a stretch of the file
        assert all(str([str(r) for r in own])[1:-1] in str(wanted) for own in found)


def test_control_files_are_their_first_lines_and_headers_are_unquoted(spark, tmp_path):
    write(tmp_path / "headers" / "px" / "h.csv", '"Script name", "a,b",Date\nAAA,1,2020\n')
    write(tmp_path / "counters" / "px" / "c.txt", "Rows:3\nRows:9\n")
    write(tmp_path / "feed" / "px" / "f.csv", 'Script name|"a,b"|"Date"\nAAA|1|2\n\nAAA|1|2\n  \nBBB|1|2\n')
    headers = sidecars.read_headers(spark, str(tmp_path / "headers"), FOLDER)
    assert sorted(r.column_name for r in headers.collect()) == ["Date", "Script name", "a,b"]
    counters = sidecars.read_counters(spark, str(tmp_path / "counters"), FOLDER)
    assert [tuple(r) for r in counters.collect()] == [("px", 3)]
    facts = quality.feed_facts(spark, str(tmp_path / "feed"), FOLDER)
    assert "SortAggregate" not in facts._jdf.queryExecution().toString()
    assert quality.check_headers(quality.feed_columns(facts), headers).first().passed
    assert quality.check_counts(facts.select("dataset", "n_rows"), counters).first().passed


def test_rotation_can_be_repeated(spark, tmp_path):
    rows = spark.createDataFrame([("A", "1", 1), ("A", "2", 2)], "ticker string, period string, v int")
    stored = spark.read.schema(rows.schema).parquet(files.write_partitioned(rows, str(tmp_path / "rows"), ["ticker", "period"]))
    for k in (1, 2):
        zones.rotate(spark, "rotating_again", stored, str(tmp_path / f"current{k}"), str(tmp_path / "archive"))
    assert [r.v for r in spark.read.parquet(str(tmp_path / "archive")).collect()] == [1]
