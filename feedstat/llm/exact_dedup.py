"""Exact dedup by deterministic block naming, in DataFrame operations only.

Texts are cut into fixed-size blocks. The distinct blocks are sorted and numbered, which
gives each an integer name; then adjacent names are paired and the distinct pairs named in
the same way, until every text has one name. Two texts have the same name of the same level
exactly when they are equal: names are given to contents, never to hashes.

Every text is named. A block is shuffled once, to be sorted among the distinct blocks. A
128-bit key carries its name back to the texts; each key is checked to stand for one block
only, and if one ever stood for two, all blocks would get keys of another seed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from feedstat.session import materialize

BLOCK_CHARS = 4096
SPACES = r"[\x20\x09-\x0D]+"


def normalised(text) -> F.Column:
    """``text`` with each run of white space as one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")


def name_keys(rows: DataFrame, keys: list[str], label: str) -> DataFrame:
    """Replaces ``keys`` by ``name``: the integer that stands for their values, nulls too.

    The distinct keys are dealt out by hash, sorted in each partition and numbered in that order.

    Only distinct keys are sorted, with no sample of them on the driver; a key that fills a third of the rows is one row here.
    The names are written before they are joined: their numbers are then final, their size
    is known, and AQE can split a frequent key of the join.
    """
    distinct = rows.select(*keys).distinct().sortWithinPartitions(*keys)
    named = materialize(
        distinct.withColumn("name", F.monotonically_increasing_id()), f"{label}-names"
    )
    named = named.select(*[F.col(key).alias(f"_{key}") for key in keys], "name")
    same = [F.col(key).eqNullSafe(F.col(f"_{key}")) for key in keys]
    condition = same[0]
    for part in same[1:]:
        condition = condition & part
    return rows.join(named, condition).drop(*keys, *[f"_{key}" for key in keys])


def cut(text: F.Column, block_chars: int) -> F.Column:
    """The blocks of a text in order, one at least."""
    parts = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{block_chars}}}"), F.lit(0))
    return F.when(F.length(text) == 0, F.array(F.lit(""))).otherwise(parts)


def text_blocks(texts: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``row``, ``n``, ``place`` and ``block``: the blocks of each text, ``n`` of them, one at least.

    A text is cut in one pass, and rows of blocks carry their block only: a very long text costs in proportion.
    """
    count = F.greatest(F.lit(1), F.ceil(F.length("text") / F.lit(block_chars)).cast("int"))
    # the count goes along inside the array: as a column of its own it would be taken from the text again, block by block
    sized = F.zip_with(
        cut(F.col("text"), block_chars), F.array_repeat(count, count), lambda block, n: F.struct(n.alias("n"), block.alias("block"))
    )
    return texts.select("row", F.posexplode(sized).alias("place", "own")).select("row", "own.n", "place", "own.block")


def block_key(block: F.Column, seed: int) -> F.Column:
    return F.struct(F.xxhash64(F.lit(seed), block).alias("a"), F.xxhash64(block, F.lit(seed)).alias("b"))


def block_names(texts: DataFrame, seed: int, block_chars: int = BLOCK_CHARS) -> DataFrame | None:
    """``a``, ``b`` and ``name`` of each distinct block of ``text``; None if a key stands for two blocks."""
    distinct = text_blocks(texts, block_chars).select(block_key(F.col("block"), seed).alias("key"), "block").distinct()
    names = materialize(
        distinct.sortWithinPartitions("block").select("key.a", "key.b", F.monotonically_increasing_id().alias("name")),
        "block-names",
    )
    clash = names.groupBy("a", "b").agg(F.count("*").alias("n")).where("n > 1")
    return None if clash.head(1) else names


def name_texts(texts: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``row``, ``level`` and ``name`` of each row of ``texts`` (``row``, ``text``), with its other columns.

    A text of n blocks gets a name of level ceil(log2(n)). The number of levels is the only
    value the driver reads. Rows are numbered where they are written, so ``row`` may be computed.
    """
    seed = 0
    while (names := block_names(texts, seed, block_chars)) is None:
        seed += 1
    keys = F.transform(cut(F.col("text"), block_chars), lambda block: block_key(block, seed))
    keyed = materialize(texts.withColumn("keys", keys).drop("text"), "keyed-texts")
    parts = keyed.select("row", F.size("keys").alias("n"), F.posexplode("keys").alias("place", "key"))
    parts = parts.select("row", "n", "place", "key.a", "key.b").join(names, ["a", "b"]).select("row", "n", "place", "name")
    parts = materialize(parts, "block-parts")
    longest = parts.agg(F.max("n")).first()[0] or 1
    finished = [parts.where("n = 1").select("row", F.lit(0).alias("level"), "name")]
    level = 0
    while longest > 1:
        level += 1
        pairs = (
            parts.where("n > 1")
            .groupBy("row", "n", F.expr("place div 2").cast("int").alias("place"))
            .agg(
                F.max(F.when(F.col("place") % 2 == 0, F.col("name"))).alias("left"),
                F.max(F.when(F.col("place") % 2 == 1, F.col("name"))).alias("right"),
            )
            .withColumn("n", F.expr("(n + 1) div 2").cast("int"))
        )
        parts = materialize(name_keys(pairs, ["left", "right"], "pair"), "pair-parts")
        finished.append(parts.where("n = 1").select("row", F.lit(level).alias("level"), "name"))
        longest = (longest + 1) // 2
    result = finished[0]
    for more in finished[1:]:
        result = result.unionByName(more)
    return keyed.drop("keys").join(result, "row")


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_chars: int = BLOCK_CHARS
) -> DataFrame:
    """One row per row of ``docs``: its id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are compared after ``normalised``; null and empty texts are equal. The row with the
    smallest id stays (null ids come last; of rows with the same id and text one stays, the
    others count as dropped). Other columns of ``docs`` are not read, whatever their names.
    An empty table gives an empty result.
    """
    clean = docs.select(F.col(id_col).alias("doc_id"), normalised(F.col(text_col)).alias("text"))
    texts = clean.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "text", F.sha2("text", 256).alias("text_sha256")
    )
    named = materialize(name_texts(texts, block_chars), "exact-named")
    groups = named.groupBy("level", "name").agg(
        F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"),
    )
    groups = materialize(groups, "exact-groups")
    joined = named.join(groups, ["level", "name"])
    first = materialize(
        joined.where(F.col("doc_id").eqNullSafe(F.col("keep_id")))
        .groupBy("level", "name").agg(F.min("row").alias("first")),
        "exact-first",
    )
    result = joined.join(first, ["level", "name"]).select(
        "doc_id", "keep_id", "group_size", (F.col("row") == F.col("first")).alias("kept"), "text_sha256"
    )
    return result.withColumnRenamed("doc_id", id_col) if id_col != "doc_id" else result


def op4_exact_dedup(spark, sf_dir: str) -> DataFrame:
    """Every row of ``documents`` with the row that stays for its text."""
    return exact_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op4_exact_dedup": op4_exact_dedup}

ORACLES = {
    "op4_exact_dedup": r"""
        WITH clean AS (
            SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents
        )
        SELECT doc_id, min(doc_id) OVER (PARTITION BY body) AS keep_id,
               count(*) OVER (PARTITION BY body) AS group_size,
               row_number() OVER (PARTITION BY body ORDER BY doc_id) = 1 AS kept,
               sha256(body) AS text_sha256
        FROM clean""",
}
