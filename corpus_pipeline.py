"""The corpus pipeline: quality rules, line dedup, near duplicates, repeated passages, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from feedstat.llm import line_dedup, ngram_join, packing, quality_rules, substring_dedup
from feedstat.session import materialize


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the learned decision list keep."""
    return quality_rules.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def apart(docs: DataFrame, *names: str) -> DataFrame:
    """The columns ``names``, and all but the text in one, ``row``, so that no name meets those of an operator."""
    return docs.select(*names, F.struct(*[name for name in docs.columns if name not in ("text", "n_chars")]).alias("row"))


def with_text(rows: DataFrame, docs: DataFrame, text: str) -> DataFrame:
    """The columns of ``docs`` out of ``row``, with the column ``text`` as their text."""
    new = {"text": F.col(text), "n_chars": F.length(text).cast("long")}
    return rows.select(*[(new[name] if name in new else F.col("row").getField(name)).alias(name) for name in docs.columns])


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the boilerplate lines of their source."""
    return with_text(line_dedup.drop_boilerplate(apart(docs, "source", "text")), docs, "kept_text")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return ngram_join.one_of_each(docs)


def drop_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the 13-word passages of documents with smaller ids; words are joined by one space."""
    return with_text(substring_dedup.drop_passages(apart(docs, "doc_id", "text"), carry=["row"]), docs, "kept")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sequence and offset of every piece of what is left."""
    import public_tokenizers

    return packing.pack_documents(
        docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN
    ).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("quality rules", keep_good),
    ("line dedup", drop_boilerplate),
    ("near duplicates", drop_near_duplicates),
    ("substring dedup", drop_passages),
    ("packing", pack),
]

#: The learned rules and the tokenizer can't be written in SQL; tests compare each stage with brute force on what it gets.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, each written and read again for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
