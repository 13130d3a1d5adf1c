"""Quality classifier: supervised subword embeddings.

A text is the average of the vectors of its words, of the character n-grams of its words and
of its word pairs, each found by hash in one table; a softmax layer gives the classes. Table
and layer are trained together by stochastic gradient descent in numpy, on a bounded sample
of labelled rows. To score, the layer is folded into the table: each feature is one number,
each distinct word of a batch is looked up once, and a text is a weighted sum.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from feedstat.llm.arrays import TASK_BYTES, binary_column, gather, mixed, segment_sums, starts_of, text_batches, window_hashes
from feedstat.session import materialize

#: Labelled rows that the model is fitted on at most: those first in hash order of their ids.
TRAIN_ROWS = 3000
WORDS, GRAMS, PAIRS = 1 << 16, 1 << 17, 1 << 16
GRAM_SIZES = (3, 4)
DIMENSIONS, EPOCHS, RATE = 8, 6, 0.15


def words_of(texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct words (cut at white space), the words of all texts by their number, words per text."""
    ids: dict = defaultdict()
    ids.default_factory = ids.__len__
    flat, counts = [], np.zeros(len(texts), np.int64)
    for k, text in enumerate(texts):
        own = text.split()
        counts[k] = len(own)
        flat.append(np.fromiter(map(ids.__getitem__, own), np.int64, len(own)))
    return list(ids), np.concatenate(flat) if flat else np.zeros(0, np.int64), counts


def subwords(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A 64-bit hash of each word; the n-gram features of all words, joined; where each word's start."""
    framed = [f"<{word}>" for word in words]
    points = np.frombuffer("".join(framed).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    lengths = np.fromiter(map(len, framed), np.int64, len(framed))
    starts = starts_of(lengths)
    place = np.arange(len(points)) - np.repeat(starts[:-1], lengths)
    marks = mixed(points * np.uint64(0x9E3779B97F4A7C15) + place.astype(np.uint64))
    hashes = mixed(np.add.reduceat(marks, starts[:-1])) if len(words) else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(words)), lengths)
    owners, grams = [], []
    for size in GRAM_SIZES:
        found = window_hashes(points, size)
        inside = np.flatnonzero(owner[: len(found)] == owner[size - 1 :][: len(found)]) if len(found) else []
        owners.append(owner[inside])
        grams.append((mixed(found[inside] + np.uint64(size)) % np.uint64(GRAMS)).astype(np.int64))
    owners, grams = np.concatenate(owners), np.concatenate(grams)
    order = np.argsort(owners, kind="stable")
    return hashes, grams[order] + WORDS, starts_of(np.bincount(owners, minlength=len(words)))


def pair_features(hashes: np.ndarray, flat: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The feature of each adjacent pair of words of a text, and pairs per text.

    A word behind itself is one feature, whatever the word.
    """
    inner = np.ones(max(len(flat) - 1, 0), bool)
    ends = np.cumsum(counts)[:-1]
    inner[ends[(ends > 0) & (ends < len(flat))] - 1] = False
    left, right = flat[:-1][inner], flat[1:][inner]
    own = (mixed(hashes[left] * np.uint64(3) + hashes[right]) % np.uint64(PAIRS - 1)).astype(np.int64) + 1
    return np.where(left == right, 0, own) + WORDS + GRAMS, np.maximum(counts - 1, 0)


@dataclass
class Model:
    """What scoring needs: the value of each feature for class 1 against class 0, and the bias."""

    values: np.ndarray
    bias: float

    def scores(self, texts: list[str]) -> np.ndarray:
        words, flat, counts = words_of(texts)
        hashes, grams, starts = subwords(words)
        own = self.values[(hashes % np.uint64(WORDS)).astype(np.int64)] + segment_sums(self.values[grams], np.diff(starts))
        pairs, pair_counts = pair_features(hashes, flat, counts)
        total = segment_sums(own[flat], counts) + segment_sums(self.values[pairs], pair_counts)
        number = segment_sums((1 + np.diff(starts))[flat], counts) + pair_counts
        return 1 / (1 + np.exp(-np.clip(total / np.maximum(number, 1) + self.bias, -30, 30)))


def text_features(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Distinct features of each text and how often each occurs."""
    words, flat, counts = words_of(texts)
    hashes, grams, starts = subwords(words)
    pairs, pair_counts = pair_features(hashes, flat, counts)
    singles = (hashes % np.uint64(WORDS)).astype(np.int64)
    result, at, pair_at = [], starts_of(counts), starts_of(pair_counts)
    for k in range(len(texts)):
        own = flat[at[k] : at[k + 1]]
        parts = [singles[own], gather(grams, starts, own)[0], pairs[pair_at[k] : pair_at[k + 1]]]
        result.append(np.unique(np.concatenate(parts), return_counts=True))
    return result


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], seed: int = 0) -> Model:
    """Stochastic gradient descent over (features, counts, class) rows."""
    own = np.random.default_rng(seed)
    table = own.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (WORDS + GRAMS + PAIRS, DIMENSIONS)).astype(np.float32)
    layer, bias = np.zeros((DIMENSIONS, 2), np.float32), np.zeros(2, np.float32)
    steps, step = EPOCHS * len(rows), 0
    for _ in range(EPOCHS):
        for k in own.permutation(len(rows)):
            features, counts, label = rows[k]
            rate = RATE * (1 - step / steps)
            step += 1
            share = (counts / max(1, counts.sum())).astype(np.float32)
            hidden = share @ table[features] if len(features) else np.zeros(DIMENSIONS, np.float32)
            logits = hidden @ layer + bias
            odds = np.exp(logits - logits.max())
            error = odds / odds.sum()
            error[label] -= 1
            back = layer @ error
            layer -= rate * np.outer(hidden, error)
            bias -= rate * error
            table[features] -= rate * back
    return Model((table @ (layer[:, 1] - layer[:, 0])).astype(np.float64), float(bias[1] - bias[0]))


def fit(docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS) -> Model:
    """A model from at most ``most`` labelled rows.

    ``docs`` has ``doc_id`` and ``text``, ``labels`` has ``doc_id`` and ``label`` (1 or 0; null is
    left out). Features are counted in tasks; the driver gets the sample's features only.
    """
    chosen = labels.where("label IS NOT NULL").orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    chosen = materialize(chosen.select("doc_id", "label"), "train-rows")
    texts = docs.select("doc_id", "text").join(chosen, "doc_id")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in text_batches(batches, "text"):
            found = text_features([text or "" for text in table["text"].to_pylist()])
            sizes = starts_of([len(features) for features, _ in found])
            flat = [np.concatenate([own[k] for own in found]).astype("<i4") for k in (0, 1)]
            yield pa.RecordBatch.from_arrays(
                [table["doc_id"].combine_chunks(), table["label"].combine_chunks().cast(pa.int32()),
                 binary_column(flat[0], sizes), binary_column(flat[1], sizes)],
                ["doc_id", "label", "features", "counts"],
            )

    kind = texts.schema["doc_id"].dataType.simpleString()
    found = texts.select("doc_id", F.col("label").cast("int"), "text").mapInArrow(
        count, f"doc_id {kind}, label int, features binary, counts binary"
    )
    rows = sorted(found.collect(), key=lambda r: (r.doc_id, r.features))
    return train([
        (np.frombuffer(r.features, "<i4"), np.frombuffer(r.counts, "<i4"), r.label) for r in rows
    ])


def score(docs: DataFrame, model, text_col: str = "text", batch_bytes: int = TASK_BYTES) -> DataFrame:
    """``docs`` with ``score``, from 0 to 1; null and empty texts get the model's prior.

    ``model`` has ``scores(texts)`` and a fixed size; it goes to the executors once. Other
    columns pass through, but for one named ``score``; rows are scored one by one.
    """
    docs = docs.drop("score")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in text_batches(batches, text_col, batch_bytes):
            scores = shared.value.scores([text or "" for text in table[text_col].to_pylist()])
            out = table.drop_columns([text_col]).append_column("score", pa.array(scores, pa.float64()))
            yield from out.combine_chunks().to_batches()

    from pyspark.sql.types import DoubleType, StructField, StructType

    kept = [field for field in docs.schema.fields if field.name != text_col]
    return docs.mapInArrow(run, StructType([*kept, StructField("score", DoubleType())]))


def fold(doc_id: Column, folds: int) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def op8_quality(spark, sf_dir: str) -> DataFrame:
    """A quality score for every document, learned from the labels outside the held-out fold."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(fold(F.col("doc_id"), 5) != 0)
    model = fit(docs, labels.select("doc_id", F.col("quality").alias("label")))
    return score(docs, model).select(
        "doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


QUERIES = {"op8_quality": op8_quality}
