"""Substring dedup by words: an FM-index per shard, searched backwards by streamed passages.

Every window of 13 words that stands in two documents holds an anchor in both (see
``passages``), so passages are dealt to shards by their anchors. A shard indexes the distinct
passages it got: suffixes sorted, their Burrows-Wheeler transform in a wavelet matrix. The
passages of all blocks then stream through it. Backward search gives, for each window, how
many of its words match elsewhere (its matching statistics) and where; a window whose match
is complete and lies in a document with a smaller id is reported.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from feedstat.llm import passages
from feedstat.llm.arrays import segment_sums, starts_of
from feedstat.llm.fm_index import FMIndex
from feedstat.llm.ngram_join import word_hashes

LENGTH = 13
GRAM = 5
BEFORE = LENGTH - GRAM
#: Windows in a class of those around a hot anchor.
STEP = 1
WIDTH = BEFORE + LENGTH
#: Bits of a word's hash that are sent.
WORD_BITS = 40


def anchors_of(block: passages.Block) -> passages.Anchors:
    """The anchors of a block's words, as hashes."""
    return passages.Anchors(*word_hashes(block.texts), GRAM, LENGTH, STEP)


def same_rows(rows: np.ndarray) -> np.ndarray:
    """A number for each row, equal for equal rows."""
    keys = np.ascontiguousarray(rows).view(np.dtype((np.void, rows.shape[1] * rows.dtype.itemsize))).ravel()
    return np.unique(keys, return_inverse=True)[1].ravel()


def surroundings(block: passages.Block, words: np.ndarray, starts: np.ndarray, sent: tuple[np.ndarray, ...], shards: int):
    """The passages to send, and the spans of what smaller ids in the block hold too."""
    places, doc, before, behind, hashes = sent
    steps = np.arange(-BEFORE, LENGTH)
    at = places[:, None] + steps[None, :]
    inside = (steps[None, :] >= -before[:, None]) & (steps[None, :] < behind[:, None])
    around = np.where(inside, (words >> np.uint64(64 - WORD_BITS))[np.clip(at, 0, max(len(words) - 1, 0))] + np.uint64(1), 0)
    order, local = block.order[doc], places - starts[doc]
    spans = np.zeros((0, 3), np.int64)
    if len(places):
        same = same_rows(around)
        least = np.full(same.max() + 1, np.iinfo(np.int64).max)
        np.minimum.at(least, same, order)
        later = order > least[same]
        full = later & (before + behind >= LENGTH)
        spans = passages.merged(np.stack((doc, local - before, local + behind), axis=1)[full])
        first = np.flatnonzero(~later)
    else:
        first = np.zeros(0, np.int64)
    shard = passages.shard_of(hashes[first], shards)
    by_shard = np.argsort(shard, kind="stable")
    first, shard = first[by_shard], shard[by_shard]
    edges = np.flatnonzero(np.concatenate(([True], shard[1:] != shard[:-1], [True]))) if len(first) else np.zeros(1, int)
    rows = []
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        own = first[a:b]
        sent = around[own][inside[own]] - np.uint64(1)
        large = np.stack((order[own], doc[own], local[own]))
        small = np.stack((before[own], behind[own])).astype(np.uint8)
        head = np.array([b - a], np.int64)
        rows.append((int(shard[a]), b"R" + b"".join(x.tobytes() for x in (
            head, large, small, (sent & np.uint64(0xFFFFFFFF)).astype(np.uint32), (sent >> np.uint64(32)).astype(np.uint8)
        ))))
    return rows, spans


def unpacked(data: bytes) -> tuple[np.ndarray, ...]:
    """Order, document, place, words before and behind, and the matrix of words (0: none) of sent passages."""
    n = int(np.frombuffer(data, np.int64, 1, 1)[0])
    order, doc, place = np.frombuffer(data, np.int64, 3 * n, 9).reshape(3, n)
    at = 9 + 24 * n
    before, behind = np.frombuffer(data, np.uint8, 2 * n, at).reshape(2, n).astype(np.int64)
    at += 2 * n
    total = int((before + behind).sum())
    words = np.frombuffer(data, np.uint32, total, at).astype(np.int64)
    words += np.frombuffer(data, np.uint8, total, at + 4 * total).astype(np.int64) << 32
    steps = np.arange(-BEFORE, LENGTH)[None, :]
    rows = np.zeros((n, WIDTH), np.int64)
    rows[(steps >= -before[:, None]) & (steps < behind[:, None])] = words + 1
    return order, doc, place, before, behind, rows


def covered_windows(rows: np.ndarray, least: np.ndarray, before: np.ndarray, behind: np.ndarray) -> np.ndarray:
    """For distinct passages with the least order that holds each: which windows stand in one of smaller order."""
    result = np.zeros((len(rows), BEFORE + 1), bool)
    grams = same_rows(rows[:, BEFORE : BEFORE + GRAM])
    several = np.flatnonzero(np.bincount(grams)[grams] > 1)
    if not len(several):
        return result
    text = np.concatenate((rows[several], np.zeros((len(several), 1), np.int64)), axis=1).ravel()
    values, symbols, counts = np.unique(text, return_inverse=True, return_counts=True)
    # words that occur once here match nowhere else: one symbol, which windows with a match can't have
    name = np.cumsum((counts > 1) & (values > 0)) + 1
    name = np.where(values == 0, 0, np.where(counts > 1, name, 1))
    text = name[symbols.ravel()]
    index = FMIndex(text, 1 << (LENGTH - 1).bit_length())
    matrix = text.reshape(len(several), WIDTH + 1)
    row, start = np.meshgrid(np.arange(len(several)), np.arange(BEFORE + 1), indexing="ij")
    row, start = row.ravel(), start.ravel()
    fits = (start >= BEFORE - before[several][row]) & (start + LENGTH <= BEFORE + behind[several][row])
    row, start = row[fits], start[fits]
    patterns = matrix[row[:, None], start[:, None] + np.arange(LENGTH)[None, :]]
    common = (patterns > 1).all(axis=1)
    row, start, patterns = row[common], start[common], patterns[common]
    matched, low, high = index.matches(patterns, least=2)
    whole = np.flatnonzero(matched == LENGTH)
    if not len(whole):
        return result
    # equal windows have one range, different windows disjoint ones
    lows, place = np.unique(low[whole], return_index=True)
    highs = high[whole][place]
    owner = least[several][np.minimum(index.suffixes // (WIDTH + 1), len(several) - 1)]
    bounds = np.stack((lows, np.minimum(highs, len(owner) - 1)), axis=1).ravel()
    smallest = np.minimum.reduceat(owner, bounds)[::2]
    smallest = np.where(highs == len(owner), np.minimum(smallest, owner[-1]), smallest)
    found = smallest[np.searchsorted(lows, low[whole])] < least[several][row[whole]]
    result[several[row[whole][found]], start[whole][found]] = True
    return result


def settle(parts: list[tuple[int, bytes]]) -> Iterator[tuple[int, np.ndarray]]:
    """Spans of the windows that also start in a document with a smaller id, per block."""
    if not parts:
        return
    own = [unpacked(data) for _, data in parts]
    number = np.repeat(np.array([block for block, _ in parts], np.int64), [len(part[0]) for part in own])
    order, doc, place, before, behind, rows = (np.concatenate(columns) for columns in zip(*own))
    same = same_rows(rows)
    least = np.full(same.max() + 1, np.iinfo(np.int64).max)
    np.minimum.at(least, same, order)
    example = np.zeros(len(least), np.int64)
    example[same] = np.arange(len(same))
    windows = covered_windows(rows[example], least, before[example], behind[example])[same]
    starts = np.arange(BEFORE + 1)[None, :]
    able = (starts >= BEFORE - before[:, None]) & (starts + LENGTH <= BEFORE + behind[:, None])
    covered = able & (windows | (order > least[same])[:, None])
    edge = np.diff(np.concatenate((covered, np.zeros((len(covered), 1), bool)), axis=1).astype(np.int8), axis=1, prepend=0)
    row, first = np.nonzero(edge == 1)
    last = np.nonzero(edge == -1)[1] - 1
    spans = np.stack((doc[row], place[row] + first - BEFORE, place[row] + last - BEFORE + LENGTH), axis=1)
    for block in np.unique(number[row]):
        yield int(block), passages.merged(spans[number[row] == block])


def remove(block: passages.Block, spans: np.ndarray) -> dict[str, pa.Array]:
    words = [text.split() for text in block.texts]
    counts = np.array([len(own) for own in words], np.int64)
    gone = passages.covered_flags(counts, spans)
    removed = segment_sums(gone.astype(np.int64), counts)
    starts = starts_of(counts)
    kept = [
        b" ".join(compress(own, (~gone[starts[k] : starts[k + 1]]).tolist()) if removed[k] else own)
        for k, own in enumerate(words)
    ]
    return {"n_words": pa.array(counts), "n_removed": pa.array(removed), "kept": pa.array(kept, pa.binary()).cast(pa.string())}


def drop_passages(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None,
    hot_rows: int = passages.HOT_ROWS,
) -> DataFrame:
    """One row per row of ``docs``: its id, ``n_words``, ``n_removed`` and ``kept`` (words joined by a space).

    Words are runs of ``[^\\x20\\x09-\\x0D]``. Each word is removed that lies in a window of 13 words
    which also starts in a document with a smaller id; windows never cross documents and are
    judged on the input. Null texts have no words; null ids come last; rows with the same id
    (and all with a null id) remove nothing from each other. Of the other columns those in
    ``carry`` come along, the rest is not read. ``hot_rows`` different surroundings of an anchor
    make it one whose passages are dealt window by window; it has no part in the result. An empty table gives an empty result.
    """
    return passages.search(
        docs, id_col, text_col, anchors_of, surroundings, settle, remove, "n_words long, n_removed long, kept string",
        hot_rows, carry,
    )


def op3_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """What remains of every document without passages of documents with smaller ids."""
    return drop_passages(spark.read.parquet(f"{sf_dir}/documents.parquet")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


QUERIES = {"op3_substring_dedup": op3_substring_dedup}
