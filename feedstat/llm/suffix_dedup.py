"""Suffix-array dedup: distributed merge sort of suffixes that knows common prefixes.

Every 100-byte string that occurs twice holds an anchor in both places (see ``passages``), so
only suffixes that start at repeated anchors are sorted. A block sends its suffixes as sorted
runs, front-coded: how many bytes a suffix shares with the one before, and the rest. A shard
merges the runs with a loser tree that compares bytes only where known common prefixes are
equally long, and gets the common prefix of neighbours with the order. Two suffixes that agree in r bytes, and in l bytes
before the anchor, have all windows of 100 bytes in these l + r bytes in common; for each place
of the anchor in a window, the earliest of the equal ones stays and the others are covered.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from feedstat.llm import passages
from feedstat.llm.arrays import binary_column, segment_sums, starts_of

LENGTH = 100
GRAM = 24
BEFORE = LENGTH - GRAM
#: Windows in a class of those around a hot anchor; they have 90 bytes in common.
STEP = 11


def anchors_of(block: passages.Block) -> passages.Anchors:
    """The anchors of a block's bytes."""
    return passages.Anchors(np.frombuffer(b"".join(block.texts), np.uint8), block.lengths, GRAM, LENGTH, STEP)


def taken(data: np.ndarray, places: np.ndarray, before: np.ndarray, behind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``LENGTH`` bytes from each place on, and ``BEFORE`` bytes from there backwards; 0 where a row has fewer."""
    padded = np.concatenate((np.zeros(BEFORE, np.uint8), data, np.zeros(LENGTH, np.uint8)))
    right = np.lib.stride_tricks.sliding_window_view(padded, LENGTH)[places + BEFORE]
    left = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(padded, BEFORE)[places][:, ::-1])
    for rows, held in ((right, behind), (left, before)):
        short = np.flatnonzero(held < rows.shape[1])
        rows[short] *= np.arange(rows.shape[1])[None, :] < held[short, None]
    return right, left


def common_prefixes(rows: np.ndarray) -> np.ndarray:
    """How many leading columns each row shares with the row before; 0 for the first."""
    result = np.zeros(len(rows), np.int64)
    if len(rows) > 1:
        differ = rows[1:] != rows[:-1]
        result[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
    return result


def as_strings(rows: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(rows).view(f"S{rows.shape[1]}").ravel()


def surroundings(block: passages.Block, data: np.ndarray, starts: np.ndarray, sent: tuple[np.ndarray, ...], shards: int):
    """Front-coded runs of the suffixes to send, and the spans of what the block holds twice."""
    places, doc, before, behind, hashes = sent
    right, left = taken(data, places, before, behind)
    keys = as_strings(np.concatenate((right, left, before[:, None].astype(np.uint8), behind[:, None].astype(np.uint8) + 1), axis=1))
    order = np.argsort(keys, kind="stable")  # places of equal ones rise, so the first is the earliest
    fresh = np.ones(len(order), bool)
    fresh[1:] = keys[order][1:] != keys[order][:-1]
    again = order[~fresh]
    local = places - starts[doc]
    spans = np.stack((doc, local - before, local + behind), axis=1)[again]
    spans = passages.merged(spans[before[again] + behind[again] >= LENGTH])
    first = order[fresh]
    shard = passages.shard_of(hashes[first], shards)
    by_shard = np.argsort(shard, kind="stable")  # within a shard they stay in the order of suffixes
    first, shard = first[by_shard], shard[by_shard]
    edges = np.flatnonzero(np.concatenate(([True], shard[1:] != shard[:-1], [True]))) if len(first) else np.zeros(1, int)
    right, left, held, doc, local = right[first], left[first], before[first], doc[first], local[first]
    prefix = common_prefixes(right)
    prefix[edges[:-1]] = 0
    tails, tail_at = right[np.arange(LENGTH)[None, :] >= prefix[:, None]], starts_of(LENGTH - prefix)
    lefts, left_at = left[np.arange(BEFORE)[None, :] < held[:, None]], starts_of(held)
    small = np.stack((prefix, held, behind[first])).astype(np.uint8)
    large = np.stack((block.order[doc], block.tie[doc], local))
    rows = []
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        parts = (np.array([b - a], np.int64), large[:, a:b], small[:, a:b], tails[tail_at[a] : tail_at[b]], lefts[left_at[a] : left_at[b]])
        rows.append((int(shard[a]), b"R" + b"".join(part.tobytes() for part in parts)))
    return rows, spans


class Run:
    """A sorted run as a block sent it."""

    def __init__(self, data: bytes):
        n = int(np.frombuffer(data, np.int64, 1, 1)[0])
        self.order, self.tie, self.place = np.frombuffer(data, np.int64, 3 * n, 9).reshape(3, n)
        at = 9 + 24 * n
        small = np.frombuffer(data, np.uint8, 3 * n, at).reshape(3, n).astype(np.int64)
        self.prefix, self.before, self.behind = small
        at += 3 * n
        sizes = LENGTH - self.prefix
        tails = data[at : at + int(sizes.sum())]
        self.left = np.zeros((n, BEFORE), np.uint8)
        self.left[np.arange(BEFORE)[None, :] < self.before[:, None]] = np.frombuffer(data, np.uint8, int(self.before.sum()), at + len(tails))
        self.suffixes, last, end = [], b"", 0
        for prefix, size in zip(self.prefix.tolist(), sizes.tolist()):
            last = last[:prefix] + tails[end : end + size]
            end += size
            self.suffixes.append(last)


def merge_runs(runs: list[list[bytes]], prefixes: list[list[int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Run and place in it of all suffixes in order, and the common prefix of each with the one before.

    A loser tree. Each entry that waits in it knows the prefix it shares with the last suffix
    given out, or with the one that beat it. Of two that share different lengths the longer
    is the smaller suffix, with no byte compared; of two that share the same length the first byte that
    differs decides. Suffixes that wait are numbers of ``LENGTH`` bytes; a run that has ended shares -1.
    """
    width = 1
    while width < max(1, len(runs)):
        width *= 2
    total = sum(map(len, runs))
    number = int.from_bytes
    current = [number(own[0], "big") if own else 0 for own in runs] + [0] * (width - len(runs))
    shared = [0 if own else -1 for own in runs] + [-1] * (width - len(runs))
    place, losers = [0] * width, [-1] * width
    out_run, out_place, out_prefix = [], [], []

    def climb(best: int, node: int, until: int) -> int:
        """The winner of ``best`` against the losers on its way from ``node`` up to ``until``; they stay behind."""
        x, known = current[best], shared[best]
        while node > until:
            other = losers[node]
            rest = shared[other]
            if rest > known:
                losers[node], best = best, other
                x, known = current[best], rest
            elif rest == known and known >= 0:
                y = current[other]
                # what the loser shares is then what it shares with the winner
                differs = LENGTH - ((x ^ y).bit_length() + 7 >> 3)
                if x <= y:
                    shared[other] = differs
                else:
                    shared[best] = differs
                    losers[node], best, x = best, other, y
            node >>= 1
        return best

    winners = list(range(width))
    while len(winners) > 1:
        level = len(winners) // 2
        for k in range(level):
            losers[level + k] = winners[2 * k + 1]
            winners[k] = climb(winners[2 * k], level + k, (level + k) >> 1)
        del winners[level:]
    best = winners[0]
    for _ in range(total):
        at = place[best]
        out_run.append(best)
        out_place.append(at)
        out_prefix.append(shared[best])
        place[best] = at = at + 1
        own = runs[best]
        if at < len(own):
            current[best], shared[best] = number(own[at], "big"), prefixes[best][at]
        else:
            shared[best] = -1
        best = climb(best, (best + width) >> 1, 0)
    return np.array(out_run, np.int64), np.array(out_place, np.int64), np.array(out_prefix, np.int64)


def longest_shared(prefix: np.ndarray) -> np.ndarray:
    """The longest prefix that each row shares with any other, from what neighbours share."""
    return np.maximum(prefix, np.append(prefix[1:], 0))


def repeats_of(right: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Which places hold a pair of numbers (of 31 bits at most) that an earlier place holds too."""
    bits = max(1, int(max(right.max(), left.max(), len(right))).bit_length()) if len(right) else 1
    pairs = right << bits | left
    if 3 * bits > 63:
        pairs = np.unique(pairs, return_inverse=True)[1].ravel()
    # pair and place as one number, which sorts faster than places by pair
    found = np.sort(pairs << bits | np.arange(len(pairs)))
    again = np.flatnonzero(found[1:] >> bits == found[:-1] >> bits) + 1
    return found[again] & ((1 << bits) - 1)


def settle(parts: list[tuple[int, bytes]]) -> Iterator[tuple[int, np.ndarray]]:
    """Spans of the windows that start earlier elsewhere, per block."""
    runs = [Run(data) for _, data in parts]
    if not runs:
        return
    run, at, prefix = merge_runs([own.suffixes for own in runs], [own.prefix.tolist() for own in runs])
    same = prefix >= GRAM
    needed = same | np.concatenate((same[1:], [False]))
    offsets = starts_of([len(own.suffixes) for own in runs])
    index = (offsets[run] + at)[needed]
    prefix, run = prefix[needed], run[needed]
    n = len(index)
    if not n:
        return
    # only what is needed stays in memory
    joined = {name: np.concatenate([getattr(own, name) for own in runs])[index] for name in ("order", "tie", "place", "before", "behind", "left")}
    runs.clear()
    by_left = np.argsort(as_strings(joined["left"]), kind="stable")
    left_prefix = common_prefixes(joined["left"][by_left])
    by_age = np.lexsort((joined["place"], joined["tie"], joined["order"]))
    # a window is in common only with a row that shares enough to its right, and with one that does to its left
    most_right, most_left = longest_shared(prefix), np.empty(n, np.int64)
    most_left[by_left] = longest_shared(left_prefix)
    most_right, most_left = np.minimum(most_right, joined["behind"]), np.minimum(most_left, joined["before"])
    by_age = by_age[(most_right + most_left >= LENGTH)[by_age]]
    covered = np.zeros((n, BEFORE + 2), bool)
    left_name = np.empty(n, np.int64)
    for before in range(BEFORE + 1):
        own = by_age[((most_left >= before) & (most_right >= LENGTH - before))[by_age]]
        if len(own):
            right_name = np.cumsum(prefix < LENGTH - before)
            left_name[by_left] = np.cumsum(left_prefix < before)
            covered[own[repeats_of(right_name[own], left_name[own])], before] = True
    edge = np.diff(covered.astype(np.int8), axis=1, prepend=0)
    row, low = np.nonzero(edge == 1)
    high = np.nonzero(edge == -1)[1] - 1
    doc = joined["tie"][row] & ((1 << 24) - 1)
    spans = np.stack((doc, joined["place"][row] - high, joined["place"][row] - low + LENGTH), axis=1)
    number = np.array([block for block, _ in parts], np.int64)[run[row]]
    for block in np.unique(number):
        yield int(block), passages.merged(spans[number == block])


def remove(block: passages.Block, spans: np.ndarray) -> dict[str, pa.Array]:
    data = np.frombuffer(b"".join(block.texts), np.uint8)
    gone = passages.covered_flags(block.lengths, spans)
    starts = starts_of(block.lengths)
    fresh = gone.copy()
    fresh[1:] &= ~gone[:-1]
    borders = starts[1:-1][starts[1:-1] < len(gone)]
    fresh[borders] = gone[borders]
    removed = segment_sums(gone.astype(np.int64), block.lengths)
    return {
        "n_bytes": pa.array(block.lengths), "n_removed": pa.array(removed),
        "n_spans": pa.array(segment_sums(fresh.astype(np.int64), block.lengths)),
        "kept": binary_column(data[~gone], starts_of(block.lengths - removed)),
    }


def drop_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot_rows: int = passages.HOT_ROWS
) -> DataFrame:
    """One row per row of ``docs``: its id, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept`` (binary).

    Texts are UTF-8 bytes; each byte is removed that lies in a 100-byte string that also starts
    earlier: in a document with a smaller id, or before it in the same one. Matches never cross
    documents and are judged on the input. Null texts are empty; null ids come last; of rows
    with the same id the shorter text counts as earlier, and of equal rows one of them. Other columns are
    not read. ``hot_rows`` different surroundings of an anchor make it one whose passages are dealt by
    classes of windows; it has no part in the result. An empty table gives an empty result.
    """
    return passages.search(
        docs, id_col, text_col, anchors_of, surroundings, settle, remove,
        "n_bytes long, n_removed long, n_spans long, kept binary", hot_rows,
    )


def op9_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    """What remains of every document without its repeated passages."""
    return drop_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


QUERIES = {"op9_suffix_dedup": op9_suffix_dedup}
