"""Byte-level BPE encoding and decoding by corpus-level merge replay.

The words of many documents are encoded together. Every distinct word is laid out once, as
bytes, in one array; an inverted index leads from each token pair to the positions where it
stands. Merges are then replayed in rank order: each takes the positions of its pair, joins
them all at once and updates only the neighbours it touched. Documents are put together
from the ids of their words.

A task replays the words of about ``batch_bytes`` of text at a time, so its memory has a
bound whatever the input, and nothing is shuffled.
"""

from __future__ import annotations

import base64
import heapq
import re
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from feedstat.llm.arrays import binary_column, gather, starts_of, text_batches

#: Bytes of text encoded, and of ids decoded, at a time.
ENCODE_BYTES, DECODE_BYTES = 6 << 20, 3 << 20
NONE = np.iinfo(np.int32).max
#: White space before a space before more of it: where a text can't be cut at each space.
RUNS = re.compile(r"\s (?:\s|\Z)")


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class MergeReplay:
    """The merges of a rank file, replayed over many words at once."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.of_byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.stride = max(ranks.values()) + 1
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left * self.stride + right] = rank
        self.pairs = np.array(sorted(pairs), np.int64)
        self.joined = np.array([pairs[key] for key in self.pairs], np.int32)
        by_rank = sorted((rank, token) for token, rank in ranks.items())
        lengths = np.zeros(self.stride, np.int64)
        for rank, token in by_rank:
            lengths[rank] = len(token)
        self.token_starts = starts_of(lengths)
        self.token_bytes = np.frombuffer(b"".join(token for _, token in by_rank), np.uint8)

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, ``NONE`` where its join is no token."""
        key = left.astype(np.int64) * self.stride + right
        place = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[place] == key, self.joined[place], NONE)

    def encode_one(self, word: bytes) -> list[int]:
        """One word, merge after merge: always the leftmost pair of the lowest rank."""
        parts = [bytes([b]) for b in word]
        while len(parts) > 1:
            ranks = [self.ranks.get(a + b, NONE) for a, b in zip(parts, parts[1:])]
            low = min(ranks)
            if low == NONE:
                break
            at = ranks.index(low)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[part] for part in parts]

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, joined, and where each word's ids start."""
        text = np.frombuffer(b"".join(words), np.uint8)
        starts = starts_of(np.fromiter(map(len, words), np.int64, len(words)))
        n = len(text)
        token = self.of_byte[text]
        last = np.zeros(n, bool)
        last[starts[1:][starts[1:] > starts[:-1]] - 1] = True
        following = np.arange(1, n + 1, dtype=np.int64)
        following[last] = -1
        before = np.arange(-1, n - 1, dtype=np.int64)
        before[starts[:-1][starts[1:] > starts[:-1]]] = -1
        alive = np.ones(n, bool)
        rank = np.full(n, NONE, np.int32)
        inner = np.flatnonzero(following >= 0)
        rank[inner] = self.rank_of(token[inner], token[following[inner]])
        index: dict[int, list[np.ndarray]] = {}
        waiting: list[int] = []

        def add(places: np.ndarray) -> None:
            values = rank[places]
            known = values < NONE
            places, values = places[known], values[known]
            if not len(places):
                return
            order = np.argsort(values, kind="stable")
            places, values = places[order], values[order]
            cuts = np.flatnonzero(np.diff(values)) + 1
            for value, group in zip(values[np.concatenate(([0], cuts))].tolist(), np.split(places, cuts)):
                if value in index:
                    index[value].append(group)
                else:
                    index[value] = [group]
                    heapq.heappush(waiting, value)

        add(inner)
        one_by_one = []
        while waiting:
            low = heapq.heappop(waiting)
            groups = index.pop(low)
            at = groups[0] if len(groups) == 1 else np.unique(np.concatenate(groups))
            at = at[rank[at] == low]
            if not len(at):
                continue
            linked = following[at[:-1]] == at[1:]
            if linked.any():  # pairs that share a token: take every other one of a chain, from the left
                chain = np.arange(len(at)) - np.maximum.accumulate(
                    np.where(np.concatenate(([True], ~linked)), np.arange(len(at)), 0)
                )
                at = at[chain % 2 == 0]
            gone = following[at]
            token[at] = low
            alive[gone] = False
            rank[gone] = NONE
            after = following[gone]
            following[at] = after
            has = after >= 0
            before[after[has]] = at[has]
            rank[at] = NONE
            rank[at[has]] = self.rank_of(token[at[has]], token[after[has]])
            previous = before[at]
            previous = np.unique(previous[previous >= 0])
            rank[previous] = self.rank_of(token[previous], token[following[previous]])
            touched = np.union1d(at[has], previous)
            if (early := touched[rank[touched] < low]).size:
                one_by_one.append(early)
            add(touched)
        counts = np.add.reduceat(alive, np.minimum(starts[:-1], max(n - 1, 0))) if n else np.zeros(len(words), int)
        counts = np.where(starts[1:] > starts[:-1], counts, 0)
        ids, id_starts = token[alive], starts_of(counts)
        if one_by_one:  # a merge made a pair of lower rank: the order inside these words matters
            again = np.unique(np.searchsorted(starts, np.concatenate(one_by_one), side="right") - 1)
            pieces = [ids[a:b] for a, b in zip(id_starts[:-1], id_starts[1:])]
            for word in again.tolist():
                pieces[word] = np.array(self.encode_one(words[word]), np.int32)
            ids, id_starts = np.concatenate(pieces), starts_of([len(piece) for piece in pieces])
        return ids, id_starts

    def decode(self, ids: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of each document's ids, joined, and where each document's bytes start."""
        flat, lengths = gather(self.token_bytes, self.token_starts, ids)
        total = starts_of(lengths)
        return flat, total[starts]


def text_units(texts: list[str], pattern) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct units of ``texts``, the units of all texts in order, and how many each text has.

    A unit is cut so that the pattern's matches never cross it: a space and what follows up
    to the next space. Texts with runs of white space that this would cut apart are split
    into the pattern's matches themselves.
    """
    ids: dict = defaultdict()
    ids.default_factory = ids.__len__
    flat, counts = [], []
    for text in texts:
        if not text:
            counts.append(0)
            continue
        if RUNS.search(text):
            own = [ids[(match,)] for match in pattern.findall(text)]
        else:
            first, *rest = text.split(" ")
            own = [ids[(first,)]] if first else []
            own.extend(map(ids.__getitem__, rest))
        flat.append(np.array(own, np.int64))
        counts.append(len(own))
    units = [key[0] if isinstance(key, tuple) else " " + key for key in ids]
    return units, np.concatenate(flat) if flat else np.zeros(0, np.int64), np.array(counts, np.int64)


def encode_texts(
    texts: list[str], pattern, encode_words: Callable[[list[str]], tuple[np.ndarray, np.ndarray]]
) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, joined, and where each text's ids start."""
    units, flat, counts = text_units(texts, pattern)
    ids, starts = encode_words(units)
    out, lengths = gather(ids, starts, flat)
    return out, starts_of(lengths)[starts_of(counts)]


@lru_cache(maxsize=2)
def replay_of(path: str) -> MergeReplay:
    return MergeReplay(read_ranks(path))


def replay_units(replay: MergeReplay, pattern, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of units: each match of the pattern is a word of its own."""
    words: dict = defaultdict()
    words.default_factory = words.__len__
    flat, counts = [], np.zeros(len(units), np.int64)
    for k, unit in enumerate(units):
        own = pattern.findall(unit)
        counts[k] = len(own)
        flat.extend(map(words.__getitem__, own))
    ids, starts = replay.encode([word.encode() for word in words])
    out, lengths = gather(ids, starts, np.array(flat, np.int64))
    return out, starts_of(lengths)[starts_of(counts)]


def encode(
    docs: DataFrame, ranks_path: str, pattern: str, text_col: str = "text", batch_bytes: int = ENCODE_BYTES
) -> DataFrame:
    """``docs`` with ``ids``: the token ids of the whole text, as little-endian unsigned 32-bit integers.

    ``ranks_path`` names a rank file that every executor has (tokenizer files are installed
    with the software). Each match of ``pattern`` is encoded by itself, with no special
    tokens. A null text has no ids. Rows, repeated or not, are encoded one by one; other
    columns pass through, but for one named ``ids``, which gives way to the result.
    """
    docs = docs.drop("ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher, replay = regex.compile(pattern), replay_of(ranks_path)
        for table in text_batches(batches, text_col, batch_bytes):
            texts = [text or "" for text in table[text_col].to_pylist()]
            ids, starts = encode_texts(texts, matcher, lambda units: replay_units(replay, matcher, units))
            out = table.append_column("ids", binary_column(ids.astype("<u4"), starts))
            yield from out.combine_chunks().to_batches()

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField("ids", BinaryType())]))


def decode(encoded: DataFrame, ranks_path: str, ids_col: str = "ids", batch_bytes: int = DECODE_BYTES) -> DataFrame:
    """``encoded`` with ``decoded`` (binary) in place of ``ids_col``; null ids decode to no bytes."""
    kept = [field for field in encoded.schema.fields if field.name != ids_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        replay = replay_of(ranks_path)
        for table in text_batches(batches, ids_col, batch_bytes):
            ids = [np.frombuffer(value or b"", "<u4") for value in table[ids_col].to_pylist()]
            flat, starts = replay.decode(
                np.concatenate(ids).astype(np.int64), starts_of([len(own) for own in ids])
            )
            out = table.drop_columns([ids_col]).append_column("decoded", binary_column(flat, starts))
            yield from out.combine_chunks().to_batches()

    return encoded.mapInArrow(run, StructType([*kept, StructField("decoded", BinaryType())]))


def op1_bpe(spark, sf_dir: str) -> DataFrame:
    """Token count and digests of the ids and of the decoded bytes of every document."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    encoded = encode(docs, path, public_tokenizers.PATTERN).select(
        "doc_id", "ids",
        F.expr("length(ids) div 4").cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
    )
    return decode(encoded, path).select(
        "doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256")
    )


QUERIES = {"op1_bpe": op1_bpe}
