"""Packing documents into fixed-length sequences: dominance reduction, then best fit.

Every document is cut into pieces of at most ``capacity`` tokens. What the packing depends
on is only how many pieces have each length, a table of ``capacity`` counts whatever the
corpus. The plan is made from these counts:

- Martello-Toth reduction: a set of pieces that provably dominates every other way to fill
  the sequence of its largest piece is fixed for good, as often as the counts allow;
- what remains is packed by best fit, from the longest lengths down.

The plan says which ranks of each length go to which sequences and offsets. Pieces get their
ranks from counts per block of rows, so no length is ever gathered in one task.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from feedstat.llm.arrays import binary_column, gather, starts_of, text_batches
from feedstat.session import materialize, small_batches

CAPACITY = 1024
END_ID = 2
#: Bytes of text encoded at a time, units a task remembers, and units encoded in one string.
BATCH_BYTES, STORE_UNITS, JOINED_UNITS = 2 << 20, 1 << 20, 4096
#: Unicode's white space; a space with white space on both sides, or at the end, does not start a unit.
WHITE = r"\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
SPACE_RUNS = rf"[{WHITE}] (?:[{WHITE}]|\z)"
PLAIN_PART = rf"(?s)\A[ \n][^{WHITE}](?:.*[^{WHITE}])?\z"
#: Of each byte, whether it is a sign that a run of letters or digits ends at, and whether it is a letter or digit.
SIGNS, WORDS = (np.isin(np.arange(256), list(own)) for own in (
    b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~", b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
))


def reduce_by_dominance(counts: list[int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Takes sets of pieces that dominate all alternatives out of ``counts``; returns them with their number.

    For a piece of length a and the longest piece b that fits beside it:

    - nothing fits beside a: {a} dominates;
    - a + b fills the sequence: {a, b} dominates, as whatever stands beside a sums to b at most;
    - no two pieces fit beside a together: {a, b} dominates, as b is the best single piece.

    All three stay true while a and b last, so a set is fixed as often as both allow.
    """
    fixed = []
    for a in range(capacity, 0, -1):
        while counts[a]:
            counts[a] -= 1  # what may stand beside one a
            beside = [x for x in range(capacity - a, 0, -1) if counts[x]]
            counts[a] += 1
            if not beside:
                fixed.append(((a,), counts[a]))
                counts[a] = 0
                break
            b, small = beside[0], beside[-1]
            alone = counts[small] - (small == a) < 2
            second = beside[-2] if alone and len(beside) > 1 else capacity if alone else small
            if a + b < capacity and a + small + second <= capacity:
                break
            times = counts[a] // 2 if a == b else min(counts[a], counts[b])
            counts[a] -= times
            counts[b] -= times
            fixed.append(((a, b), times))
    return fixed


def best_fit(counts: list[int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit from the longest length down, for all pieces of a length at once.

    Sequences with the same content are one entry, so the number of entries depends on
    ``capacity`` only.
    """
    room: dict[int, list[tuple[tuple[int, ...], int]]] = {}

    def put(content: tuple[int, ...], number: int, free: int) -> None:
        if number:
            room.setdefault(free, []).append((content, number))

    for length in range(capacity, 0, -1):
        left = counts[length]
        for free in range(length, capacity):
            while left and room.get(free):
                content, number = room[free].pop()
                each = free // length
                whole = min(number, left // each)
                put(content + (length,) * each, whole, free - each * length)
                left -= whole * each
                number -= whole
                if number and left:  # fewer pieces than one such sequence takes
                    put(content + (length,) * left, 1, free - left * length)
                    number, left = number - 1, 0
                if number:
                    room[free].append((content, number))
                    break
        each = capacity // length
        put((length,) * each, left // each, capacity - each * length)
        if left % each:
            put((length,) * (left % each), 1, capacity - left % each * length)
    return [entry for entries in room.values() for entry in entries]


def make_plan(counts: list[int], capacity: int) -> dict[int, np.ndarray]:
    """For each length, rows of (first rank, first sequence, offset, pieces in a sequence), by first rank."""
    left = list(counts)
    entries = reduce_by_dominance(left, capacity) + best_fit(left, capacity)
    given, rows, sequence = [0] * (capacity + 1), {}, 0
    for content, number in entries:
        offset = 0
        for length in sorted(set(content), reverse=True):
            each = content.count(length)
            rows.setdefault(length, []).append((given[length], sequence, offset, each))
            given[length] += each * number
            offset += each * length
        sequence += number
    assert given[1:] == list(counts)[1:]
    return {length: np.array(own, np.int64) for length, own in rows.items()}


def cut_pieces(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Document, number, start and length of each piece; a first piece may be shorter, others are full."""
    pieces = -(-lengths // capacity)
    doc = np.repeat(np.arange(len(lengths)), pieces)
    number = np.arange(len(doc)) - np.repeat(starts_of(pieces)[:-1], pieces)
    first = lengths - (pieces - 1) * capacity
    start = np.where(number == 0, 0, first[doc] + (number - 1) * capacity)
    return doc, number, start, np.where(number == 0, first[doc], capacity)




def pack(tokens: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Places pieces into sequences of at most ``capacity`` tokens.

    ``tokens`` has a row per piece: ``length`` (1 to ``capacity``), ``block`` and ``place``: the
    piece is number ``place`` of its length in its block, from 0. It is read twice, so it has
    to be a written table. Returns it with ``sequence_id`` and ``offset``, gapless from 0.
    The driver holds one count per length; a task gets the plan, whose size depends on
    ``capacity`` only.
    """
    blocks = tokens.groupBy("length", "block").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = materialize(blocks.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))), "pack-blocks")
    counts = [0] * (capacity + 1)
    for length, n in blocks.groupBy("length").agg(F.sum("n")).collect():
        counts[length] = n
    plan = make_plan(counts, capacity)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch["length"].to_numpy()
            rank = batch["place"].to_numpy() + batch["before"].to_numpy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for size in np.unique(length).tolist():
                own = np.flatnonzero(length == size)
                rows = plan[size]
                at = rows[np.searchsorted(rows[:, 0], rank[own], side="right") - 1]
                since = rank[own] - at[:, 0]
                sequence[own] = at[:, 1] + since // at[:, 3]
                offset[own] = at[:, 2] + since % at[:, 3] * size
            kept = batch.select([name for name in batch.schema.names if name not in ("block", "place", "before")])
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(sequence), pa.array(offset)],
                [*kept.schema.names, "sequence_id", "offset"],
            )

    joined = tokens.join(blocks.select("length", "block", "before"), ["length", "block"])
    fields = [f for f in joined.schema.fields if f.name not in ("block", "place", "before")]
    schema = StructType([*fields, StructField("sequence_id", LongType()), StructField("offset", LongType())])
    return joined.mapInArrow(place, schema)


@lru_cache(maxsize=2)
def tokenizer_of(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel work
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
    return tokenizer


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts, joined, and where each starts."""
    starts = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, 4 * texts.offset).astype(np.int64)
    data = texts.buffers()[2]
    return np.frombuffer(data, np.uint8)[starts[0] : starts[-1]] if data else np.zeros(0, np.uint8), starts - starts[0]


def parts_of(units: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Units cut where the tokenizer cuts them anyway, all parts in a row, and where each unit's parts start.

    A cut is before a line end behind a letter, digit or sign, and before the signs at the end of a
    unit, or before such a line end, that stand behind a letter or digit. Letters are those of ASCII and Latin-1.
    """
    data, starts = bytes_of(units)
    if not len(data):
        return units, np.arange(len(units) + 1)
    sign = SIGNS[data]
    word = WORDS[data]
    word[1:] |= (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)
    lines = np.flatnonzero((data[1:] == 10) & (word | sign)[:-1]) + 1
    ends = np.flatnonzero(sign[1:] & word[:-1]) + 1
    border = np.zeros(len(data) + 1, bool)
    border[starts] = border[lines] = True
    borders = np.flatnonzero(border)
    signs = starts_of(sign)
    until = borders[np.searchsorted(borders, ends, side="right")]
    ends = ends[signs[until] - signs[ends] == until - ends]
    # a cut where a unit starts is none; empty units keep their part
    border[ends], border[starts] = True, False
    inner = np.flatnonzero(border)
    cuts = np.sort(np.concatenate((starts, inner)), kind="stable")
    parts = binary_column(data, cuts).cast(pa.string())
    return parts, np.arange(len(starts)) + np.searchsorted(inner, starts)


class UnitStore:
    """Ids of the parts of units of text that a task has met, each encoded once.

    A unit is a space and what follows up to the next space: the tokenizer's own split never
    crosses its start, nor that of its parts. Parts that start with a space or line end and have no white space behind
    it or at their end can be encoded in one string, and the ids are dealt back by the bytes that each
    stands for. When more than ``most`` parts are held, all are forgotten.
    """

    def __init__(self, path: str, most: int = STORE_UNITS):
        self.tokenizer, self.most = tokenizer_of(path), most
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.token_bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, number in vocabulary.items():
            self.token_bytes[number] = len(token)  # a byte-level token has one character per byte
        self.forget()

    def forget(self) -> None:
        self.units = pa.array([], pa.string())
        self.ids, self.starts = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def one_by_one(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        encoded = [own.ids for own in self.tokenizer.encode_batch_fast(units.to_pylist(), add_special_tokens=False)]
        lengths = np.fromiter(map(len, encoded), np.int64, len(encoded))
        return np.fromiter((x for own in encoded for x in own), np.int32, int(lengths.sum())), lengths

    def together(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of parts with no white space behind their first character or at their end, and how many each has."""
        ids, counts = [], []
        for start in range(0, len(units), JOINED_UNITS):
            own = units.slice(start, JOINED_UNITS)
            joined = bytes_of(own)[0].tobytes().decode()
            found = np.array(self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, np.int32)
            ends = np.cumsum(self.token_bytes[found])
            wanted = np.cumsum(pc.binary_length(own).to_numpy(), dtype=np.int64)
            stops = np.searchsorted(ends, wanted)
            if len(found) and stops[-1] < len(ends) and (ends[stops] == wanted).all() and stops[-1] == len(ends) - 1:
                own_counts = np.diff(stops, prepend=-1)
            else:
                found, own_counts = self.one_by_one(own)
            ids.append(found)
            counts.append(own_counts)
        return (np.concatenate(ids), np.concatenate(counts)) if ids else (np.zeros(0, np.int32), np.zeros(0, np.int64))

    def places(self, units: pa.Array) -> np.ndarray:
        """Where each of the distinct ``units`` (parts of them) stands in the store; new ones are encoded."""
        if len(self.units) > self.most:
            self.forget()
        place = pc.fill_null(pc.index_in(units, self.units), -1).to_numpy().copy()
        new = np.flatnonzero(place < 0)
        alone = pc.match_substring_regex(units.take(pa.array(new)), PLAIN_PART).to_numpy(zero_copy_only=False)
        for rows, encode in ((new[alone], self.together), (new[~alone], self.one_by_one)):
            own = units.take(pa.array(rows))
            ids, counts = encode(own)
            place[rows] = len(self.units) + np.arange(len(rows))
            self.units = pa.concat_arrays([self.units, own])
            self.ids = np.concatenate([self.ids, ids])
            self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(counts, dtype=np.int64)])
        return place

    def encode(self, texts: pa.Array, matcher) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, joined, and where each text's ids start."""
        runs = pc.match_substring_regex(texts, SPACE_RUNS)
        pieces = pc.split_pattern(pc.if_else(runs, "", texts), " ")
        counts = pc.list_value_length(pieces).to_numpy().astype(np.int64)
        flat = pieces.flatten()
        starts = starts_of(counts)[:-1]
        known = flat.dictionary_encode()
        # the first piece of a text has no space before it
        units = [pc.binary_join_element_wise("", known.dictionary, " "), flat.take(pa.array(starts))]
        index = known.indices.to_numpy().astype(np.int64)
        index[starts] = len(known.dictionary) + np.arange(len(starts))
        if pc.any(runs).as_py():
            own = [matcher.findall(text) for text in texts.filter(runs).to_pylist()]
            where = np.flatnonzero(runs.to_numpy(zero_copy_only=False))
            counts[where] = [len(matches) for matches in own]
            keep = np.ones(len(flat), bool)
            keep[starts[where]] = False  # the empty stand-in of such a text
            units.append(pa.array([match for matches in own for match in matches], flat.type))
            index = np.concatenate((index[keep], sum(map(len, units[:2])) + np.arange(len(units[2]))))
            order = np.argsort(np.concatenate([
                np.repeat(np.delete(np.arange(len(texts)), where), np.delete(counts, where)), np.repeat(where, counts[where])
            ]), kind="stable")
            index = index[order]
        parts, part_starts = parts_of(pa.concat_arrays(units))
        parts = parts.dictionary_encode()
        place = self.places(parts.dictionary)[parts.indices.to_numpy()]
        place, numbers = gather(place, part_starts, index)
        out, lengths = gather(self.ids, self.starts, place)
        return out, starts_of(lengths)[starts_of(numbers)[starts_of(counts)]]


def tokenize_pieces(
    docs: DataFrame, tokenizer_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
    capacity: int = CAPACITY, end_id: int = END_ID, batch_bytes: int = BATCH_BYTES,
) -> DataFrame:
    """A row per piece: ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``, ``block``, ``place``.

    A document is the tokenizer's ids of its whole text and then ``end_id``; a null text is
    empty. ``pattern`` is the tokenizer's own split, which tells where a text can be cut: a task
    encodes each distinct unit once, as long as its store of units has room. A text is one
    row: a very long one is encoded whole, at about 30 bytes of memory a byte.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        matcher, block, store = regex.compile(pattern), TaskContext.get().partitionId(), UnitStore(tokenizer_path)
        seen = np.zeros(capacity + 1, np.int64)
        for table in text_batches(batches, text_col, batch_bytes):
            texts = pc.fill_null(table[text_col].combine_chunks(), "")
            ids, starts = store.encode(texts, matcher)
            # the end id goes behind each document
            own = np.insert(ids, starts[1:], end_id).astype("<u4", copy=False)
            starts = starts + np.arange(len(starts))
            doc, number, start, length = cut_pieces(np.diff(starts), capacity)
            begin = starts[:-1][doc] + start
            data = memoryview(own).cast("B")
            crc = np.fromiter(
                (zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(begin.tolist(), (begin + length).tolist())),
                np.int64, len(begin),
            )
            order = np.argsort(length, kind="stable")
            sizes, firsts, numbers = np.unique(length[order], return_index=True, return_counts=True)
            place = np.empty(len(length), np.int64)
            place[order] = np.arange(len(length)) - np.repeat(firsts, numbers) + np.repeat(seen[sizes], numbers)
            seen[sizes] += numbers
            doc_ids = table["id"].take(pa.array(doc))
            columns = {
                "id": doc_ids, "piece": pa.array(number.astype(np.int32)), "start": pa.array(start),
                "length": pa.array(length), "ids_crc32": pa.array(crc),
                "block": pa.array(np.full(len(doc), block, np.int64)), "place": pa.array(place),
            }
            yield from pa.table(columns).to_batches()

    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col))
    kind = plain.schema["id"].dataType.simpleString()
    pieces = plain.mapInArrow(
        run, f"id {kind}, piece int, start long, length long, ids_crc32 long, block long, place long"
    )
    return pieces.withColumnRenamed("id", id_col)


def pack_documents(
    docs: DataFrame, tokenizer_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
    capacity: int = CAPACITY, end_id: int = END_ID,
) -> DataFrame:
    """Tokenizes and packs every row of ``docs``; repeated and null ids are packed like others.

    Pieces are written once, so ranks, counts and places come from the same numbering even
    if tasks run again. An empty table gives an empty result.
    """
    with small_batches(docs.sparkSession):
        pieces = materialize(
            tokenize_pieces(docs, tokenizer_path, pattern, id_col, text_col, capacity, end_id), "pack-pieces"
        )
    return pack(pieces, capacity)


def op6_packing(spark, sf_dir: str) -> DataFrame:
    """The sequence and offset of every piece of ``documents``."""
    import public_tokenizers

    return pack_documents(
        spark.read.parquet(f"{sf_dir}/documents.parquet"),
        public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN,
    ).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


QUERIES = {"op6_packing": op6_packing}
