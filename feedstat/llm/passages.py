"""What the two substring operators share: candidate windows found by their anchors.

A window (a run of ``length`` units) that occurs twice has the same anchors in both places:
the positions whose short hash is the least of the window. The search goes in rounds over
blocks of documents, as one lazy job whose stages Spark can run again:

1. each block sends the hashes of its anchors to the shard that owns them;
2. a shard returns to each block those that another anchor has too, and says which are hot:
   those with many different surroundings, as a short line has that stands everywhere;
3. each block sends, for its hot anchors, the hashes of the windows around them, cut to what all
   windows of a class (whose starts lie close together) have in common; those that come twice return;
4. each block sends what surrounds its repeated anchors to the shards, as sorted runs, a row per
   shard; what a block holds twice is settled inside it and sent once. Around a hot anchor
   only the classes of windows that come twice are sent, each to the shard of its own hash;
5. a shard finds which windows occur earlier elsewhere, and returns the spans they cover;
6. each block removes its spans.

Only the anchors of passages that repeat carry any text, so the volume follows the repeated
part of the corpus. A shard gets each distinct surrounding once per block at most, however
many copies there are, and the different surroundings of a hot anchor go to different shards.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from feedstat.llm.arrays import BASE, anchors, mixed, starts_of, window_hashes

#: Bytes of text in a block of documents.
BLOCK_BYTES = 2 << 20
#: Shards that one task settles, one after the other.
SHARDS_PER_TASK = 4
#: Different surroundings, and at least two in each block on average, that make an anchor a hot one.
HOT_ROWS = 2048
#: Low bits of an entry that hold a count and a flag in place of the hash.
COUNT_BITS = np.uint64(8)
ONE = np.uint64(1)
BLOCK_SCHEMA = "block long, shard long, data binary"


def shard_rows(block: int, shards: np.ndarray, pack: Callable[[int, int], bytes]) -> pa.Table:
    """A row for each shard that has entries; ``shards`` is sorted, ``pack(a, b)`` gives the entries' bytes."""
    edges = np.flatnonzero(np.concatenate(([True], shards[1:] != shards[:-1], [True]))) if len(shards) else np.zeros(1, int)
    own = list(zip(edges[:-1].tolist(), edges[1:].tolist()))
    return pa.table({
        "block": pa.array([block] * len(own), pa.int64()), "shard": pa.array([int(shards[a]) for a, _ in own], pa.int64()),
        "data": pa.array([pack(a, b) for a, b in own], pa.binary()),
    })


def lookup(hashes: np.ndarray, replies: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which 64-bit hashes have their upper bits in the sorted ``replies``, and which of them are hot."""
    if not len(replies):
        return np.zeros(len(hashes), bool), np.zeros(len(hashes), bool)
    upper = hashes >> COUNT_BITS
    at = np.minimum(np.searchsorted(replies >> COUNT_BITS, upper), len(replies) - 1)
    known = replies[at] >> COUNT_BITS == upper
    return known, known & (replies[at] & ONE == ONE)


def inner_windows(lengths: np.ndarray, width: int) -> np.ndarray:
    """For documents laid end to end, which windows of ``width`` units stay inside one."""
    ends = np.cumsum(lengths)
    result = np.ones(max(0, int(ends[-1]) - width + 1) if len(ends) else 0, bool)
    across = (ends[:, None] - np.arange(1, width)).ravel()  # those that start less than a width before an end
    result[across[(across >= 0) & (across < len(result))]] = False
    return result


def shard_of(hashes: np.ndarray, count: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(count) >> np.uint64(32)).astype(np.int64)


def repeated_hashes(batches: Iterator[pa.RecordBatch], hot_rows: int) -> Iterator[pa.RecordBatch]:
    """Per block, the hashes that come twice, from another block too or twice in it, with a lowest bit for hot ones."""
    blocks, parts = [], []
    for batch in batches:
        blocks.extend(batch["block"].to_pylist())
        parts.extend(np.frombuffer(data, np.uint64) for data in batch["data"].to_pylist())
    if not parts:
        return
    sizes = [len(part) for part in parts]
    flat = np.concatenate(parts)
    owner = np.repeat(np.arange(len(parts)), sizes)
    order = np.argsort(flat >> COUNT_BITS, kind="stable")
    flat, owner = flat[order], owner[order]
    hashes = flat >> COUNT_BITS
    first = np.flatnonzero(np.concatenate(([True], hashes[1:] != hashes[:-1])))
    members = np.diff(np.append(first, len(flat)))
    different = np.add.reduceat((flat >> ONE & np.uint64(127)).astype(np.int64), first)
    hot = (different >= hot_rows) & (different >= 2 * members)
    twice = (members > 1) | (flat[first] & ONE == ONE)
    keep = np.repeat(twice, members)
    replies, owner = (hashes << COUNT_BITS | np.repeat(hot, members).astype(np.uint64))[keep], owner[keep]
    back = np.argsort(owner, kind="stable")
    replies, owner = replies[back], owner[back]
    edges = np.searchsorted(owner, np.arange(len(parts) + 1))
    out = [(blocks[k], replies[a:b].tobytes()) for k, (a, b) in enumerate(zip(edges[:-1], edges[1:])) if a < b]
    for k in range(0, len(out), 1000):
        rows = out[k : k + 1000]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], ["block", "data"]
        )


def entries_of(hashes: np.ndarray, around: np.ndarray) -> np.ndarray:
    """Distinct hashes, sorted; the low bits say how many values of ``around`` each has (up to 127), and if it comes twice."""
    if not len(hashes):
        return np.zeros(0, np.uint64)
    order = np.argsort(hashes >> COUNT_BITS, kind="stable")
    upper = (hashes >> COUNT_BITS)[order]
    first = np.flatnonzero(np.concatenate(([True], upper[1:] != upper[:-1])))
    counts = np.diff(np.append(first, len(upper)))
    different = np.ones(len(first), np.int64)
    several = counts > 1
    if several.any():
        group = np.repeat(np.arange(len(first)), counts)
        inside = several[group]
        group, own = group[inside], around[order[inside]]
        by_value = np.lexsort((own, group))
        group, own = group[by_value], own[by_value]
        other = (group[1:] == group[:-1]) & (own[1:] != own[:-1])
        different += np.bincount(group[1:][other], minlength=len(first))
    return upper[first] << COUNT_BITS | np.minimum(different, 127).astype(np.uint64) << ONE | several


def replies_of(data: pa.ChunkedArray) -> np.ndarray:
    """The sorted replies of all shards to a block."""
    parts = [np.frombuffer(part, np.uint64) for part in data.to_pylist()]
    return np.sort(np.concatenate(parts)) if parts else np.zeros(0, np.uint64)


class Anchors:
    """Anchors of a block of ``units``: places, hashes, documents, and the units before and behind (at most ``length``).

    Windows of ``length`` units that start ``k`` units before an anchor are of the class ``k // step``.
    """

    def __init__(self, units: np.ndarray, lengths: np.ndarray, gram: int, length: int, step: int):
        most = length - gram
        self.units, self.most, self.length, self.step = units, most, length, step
        self.starts = starts_of(lengths)
        hashes = mixed(window_hashes(units, gram))
        # 31 bits decide, which take half the time; equal ones are all anchors, and none is 0, which anchors() leaves out
        upper = (hashes >> np.uint64(33)).astype(np.uint32) + np.uint32(1)
        self.places = places = anchors(upper, inner_windows(lengths, length), most + 1) if len(units) >= length else np.zeros(0, np.int64)
        self.hashes = hashes[places]
        # grams that together cover what surrounds an anchor; near the ends of the block, others
        self.around = np.zeros(len(places), np.uint64)
        for at in sorted({*range(-most, 0, gram), *range(gram, most, gram), most}):
            self.around = self.around * np.uint64(BASE) + hashes[np.clip(places + at, 0, max(len(hashes) - 1, 0))]
        self.doc = np.searchsorted(self.starts, places, side="right") - 1
        self.before = np.minimum(places - self.starts[self.doc], most)
        self.behind = np.minimum(self.starts[self.doc + 1] - places, length)

    def classes(self, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For anchors with the numbers ``hot``: anchor, least start and hash of each class of windows they stand in."""
        if not len(hot):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
        least = np.arange(0, self.most + 1, self.step)
        reach = np.minimum(self.before[hot, None], least + self.step - 1) + np.minimum(self.behind[hot, None], self.length - least)
        anchor, number = np.nonzero(reach >= self.length)
        anchor, least = hot[anchor], least[number]
        common = window_hashes(self.units, self.length - self.step + 1)[self.places[anchor] - least]
        return anchor, least, mixed(common + least.astype(np.uint64))

    def hot_hashes(self, replies: np.ndarray) -> np.ndarray:
        """The hashes of all classes of the hot anchors."""
        return self.classes(np.flatnonzero(lookup(self.hashes, replies)[1]))[2]

    def sent(self, replies: np.ndarray, again: np.ndarray) -> tuple[np.ndarray, ...]:
        """Place, document, units before and behind, and hash that deals it, of all passages to send.

        Of a hot anchor a passage for each class whose hash is in ``again``, cut to what the class spans.
        """
        known, hot = lookup(self.hashes, replies)
        plain = np.flatnonzero(known & ~hot)
        anchor, least, hashes = self.classes(np.flatnonzero(hot))
        keep = lookup(hashes, again)[0]
        anchor, least, hashes = anchor[keep], least[keep], hashes[keep]
        both = np.concatenate((plain, anchor))
        before = np.concatenate((self.before[plain], np.minimum(self.before[anchor], least + self.step - 1)))
        behind = np.concatenate((self.behind[plain], np.minimum(self.behind[anchor], self.length - least)))
        return self.places[both], self.doc[both], before, behind, np.concatenate((self.hashes[plain], hashes))


class Block:
    """The documents of a block, in order of their ids; null ids come last.

    Of documents with the same id shorter ones come first, then the order of their bytes.
    ``order`` and ``tie`` compare documents of any blocks.
    """

    def __init__(self, table: pa.Table):
        rank = pc.fill_null(table["doc_id"], np.iinfo(np.int64).max).to_numpy()
        texts = [(text or "").encode() for text in table["text"].to_pylist()]
        self.rows = np.array(sorted(range(len(texts)), key=lambda k: (rank[k], len(texts[k]), texts[k])), np.int64)
        self.texts = [texts[k] for k in self.rows]
        self.lengths = np.array([len(text) for text in self.texts], np.int64)
        self.order = rank[self.rows]
        self.tie = (self.lengths << 24) + np.arange(len(texts))


def search(
    docs: DataFrame, id_col: str, text_col: str,
    anchors_of: Callable, surroundings: Callable, settle: Callable, remove: Callable, schema: str, hot_rows: int,
    carry: list[str] | None = None, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The rounds above over ``docs``.

    ``anchors_of(block)`` gives :class:`Anchors`; ``surroundings(block, units, starts, sent, shards)`` gives (shard,
    bytes) rows of what ``Anchors.sent`` names and the spans settled inside; ``settle(parts)`` gives (block, spans); and
    ``remove(block, spans)`` the result columns in the order of the block's rows. Spans are
    int64 triples (document of the block, first, end). Columns of ``carry`` come along unread.
    """
    spark = docs.sparkSession
    carried = F.struct(*carry) if carry else F.lit(None).cast("int")
    plain = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), carried.alias("carried")
    )
    size = plain.agg(F.sum(F.octet_length("text")).alias("bytes"), F.count("*").alias("rows")).first()
    count = max(1, -(-max(size["bytes"] or 0, 1024 * size["rows"]) // block_bytes))
    shards = max(1, count // 2)
    kind = docs.schema[id_col].dataType.simpleString()
    # the id and the text say where a row goes, so a row is found again whenever a stage runs again
    blocks = plain.withColumn("block", F.pmod(F.xxhash64("doc_id", F.octet_length(F.coalesce("text", F.lit("")))), F.lit(count)))

    def dealt(number: int, own: np.ndarray) -> pa.Table:
        return shard_rows(number, shard_of(own, shards), lambda a, b: own[a:b].tobytes())

    def entries(key, table):
        own = anchors_of(Block(table))
        return dealt(key[0].as_py(), entries_of(own.hashes, own.around))

    def repeated_of(found: DataFrame) -> DataFrame:
        return found.repartition(width, "shard").mapInArrow(lambda rows: repeated_hashes(rows, hot_rows), "block long, data binary")

    found = blocks.groupBy("block").applyInArrow(entries, BLOCK_SCHEMA)
    width = max(int(spark.conf.get("spark.sql.shuffle.partitions")), shards)
    repeated = repeated_of(found)

    def hot_entries(key, table, replies):
        hot = replies_of(replies["data"])
        hot = hot[hot & ONE == ONE]
        own = anchors_of(Block(table)).hot_hashes(hot) if len(hot) else np.zeros(0, np.uint64)
        return dealt(table["block"][0].as_py() if len(own) else 0, entries_of(own, own))

    again = repeated_of(blocks.groupBy("block").cogroup(repeated.groupBy("block")).applyInArrow(hot_entries, BLOCK_SCHEMA))
    said = repeated.withColumn("of_class", F.lit(False)).unionAll(again.withColumn("of_class", F.lit(True)))

    def send(key, table, replies):
        if not table.num_rows or not replies.num_rows:
            return shard_rows(0, np.zeros(0, np.int64), bytes)
        number = table["block"][0].as_py()
        block = Block(table)
        own = anchors_of(block)
        sent = own.sent(*(replies_of(replies["data"].filter(kind)) for kind in (pc.invert(replies["of_class"]), replies["of_class"])))
        rows, spans = surroundings(block, own.units, own.starts, sent, SHARDS_PER_TASK * shards)
        # what is settled here travels with the rest, to a shard that hands it back
        rows.append((number % (SHARDS_PER_TASK * shards), b"S" + spans.tobytes()))
        return pa.table({
            "block": pa.array([number] * len(rows), pa.int64()), "shard": pa.array([r[0] for r in rows], pa.int64()),
            "data": pa.array([r[1] for r in rows], pa.binary()),
        })

    sent = blocks.groupBy("block").cogroup(said.groupBy("block")).applyInArrow(send, BLOCK_SCHEMA)

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, by_block = {}, {}
        for batch in batches:
            for number, shard, data in zip(*(batch[name].to_pylist() for name in ("block", "shard", "data"))):
                if data[:1] == b"S":
                    by_block.setdefault(number, []).append(np.frombuffer(data[1:], np.int64))
                else:
                    parts.setdefault(shard, []).append((number, data))
        for shard in list(parts):
            for number, spans in settle(parts.pop(shard)):
                by_block.setdefault(number, []).append(spans.ravel())
        if by_block:
            names = list(by_block)
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.int64()), pa.array([np.concatenate(by_block[k]).tobytes() for k in names], pa.binary())],
                ["block", "data"],
            )

    spans = sent.repartition(width, F.pmod("shard", F.lit(shards))).mapInArrow(decide, "block long, data binary")

    def finish(key, table, replies):
        own = Block(table)
        parts = [np.frombuffer(data, np.int64) for data in replies["data"].to_pylist()]
        covered = np.concatenate(parts).reshape(-1, 3) if parts else np.zeros((0, 3), np.int64)
        columns = remove(own, covered)
        rows = pa.array(own.rows)
        return pa.table({"doc_id": table["doc_id"].take(rows), **columns, "carried": table["carried"].take(rows)})

    names = StructType.fromDDL(schema)
    kinds = StructType([plain.schema["doc_id"], *names.fields, plain.schema["carried"]])
    result = blocks.groupBy("block").cogroup(spans.groupBy("block")).applyInArrow(finish, kinds)
    result = result.select(F.col("doc_id").cast(kind).alias(id_col), *names.names, "carried")
    return result.select(id_col, *names.names, *[F.col("carried")[name].alias(name) for name in carry or []])


def covered_flags(lengths: np.ndarray, spans: np.ndarray) -> np.ndarray:
    """For documents of so many units laid end to end, whether each unit lies in a span."""
    starts = np.concatenate(([0], np.cumsum(lengths)))
    change = np.zeros(int(starts[-1]) + 1, np.int32)
    np.add.at(change, starts[spans[:, 0]] + spans[:, 1], 1)
    np.add.at(change, starts[spans[:, 0]] + spans[:, 2], -1)
    return np.cumsum(change[:-1]) > 0


def merged(spans: np.ndarray) -> np.ndarray:
    """The same cover by spans that neither overlap nor touch."""
    if not len(spans):
        return spans.reshape(-1, 3)
    spans = spans[np.lexsort((spans[:, 1], spans[:, 0]))]
    # ends only grow within a document once they are counted over all before
    lift = spans[:, 0] * (int(spans[:, 2].max()) + 2)
    ends = np.maximum.accumulate(spans[:, 2] + lift)
    fresh = np.concatenate(([True], spans[1:, 1] + lift[1:] > ends[:-1]))
    first = np.flatnonzero(fresh)
    last = np.concatenate((first[1:], [len(spans)])) - 1
    return np.stack((spans[first, 0], spans[first, 1], ends[last] - lift[last]), axis=1)
