"""The trie of shared conversation prefixes, from sorted sequences and their common prefixes.

Conversations are cut into segments of ``STEP`` turns; a segment carries a 128-bit name of
all turns before it, so segments of all lengths of conversations can be sorted together and
a conversation of any length is many small rows. Neighbours in sorted order give the
common-prefix lengths (LCPs). In each block of sorted rows a sparse table answers range
minima over the LCPs, and every candidate prefix finds its left and its right extent by
binary search in it, on its own. The rows between are its members; sums over them come from
running sums. Parts of a prefix that lies in several blocks are added up by its name.

A turn stands for itself by the SHA-256 of its text and its role; a prefix by 128 bits made from these.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from feedstat.llm.vectors import dense
from feedstat.session import materialize

#: Turns of a segment, rows of a block, and places of a conversation that are added up at a time.
STEP, BLOCK_ROWS, SLICE = 8, 1 << 16, 1 << 13
#: The common prefix with a row of another block, before it is known.
UNKNOWN = -2
NODE = ["depth", "id1", "id2"]


def running(
    rows: DataFrame, group: str, part: str, part_order: Column, order: list[Column],
    totals: dict[str, tuple[Column, Callable[[Column], Column]]],
) -> DataFrame:
    """Adds to each row what the rows before it in its ``group`` sum up to; ``rows`` is read twice.

    ``totals`` gives for each new column what is added and how (``F.sum`` or ``F.bit_xor``).
    A group is summed part by part, so a frequent one is never sorted in one task.
    """
    within = Window.partitionBy(group, part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy(group).orderBy(part_order).rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.groupBy(group, part).agg(*[add(value).alias(f"_{name}") for name, (value, add) in totals.items()])
    parts = parts.select(group, part, *[add(f"_{name}").over(earlier).alias(f"_{name}") for name, (_, add) in totals.items()])
    parts = materialize(parts.where(F.coalesce(*[f"_{name}" for name in totals]).isNotNull()), "trie-parts")
    zero = F.lit(0).cast("long")
    own = rows.withColumns({name: F.coalesce(add(value).over(within), zero) for name, (value, add) in totals.items()})
    joined = own.join(parts, [group, part], "left")
    for name, (_, add) in totals.items():
        before = F.coalesce(f"_{name}", zero)
        joined = joined.withColumn(name, F.col(name) + before if add is F.sum else F.col(name).bitwiseXOR(before))
    return joined.drop(*[f"_{name}" for name in totals])


def numbered(
    rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
) -> DataFrame:
    """``conv``, ``pos`` (from 0), ``role``, ``digest`` and ``bytes`` of each turn, in its conversation's order.

    Turns go by ``turn_col``, null first; equal ones by role and then by the SHA-256 of their
    text, so repeated rows are turns of their own. A null role or text is empty. Rows without
    a conversation are no turns. Other columns are not read.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    turns = rows.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.unhex(F.sha2(text, 256)).alias("digest"),
        F.octet_length(text).cast("long").alias("bytes"),
    )
    sliced = materialize(
        turns.repartitionByRange("conv", "turn", "role", "digest").withColumn("slice", F.spark_partition_id()), "trie-turns"
    )
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")]
    one = F.lit(1).cast("long")
    return running(sliced, "conv", "slice", F.col("slice"), order, {"pos": (one, F.sum)}).select(
        "conv", "pos", "role", "digest", "bytes"
    )


def common(one: Column, other: Column) -> Column:
    """How many turns two segments share; -1 where what is before them differs."""
    same = F.filter(
        F.sequence(F.lit(1), F.lit(STEP)),
        lambda k: (F.size(one.turns) >= k) & (F.slice(one.turns, 1, k) == F.slice(other.turns, 1, k)),
    )
    together = (one.j == other.j) & (one.p1 == other.p1) & (one.p2 == other.p2)
    return F.when(together, F.size(same)).otherwise(-1)


def layers(turns: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Turns per row, and a matrix of ``STEP`` columns for each field."""
    if isinstance(turns, pa.ChunkedArray):
        turns = turns.combine_chunks()
    flat, offsets = turns.flatten(), turns.offsets
    offsets = pc.subtract(offsets, offsets[0])
    fields = {
        name: dense(pa.ListArray.from_arrays(offsets, pc.struct_field(flat, name)), STEP) for name in ("t1", "t2", "bytes")
    }
    return np.diff(offsets.to_numpy()), fields


def neighbours(table: pa.Table) -> np.ndarray:
    """The common prefix of each row with the one before it, from the second row on."""
    size, field = layers(table["turns"])
    both = np.minimum(size[1:], size[:-1])[:, None]
    same = np.arange(STEP) < both
    for name in ("t1", "t2"):
        same &= field[name][1:] == field[name][:-1]
    shared = np.cumprod(same, axis=1).sum(1)
    for name in ("j", "p1", "p2"):
        key = table[name].to_numpy()
        shared[key[1:] != key[:-1]] = -1
    return shared.astype(np.int32)


def adjacent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows with ``block``, ``place``, ``lcp`` and ``next_lcp``: what they share with the row before and after."""
    block, place, held, lcp_of_held = TaskContext.get().partitionId(), 0, None, UNKNOWN

    def out(table: pa.Table, lcp, next_lcp) -> list[pa.RecordBatch]:
        count = table.num_rows
        table = table.append_column("block", pa.array(np.full(count, block, np.int32)))
        table = table.append_column("place", pa.array(np.arange(place, place + count)))
        table = table.append_column("lcp", pa.array(lcp, pa.int32()))
        return table.append_column("next_lcp", pa.array(next_lcp, pa.int32())).combine_chunks().to_batches()

    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table])
        between = neighbours(table)
        lcp = np.concatenate(([lcp_of_held], between))
        last = table.num_rows - 1
        yield from out(table.slice(0, last), lcp[:-1], between)
        held, lcp_of_held, place = table.slice(last), int(lcp[-1]), place + last
    if held is not None:
        yield from out(held, [lcp_of_held], [UNKNOWN])


class RangeMinimum:
    """Minima of all runs of ``values`` whose length is a power of two."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        while 2 << (len(self.levels) - 1) <= len(values):
            half, last = 1 << (len(self.levels) - 1), self.levels[-1]
            self.levels.append(np.minimum(last[:-half], last[half:]))

    def least(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Minimum of ``values[start:stop]`` for each pair, from two runs that cover it."""
        level = np.frexp(stop - start)[1] - 1
        out = np.empty(len(start), self.levels[0].dtype)
        for k in np.unique(level).tolist():
            own = level == k
            run = self.levels[k]
            out[own] = np.minimum(run[start[own]], run[stop[own] - (1 << k)])
        return out

    def left(self, at: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """First row of the rows around ``at`` that share ``depth`` turns: binary search to the left."""
        place = at.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            start = place - (1 << k)
            can = start >= 0
            can &= self.levels[k][np.where(can, start + 1, 0)] >= depth
            place = np.where(can, start, place)
        return place

    def right(self, at: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The row behind the last one that shares ``depth`` turns with ``at``: binary search to the right."""
        place, count = at.copy(), len(self.levels[0])
        for k in range(len(self.levels) - 1, -1, -1):
            stop = place + (1 << k)
            can = stop < count
            can &= self.levels[k][np.where(can, place + 1, 0)] >= depth
            place = np.where(can, stop, place)
        return place + 1


def block_nodes(table: pa.Table) -> pa.Table:
    """What the rows of one block add to each prefix they start with.

    A prefix that goes on from an earlier block is one more candidate here; its sums are
    those of the rows in this block only.
    """
    table = table.sort_by("place")
    size, field = layers(table["turns"])
    j, conv, lcp = (table[name].to_numpy() for name in ("j", "conv", "lcp"))
    last, shared = table["last"].to_numpy(), table["shared"].to_numpy()
    depths = np.arange(STEP + 1)
    near = lcp.copy()
    near[0] = -1  # what stands before this block is not here
    at, depth = np.nonzero((depths > near[:, None]) & (depths <= size[:, None]))
    minima = RangeMinimum(near)
    left, right = minima.left(at, depth), minima.right(at, depth)

    def total(values: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
        return sums[right] - sums[left]

    def total_at_depth(flags: np.ndarray) -> np.ndarray:
        sums = np.vstack([np.zeros((1, STEP + 1), np.int64), np.cumsum(flags, axis=0, dtype=np.int64)])
        return sums[right, depth] - sums[left, depth]

    own = (depth > 0) | (j[at] == 0)  # a segment's empty prefix is a node of the segment before
    begun = total_at_depth((lcp[:, None] <= depths) & (size[:, None] > depths))
    ended = total_at_depth((size[:, None] == depths) & last[:, None])
    bytes_to = np.hstack([np.zeros((len(size), 1), np.int64), np.cumsum(field["bytes"], axis=1)])
    above = bytes_to[at, np.maximum(depth - 1, 0)]
    # each row adds the turns it shares with the row before, from this depth on, and those of its later segments
    saved = total(table["later_saved"].to_numpy() + shared) - (right - left) * above
    saved -= np.where(lcp[left] < depth, shared[left] - above, 0)
    names = {}
    for name, before in (("t1", "p1"), ("t2", "p2")):
        start = table[before].to_numpy()[:, None]
        names[name] = np.hstack([start, start ^ np.bitwise_xor.accumulate(field[name], axis=1)])
    up = np.maximum(depth - 1, 0)
    top = pa.array(depth == 0)
    ends = [
        ",".join(map(str, conv[a : a + m].tolist())) if m else None for a, m in zip(left.tolist(), ended.tolist())
    ]
    return pa.table({
        "depth": j[at] * STEP + depth, "id1": names["t1"][at, depth], "id2": names["t2"][at, depth],
        "up1": pc.if_else(top, pa.scalar(None, pa.int64()), pa.array(names["t1"][at, up])),
        "up2": pc.if_else(top, pa.scalar(None, pa.int64()), pa.array(names["t2"][at, up])),
        "conv": RangeMinimum(conv).least(left, right), "n": np.where(own, right - left, 0), "children": begun,
        "leaves": np.where(own, total(table["leaf"].to_numpy() + table["later_leaves"].to_numpy()), 0),
        "saved": np.where(own, saved, 0), "first": conv[left], "ends": pa.array(ends, pa.string()),
    })


def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the joined pieces of each node; rows come sorted by node and place, and one piece is held at a time."""
    node, state = None, None

    def out():
        return pa.RecordBatch.from_arrays(
            [*[pa.array([v], t) for v, t in zip(node, (pa.int64(),) * 3)], pa.array([state.hexdigest()])], [*NODE, "ends_sha256"]
        )

    for batch in batches:
        done = []
        for *key, piece in zip(*[batch[name].to_pylist() for name in (*NODE, "ends")]):
            if key == node:
                state.update(b"," + piece.encode())
                continue
            if node is not None:
                done.append(out())
            node, state = key, hashlib.sha256(piece.encode())
        if done:
            yield from pa.Table.from_batches(done).combine_chunks().to_batches()
    if node is not None:
        yield out()


def prefix_nodes(turns: DataFrame, members: DataFrame) -> DataFrame:
    """One row per distinct prefix: the root, and each distinct sequence of first turns.

    ``turns`` has ``conv`` (long), ``pos`` (from 0, gapless), ``role``, ``digest`` and ``bytes``;
    ``members`` a row per conversation, with those that have no turn. ``turns`` is read twice, so
    it should be a written table. Gives ``conv_id``, ``depth``, ``parent_conv_id``, ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_tokens`` and ``ends_sha256``. No members give no rows.

    The ids of all conversations that end at one node are hashed in one task, since SHA-256
    goes through them in order; it holds one block's ids at a time.
    """
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    lengths = turns.select("conv", one.alias("n")).unionByName(members.select("conv", none.alias("n")))
    lengths = lengths.groupBy("conv").agg(F.sum("n").alias("pos"))
    marked = turns.select(
        "conv", "pos", F.xxhash64("pos", "role", "digest").alias("t1"), F.xxhash64(F.lit("2"), "pos", "role", "digest").alias("t2"),
        "bytes", F.lit(False).alias("last"),
    ).unionByName(
        # the end of each conversation, so that its last segment has fewer than STEP turns
        lengths.select("conv", "pos", *[F.lit(None).cast("long").alias(name) for name in ("t1", "t2", "bytes")], F.lit(True).alias("last"))
    )
    turn = F.when(~F.col("last"), F.struct("pos", "t1", "t2", "bytes"))
    segments = materialize(
        marked.groupBy("conv", F.expr(f"pos div {STEP}").alias("j")).agg(
            F.sort_array(F.collect_list(turn)).alias("turns"), F.max("last").alias("last"),
            *[F.coalesce(F.bit_xor(name), none).alias(f"x{name[1]}") for name in ("t1", "t2")],
        ).withColumn("part", F.expr(f"j div {SLICE}")),
        "trie-segments",
    )
    named = running(
        segments, "conv", "part", F.col("part"), [F.col("j")], {"p1": (F.col("x1"), F.bit_xor), "p2": (F.col("x2"), F.bit_xor)}
    ).select("j", "p1", "p2", "turns", "conv", "last", "part")
    key = ["j", "p1", "p2", "turns", "conv"]
    ordered = named.repartitionByRange(*key).sortWithinPartitions(*key)
    fields = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in ordered.schema.fields)
    ordered = materialize(
        ordered.mapInArrow(adjacent, f"{fields}, block int, place long, lcp int, next_lcp int"), "trie-ordered"
    )
    # two rows of each block at most
    seam = Window.orderBy("block", "place")
    own = F.struct("j", "p1", "p2", "turns")
    edges = ordered.where(f"lcp = {UNKNOWN} OR next_lcp = {UNKNOWN}").select(
        "block", "place", "lcp", "next_lcp", own.alias("own"), F.lag(own).over(seam).alias("one"), F.lead(own).over(seam).alias("other"),
    )
    sides = (("lcp", "one"), ("next_lcp", "other"))
    edges = materialize(edges.select("block", "place", *[
        F.when(F.col(name) == UNKNOWN, F.coalesce(common(F.col("own"), F.col(side)), F.lit(-1))).otherwise(F.col(name)).alias(f"_{name}")
        for name, side in sides
    ]), "trie-edges")
    linked = ordered.join(edges, ["block", "place"], "left")
    linked = linked.withColumns({name: F.coalesce(f"_{name}", name) for name, _ in sides}).drop("_lcp", "_next_lcp")
    linked = linked.withColumns({
        "shared": F.aggregate(F.slice("turns", F.lit(1), F.greatest("lcp", F.lit(0))), none, lambda a, t: a + t.bytes),
        "leaf": (F.col("last") & (F.col("next_lcp") < F.size("turns"))).cast("long"),
    })
    whole = running(
        linked, "conv", "part", F.desc("part"), [F.desc("j")],
        {"later_saved": (F.col("shared"), F.sum), "later_leaves": (F.col("leaf"), F.sum)},
    )
    whole = whole.withColumn("slab", F.expr(f"place div {BLOCK_ROWS}")).drop("part", "next_lcp")
    parts = materialize(
        whole.groupBy("block", "slab").applyInArrow(
            block_nodes,
            "depth long, id1 long, id2 long, up1 long, up2 long, conv long, n long, children long, leaves long, saved long, "
            "first long, ends string",
        ),
        "trie-nodes",
    )
    nodes = parts.groupBy(*NODE).agg(
        F.min("conv").alias("conv_id"), F.sum("n").alias("n_convs"), F.sum("children").alias("n_children"),
        F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"), F.max("up1").alias("up1"), F.max("up2").alias("up2"),
    )
    ends = parts.where("ends IS NOT NULL").select(*NODE, "first", "ends").repartition(*NODE).sortWithinPartitions(*NODE, "first")
    ends = ends.mapInArrow(digests, "depth long, id1 long, id2 long, ends_sha256 string")
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    nodes = materialize(
        nodes.join(ends, NODE, "left").withColumn("ends_sha256", F.coalesce("ends_sha256", empty)), "trie-whole"
    )
    parents = nodes.select(
        (F.col("depth") + 1).alias("depth"), F.col("id1").alias("up1"), F.col("id2").alias("up2"),
        F.col("conv_id").alias("parent_conv_id"),
    )
    return nodes.join(parents, ["depth", "up1", "up2"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    )


def conversation_trie(rows: DataFrame, **columns: str) -> DataFrame:
    """The prefix trie of a table of turns; see ``numbered`` for odd rows and ``prefix_nodes`` for the columns."""
    turns = materialize(numbered(rows, **columns), "trie-numbered")
    return prefix_nodes(turns, turns.select("conv").distinct())


def grafted(turns: DataFrame, every: int = 5, most: int = 8) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with turns of others, and a row per conversation.

    Conversation c starts with the first h turns of conversation ``c - c % every`` (all if
    fewer, none if absent), then come its own turns after its first h; h is the unsigned CRC-32
    of c's decimals modulo ``most + 1``.
    """
    lengths = materialize(turns.groupBy("conv").agg(F.count("*").alias("n")), "trie-lengths")
    heads = F.crc32(F.col("conv").cast("string").cast("binary")) % (most + 1)
    bases = lengths.select(F.col("conv").alias("base"), F.col("n").alias("base_n"))
    plan = lengths.select("conv", (F.col("conv") - F.col("conv") % every).alias("base"), heads.alias("h"))
    plan = plan.join(bases, "base", "left").select(
        "conv", "base", "h", F.least("h", F.coalesce("base_n", F.lit(0))).alias("taken")
    )
    plan = materialize(plan, "trie-grafts")
    first = turns.where(F.col("pos") < most).withColumnRenamed("conv", "base")
    taken = first.join(plan.where("taken > 0"), "base").where("pos < taken").select("conv", "pos", "role", "digest", "bytes")
    kept = turns.join(plan, "conv").where("pos >= h").select(
        "conv", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "role", "digest", "bytes"
    )
    return materialize(taken.unionByName(kept), "trie-grafted"), plan.select("conv")


def op11_prefix_trie(spark, sf_dir: str) -> DataFrame:
    """The prefix trie of the rebuilt ``conversations``."""
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return prefix_nodes(*grafted(materialize(numbered(rows), "trie-numbered")))


QUERIES = {"op11_prefix_trie": op11_prefix_trie}

#: CRC-32 of the decimals of conv_id: bytes one by one, each in eight steps with the fixed polynomial.
ORACLES = {
    "op11_prefix_trie": """
        WITH own AS (
            SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, turn FROM conversations
            WHERE conv_id IS NOT NULL
        ), turns AS (
            SELECT conv_id, strlen(text) AS bytes, sha256(role) || sha256(text) AS mark,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) - 1 AS pos
            FROM own
        ), convs AS (
            SELECT conv_id, conv_id - conv_id % 5 AS base,
                   xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda s: ascii(s)::UBIGINT)),
                       lambda crc, b: list_reduce(list_prepend(xor(crc, b), list_transform(range(8), lambda i: i::UBIGINT)),
                           lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384::UBIGINT) ELSE x >> 1 END)),
                       4294967295::UBIGINT) % 9 AS h
            FROM (SELECT DISTINCT conv_id FROM own)
        ), rebuilt AS (
            SELECT c.conv_id, t.pos, t.mark, t.bytes FROM convs c JOIN turns t ON t.conv_id = c.base AND t.pos < c.h
            UNION ALL
            SELECT c.conv_id, 8 + t.pos, t.mark, t.bytes FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.pos >= c.h
        ), prefixes AS (
            SELECT conv_id, row_number() OVER own AS depth, bytes, string_agg(mark, '') OVER own AS name,
                   coalesce(string_agg(mark, '') OVER (PARTITION BY conv_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS parent,
                   row_number() OVER own = count(*) OVER (PARTITION BY conv_id) AS ends
            FROM rebuilt WINDOW own AS (PARTITION BY conv_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
            UNION ALL
            SELECT conv_id, 0, 0, '', NULL, conv_id NOT IN (SELECT conv_id FROM rebuilt) FROM convs
        ), nodes AS (
            SELECT name, any_value(parent) AS parent, any_value(depth) AS depth, any_value(bytes) AS bytes,
                   min(conv_id) AS conv_id, count(*) AS n_convs,
                   sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
            FROM prefixes GROUP BY name
        ), counted AS (
            SELECT n.*, (SELECT count(*) FROM nodes c WHERE c.parent = n.name) AS n_children FROM nodes n
        ), subtrees AS (
            SELECT a.name, sum((d.n_convs - 1) * d.bytes)::BIGINT AS saved_tokens,
                   (count(*) FILTER (WHERE d.n_children = 0))::BIGINT AS n_leaves
            FROM counted d JOIN counted a ON left(d.name, length(a.name)) = a.name AND a.depth <= d.depth GROUP BY a.name
        )
        SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs::BIGINT AS n_convs,
               n.n_children::BIGINT AS n_children, s.n_leaves, s.saved_tokens, n.ends_sha256
        FROM counted n JOIN subtrees s ON s.name = n.name LEFT JOIN nodes p ON p.name = n.parent""",
}
