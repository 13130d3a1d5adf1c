"""N-gram Jaccard self-join by chosen paths.

Texts become sets of word n-grams; equal sets are one representative. In each run the
representatives are split again and again: a bucket samples a position or two of the minhash
signature (1 / threshold on average) and sends its members on by the value they have there,
which is the n-gram they share if they agree. Small buckets are compared pair by pair; one
that never gets small, a large group of near copies, is compared in blocks. Runs repeat until
a pair at the threshold is found with the target recall.

Pairs are never written. A pair belongs to one of the buckets that hold both its members, the
least by name, and is counted there; a bucket returns a row per member: its number of links
and the least member it is connected with. Links therefore cost as many rows as there are
members, however many pairs a group has.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from feedstat.llm.arrays import CHUNK, mixed, starts_of, text_batches, window_hashes
from feedstat.session import materialize, small_batches

WORDS = 5
THRESHOLD = 0.8
RECALL = 0.9995
POSITIONS = 64
#: Members a bucket may have to be compared at once, and the most levels of splitting.
BUCKET, LEVELS = 512, 3
#: Pairs whose signatures agree in fewer positions are not compared: so many standard deviations under the threshold.
FLOOR_DEVIATIONS = 5
#: Bytes of text made into sets at a time, and cells of a matrix of members and n-grams.
BATCH_BYTES, CELLS = 1 << 20, 2 << 20
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word of all texts (cut at ``[\\x20\\x09-\\x0D]+``), and words per text."""
    data = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
    ends = np.cumsum([len(text) + 1 for text in texts])
    inside = ~SPACE[data]
    begins = np.flatnonzero(inside & np.concatenate(([True], ~inside[:-1]))) if len(data) else np.zeros(0, np.int64)
    stops = np.flatnonzero(inside & np.concatenate((~inside[1:], [True]))) + 1 if len(data) else begins
    hashes = np.empty(len(begins), np.uint64)
    # words that start in the same bytes are hashed together: a byte takes some 50 bytes of memory meanwhile
    edges = np.unique(np.append(np.searchsorted(begins, np.arange(0, len(data), CHUNK)), len(begins)))
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        lengths = stops[a:b] - begins[a:b]
        at = np.flatnonzero(inside[begins[a] : stops[b - 1]]) + begins[a]
        place = (at - np.repeat(begins[a:b], lengths)).astype(np.uint64)
        marks = mixed(data[at].astype(np.uint64) + np.uint64(1) + place * np.uint64(257))
        hashes[a:b] = np.add.reduceat(marks, starts_of(lengths)[:-1])
    hashes = mixed(hashes)
    first = np.searchsorted(begins, np.concatenate(([0], ends[:-1])) if len(texts) else [])
    counts = np.diff(np.concatenate((first, [len(begins)])))
    return hashes, counts.astype(np.int64)


def ngram_sets(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-gram hashes of each text in order, joined, and where each text's start.

    A text with fewer words than ``width`` has one n-gram, all its words; one without words none.
    """
    hashes, counts = word_hashes(texts)
    starts = starts_of(counts)
    grams = mixed(window_hashes(hashes, width))
    number = np.where(counts >= width, counts - width + 1, 0)
    owner = np.repeat(np.arange(len(texts)), number)
    own = grams[np.arange(len(owner)) - np.repeat(starts_of(number)[:-1] - starts[:-1], number)] if len(owner) else grams[:0]
    short = np.flatnonzero((counts > 0) & (counts < width))
    if len(short):
        whole = [int(mixed(window_hashes(hashes[starts[k] : starts[k + 1]], int(counts[k])) + np.uint64(counts[k]))[0]) for k in short]
        owner, own = np.concatenate((owner, short)), np.concatenate((own, np.array(whole, np.uint64)))
    order = np.lexsort((own, owner))
    owner, own = owner[order], own[order]
    fresh = np.ones(len(own), bool)
    fresh[1:] = (own[1:] != own[:-1]) | (owner[1:] != owner[:-1])
    return own[fresh], starts_of(np.bincount(owner[fresh], minlength=len(texts)))


def set_keys(flat: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that stand for each set; 0 for the empty set."""
    total = [np.concatenate(([np.uint64(0)], np.cumsum(mixed(flat ^ np.uint64(seed))))) for seed in (0x51, 0xA7)]
    return tuple((part[starts[1:]] - part[starts[:-1]]).view(np.int64) for part in total)


def signatures(flat: np.ndarray, starts: np.ndarray, positions: int = POSITIONS) -> np.ndarray:
    """Minhash signature of each set, 32 bits per position; all 0 for the empty set."""
    factors = mixed(np.arange(1, positions + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    result = np.zeros((len(starts) - 1, positions), np.int32)
    full = np.flatnonzero(starts[1:] > starts[:-1])
    for k, factor in enumerate(factors if len(full) else []):
        values = ((flat * factor) >> np.uint64(32)).astype(np.uint32)
        result[full, k] = np.minimum.reduceat(values, starts[:-1][full]).view(np.int32)
    return result


def runs_needed(threshold: float, recall: float, levels: int) -> int:
    """Runs after which a pair of similarity ``threshold`` has met at the last level with probability ``recall``.

    Signatures agree in fewer positions than the similarity by chance; two standard deviations are allowed for.
    """
    more = min(1.0, 1 / threshold - 1)
    agree = threshold - 2 * math.sqrt(threshold * (1 - threshold) / POSITIONS)
    chance = 1.0
    for _ in range(levels):
        chance = (1 - more) * agree * chance + more * (1 - (1 - agree * chance) ** 2)
    return math.ceil(math.log(1 - recall) / math.log(1 - chance))


def signature_floor(threshold: float) -> float:
    """The share of positions in which the signatures of a pair to be compared agree at least."""
    return threshold - FLOOR_DEVIATIONS * math.sqrt(threshold * (1 - threshold) / POSITIONS)


def with_sets(docs: DataFrame, width: int) -> DataFrame:
    """``docs`` (``doc_id``, ``mark``, ``text``) as ``doc_id``, ``mark``, ``key_a``, ``key_b``, ``size``, ``signature``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in text_batches(batches, "text", BATCH_BYTES):
            texts = [(text or "").encode() for text in table["text"].to_pylist()]
            flat, starts = ngram_sets(texts, width)
            keys = set_keys(flat, starts)
            own = signatures(flat, starts)
            signature = pa.FixedSizeListArray.from_arrays(pa.array(own.ravel()), POSITIONS).cast(pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [table["doc_id"].combine_chunks(), table["mark"].combine_chunks(), pa.array(keys[0]), pa.array(keys[1]),
                 pa.array(np.diff(starts).astype(np.int32)), signature],
                ["doc_id", "mark", "key_a", "key_b", "size", "signature"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "mark", "text").mapInArrow(
        run, f"doc_id {kind}, mark long, key_a long, key_b long, size int, signature array<int>"
    )


def split(members: DataFrame, level: int, threshold: float) -> DataFrame:
    """One level of splitting: ``bucket``, ``rep`` and ``signature`` become the sub-buckets' rows.

    Which positions a bucket samples depends on its name only, so all members agree.
    """
    chance = F.pmod(F.xxhash64("bucket", F.lit(level), F.lit("more")), F.lit(1000))
    branches = F.when(chance < round(1000 * (1 / threshold - 1)), F.sequence(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    at = F.pmod(F.xxhash64("bucket", F.lit(level)) + F.col("branch") * 31, F.lit(POSITIONS)).cast("int")
    value = F.get(F.col("signature"), at)
    return members.select("bucket", "rep", "signature", F.explode(branches).alias("branch")).select(
        F.xxhash64("bucket", F.lit(level), at, value).alias("bucket"), "rep"
    )


def chosen_paths(reps: DataFrame, threshold: float, recall: float, bucket: int, levels: int) -> DataFrame:
    """The buckets to compare: ``bucket``, ``rep``, ``size`` (members of the bucket, 2 or more)."""
    runs = runs_needed(threshold, recall, levels)
    roots = F.explode(F.array(*[F.lit(run).cast("long") for run in range(runs)])).alias("bucket")
    waiting = reps.select("rep", "signature", roots)
    finished = None
    for level in range(1, levels + 1):
        members = materialize(split(waiting, level, threshold), "path-members")
        sizes = members.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
        sizes = materialize(sizes, "path-sizes")
        members = materialize(members.join(sizes, "bucket"), "path-buckets")
        small = members if level == levels else members.where(F.col("size") <= bucket)
        finished = small if finished is None else finished.unionByName(small)
        large = members.where(F.col("size") > bucket)
        if level == levels or large.isEmpty():
            break
        waiting = large.select("bucket", "rep").join(reps.select("rep", "signature"), "rep")
    return finished


def in_blocks(buckets: DataFrame, bucket: int) -> DataFrame:
    """``buckets`` with ``task`` and ``side``: a large bucket is compared block against block.

    A bucket of n blocks has a task for each pair of blocks; a member goes to the n tasks of
    its block. In a task of two blocks only pairs across are compared.
    """
    blocks = F.ceil(F.col("size") / F.lit(bucket)).cast("int")
    own = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    dealt = buckets.withColumn("blocks", blocks).withColumn("own", own).select("bucket", "rep", "own", other)
    low, high = F.least("own", "other"), F.greatest("own", "other")
    return dealt.select(
        "bucket", "rep",
        F.xxhash64("bucket", low, high).alias("task"),
        F.when(F.col("own") == F.col("other"), 0).when(F.col("own") == low, 1).otherwise(2).alias("side"),
    )


def _tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each (bucket, task) of batches sorted by them, a table each."""
    held: list[pa.Table] = []
    last = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        bucket, task = table["bucket"].to_numpy(), table["task"].to_numpy()
        cuts = np.flatnonzero((bucket[1:] != bucket[:-1]) | (task[1:] != task[:-1])) + 1
        edges = [0, *cuts.tolist(), table.num_rows]
        for begin, end in zip(edges[:-1], edges[1:]):
            if begin == end:
                continue
            name = bucket[begin], task[begin]
            if held and name != last:
                yield pa.concat_tables(held)
                held = []
            last = name
            held.append(table.slice(begin, end - begin))
    if held:
        yield pa.concat_tables(held)


def candidate_pairs(table: pa.Table, floor: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a task's rows that belong to its bucket and whose signatures agree in a share of ``floor`` or more."""
    side, rep = table["side"].to_numpy(), table["rep"].to_numpy()
    if (side == 0).all():
        left, right = np.triu_indices(len(side), 1)
    else:
        left, right = (grid.ravel() for grid in np.meshgrid(np.flatnonzero(side == 1), np.flatnonzero(side == 2), indexing="ij"))
    if not len(left):
        return left, right
    own = table["signature"].combine_chunks().flatten().to_numpy().reshape(-1, POSITIONS)
    paths = table["paths"].combine_chunks()
    starts = paths.offsets.to_numpy()
    most = int(np.diff(starts).max())
    names = np.full((len(side), most), np.iinfo(np.int64).max)
    for k, (a, b) in enumerate(zip(starts[:-1], starts[1:])):
        names[k, : b - a] = paths.values.to_numpy()[a:b]
    bucket = table["bucket"][0].as_py()
    found = []
    step = max(1, (4 << 20) // (POSITIONS + most))
    for k in range(0, len(left), step):
        a, b = left[k : k + step], right[k : k + step]
        agree = np.zeros(len(a), np.int32)
        for position in range(POSITIONS):
            agree += own[a, position] == own[b, position]
        keep = np.flatnonzero((agree >= floor * POSITIONS) & (rep[a] != rep[b]))
        if len(keep):
            earlier = np.zeros(len(keep), bool)  # a bucket with a smaller name holds both
            for name in range(most):
                value = names[a[keep], name][:, None]
                earlier |= ((names[b[keep]] == value) & (value < bucket)).any(axis=1)
            keep = keep[~earlier]
        found.append(keep + k)
    chosen = np.concatenate(found)
    return left[chosen], right[chosen]


def needed_members(floor: float):
    """The members of each task that are in a candidate pair."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _tasks(batches):
            left, right = candidate_pairs(table, floor)
            if len(left):
                rows = pa.array(np.unique(np.concatenate((left, right))))
                yield from table.take(rows).combine_chunks().to_batches()
    return run


def intersections(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Common n-grams of each pair of sets."""
    if len(left) <= 4 * len(sets):
        return np.array([len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in zip(left, right)])
    number = np.unique(np.concatenate(sets), return_inverse=True)[1]
    owner = np.repeat(np.arange(len(sets)), [len(own) for own in sets])
    common = np.zeros((len(sets), len(sets)), np.float32)
    width = max(1, CELLS // len(sets))
    order = np.argsort(number, kind="stable")
    number, owner = number[order], owner[order]
    for begin in range(0, int(number[-1]) + 1, width):  # so many different n-grams at a time
        a, b = np.searchsorted(number, [begin, begin + width])
        part = np.zeros((len(sets), width), np.float32)
        part[owner[a:b], number[a:b] - begin] = 1
        common += part @ part.T
    return common[left, right].astype(np.int64)


def compare(threshold: float):
    """Links of each task: ``rep``, ``links`` (linked documents) and ``root`` (the least member connected here)."""
    floor = signature_floor(threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _tasks(batches):
            table = table.take(pa.array(np.unique(table["rep"].to_numpy(), return_index=True)[1]))
            left, right = candidate_pairs(table, floor)
            if not len(left):
                continue
            sets = [np.frombuffer(own, np.uint64) for own in table["grams"].to_pylist()]
            sizes = np.array([len(own) for own in sets])
            common = intersections(sets, left, right)
            linked = common >= threshold * (sizes[left] + sizes[right] - common) - 1e-9
            left, right = left[linked], right[linked]
            if not len(left):
                continue
            rep, copies = table["rep"].to_numpy(), table["copies"].to_numpy()
            links = np.bincount(left, copies[right], len(rep)) + np.bincount(right, copies[left], len(rep))
            root = rep.copy()
            while True:
                before = root.copy()
                low = np.minimum(root[left], root[right])
                np.minimum.at(root, left, low)
                np.minimum.at(root, right, low)
                if (root == before).all():
                    break
            rows = np.unique(np.concatenate((left, right)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(rep[rows]), pa.array(links[rows].astype(np.int64)), pa.array(root[rows])], ["rep", "links", "root"]
            )
    return run


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``label`` (the least node of its component) of the nodes of ``edges`` (``a``, ``b``).

    Each round takes the least label of a node's neighbours and then the label's own label;
    both sides of every join are written tables, so AQE can split a node with many edges.
    """
    both = materialize(
        edges.where("a <> b").unionByName(edges.where("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
        "component-edges",
    )
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select(
        "node", F.least("node", "low").alias("label")), "labels")
    while True:
        near = (
            both.join(labels.select(F.col("node").alias("b"), "label"), "b")
            .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        )
        met = materialize(
            labels.join(near, "node").select("node", F.col("label").alias("before"), F.least("label", "near").alias("label")), "labels-met"
        )
        jump = met.select(F.col("node").alias("label"), F.col("label").alias("further"))
        after = materialize(
            met.join(jump, "label", "left").select("node", "before", F.coalesce("further", "label").alias("label")), "labels"
        )
        if after.where("label <> before").isEmpty():
            return after.select("node", "label")
        labels = after.select("node", "label")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per row of ``docs``: its id, ``class_id`` and ``n_links``.

    Two rows are linked when the Jaccard similarity of their word ``width``-gram sets is
    ``threshold`` or more; words are runs of ``[^\\x20\\x09-\\x0D]``, unchanged. ``n_links`` counts
    the rows linked with a row, equal texts included; ``class_id`` is the least id of its
    connected component (null only if all its ids are). Null texts and texts without words are
    linked with nothing and are classes of their own. Rows with the same id are rows of their
    own. An empty table gives an empty result; other columns are not read. ``options`` are those
    of ``classes``.
    """
    return classes(docs, id_col, text_col, **options).drop("mark").withColumnRenamed("doc_id", id_col)


def classes(
    docs: DataFrame, id_col: str, text_col: str, width: int = WORDS, threshold: float = THRESHOLD,
    recall: float = RECALL, bucket: int = BUCKET, levels: int = LEVELS,
) -> DataFrame:
    """``doc_id``, ``mark`` (a hash of the text), ``class_id`` and ``n_links`` of each row."""
    plain = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(F.col(text_col)).alias("mark")
    )
    with small_batches(docs.sparkSession):
        sets = materialize(with_sets(plain, width), "ngram-sets")
    reps = materialize(
        sets.where("size > 0").groupBy("key_a", "key_b", "size", "signature").agg(
            F.count("*").alias("copies"), F.min(F.struct("doc_id", "mark")).alias("row"), F.min("doc_id").alias("least"),
        ).select(F.monotonically_increasing_id().alias("rep"), "*"),
        "ngram-reps",
    )
    buckets = materialize(chosen_paths(reps, threshold, recall, bucket, levels), "buckets")
    paths = materialize(buckets.groupBy("rep").agg(F.sort_array(F.collect_set("bucket")).alias("paths")), "paths")
    known = materialize(reps.join(paths, "rep").select("rep", "row", "copies", "signature", "paths"), "path-reps")
    members = in_blocks(buckets, bucket).join(known.drop("row"), "rep")
    members = members.select("bucket", "task", "side", "rep", "copies", "signature", "paths")
    dealt = members.repartition("bucket", "task").sortWithinPartitions("bucket", "task")
    needed = materialize(dealt.mapInArrow(needed_members(signature_floor(threshold)), members.schema), "needed-members")

    wanted = needed.select("rep").distinct().join(known.select("rep", "row"), "rep")
    wanted = materialize(wanted.select("rep", "row.doc_id", "row.mark"), "wanted-sets")
    texts = plain.join(
        wanted.select("rep", F.col("doc_id").alias("own_id"), F.col("mark").alias("own_mark")).hint("merge"),
        F.col("mark").eqNullSafe(F.col("own_mark")) & F.col("doc_id").eqNullSafe(F.col("own_id")),
    ).select("rep", "text")

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for table in text_batches(batches, "text", BATCH_BYTES):
            rep = table["rep"].to_numpy()  # rows with the same id and text come one after another
            fresh = np.concatenate(([rep[0] != last], rep[1:] != rep[:-1]))
            table, last = table.filter(pa.array(fresh)), rep[-1]
            flat, starts = ngram_sets([(text or "").encode() for text in table["text"].to_pylist()], width)
            own = [flat[a:b].tobytes() for a, b in zip(starts[:-1], starts[1:])]
            yield pa.RecordBatch.from_arrays([table["rep"].combine_chunks(), pa.array(own, pa.binary())], ["rep", "grams"])

    found = texts.mapInArrow(grams, "rep long, grams binary")
    ready = needed.join(found, "rep").repartition("bucket", "task").sortWithinPartitions("bucket", "task")
    with small_batches(docs.sparkSession):
        linked = materialize(ready.mapInArrow(compare(threshold), "rep long, links long, root long"), "links")

    links = linked.groupBy("rep").agg(F.sum("links").alias("links"))
    labels = components(linked.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    classed = reps.select("rep", "key_a", "key_b", "size", "copies", "least").join(links, "rep", "left")
    classed = classed.join(labels.select(F.col("node").alias("rep"), "label"), "rep", "left")
    classed = materialize(classed.withColumn("label", F.coalesce("label", "rep")), "classed")
    least = materialize(classed.groupBy("label").agg(F.min("least").alias("class_id")), "classes")
    named = materialize(
        classed.join(least, "label").select(
            "key_a", "key_b", "size", "class_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
        ),
        "named-reps",
    )
    result = sets.where("size > 0").join(named, ["key_a", "key_b", "size"]).select("doc_id", "mark", "class_id", "n_links")
    alone = sets.where("size = 0").select(
        "doc_id", "mark", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links")
    )
    return result.unionByName(alone)


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each class the row with the least id stays.

    Rows without words are classes of their own; rows with a null id stay where their class has
    no other id. Of rows with the same id and text one stays.
    """
    found = classes(docs, id_col, text_col, **options)
    kept = found.where(F.col("doc_id").eqNullSafe(F.col("class_id")))
    kept = materialize(kept.select("doc_id", "mark").distinct(), "kept-rows")
    # the columns go along in one, so that none of their names meets those of the join
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_mark"))
    same = F.col("id").eqNullSafe(F.col("doc_id")) & F.col("text_mark").eqNullSafe(F.col("mark"))
    rows = rows.join(kept, same, "left_semi").dropDuplicates(["id", "text_mark"])
    return rows.select(*[F.col("row").getField(name).alias(name) for name in docs.columns])


def op2_ngram_join(spark, sf_dir: str) -> DataFrame:
    """The class and the number of links of every document."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op2_ngram_join": op2_ngram_join}
