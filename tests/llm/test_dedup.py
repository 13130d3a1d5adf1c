"""The dedup operators against SQL, brute force and odd rows."""

import hashlib
import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from feedstat import session
from feedstat.llm import arrays, exact_dedup, line_dedup, ngram_join, packing, passages, substring_dedup, suffix_dedup
from feedstat.llm.arrays import anchors, window_hashes, window_minima
from feedstat.llm.fm_index import FMIndex
from oracle import connect, differences

KEEP = "Ten words that stand here as one passage for the test of spans and of windows, more than a hundred bytes long. "
ODD = [
    (0, None), (1, ""), (2, " \n\t "), (3, "one"), (4, "one"), (5, KEEP * 3), (6, "x" * 9000), (7, "x" * 9000 + "y"),
    (8, KEEP * 3), (9, "lead " + KEEP + "tail " + KEEP), (10, "a b c d e f g h"), (11, "a  b c\nd e f g h"),
    (12, "é" * 200 + KEEP), (12, "é" * 200 + KEEP), (None, KEEP), (None, None), (13, " ".join(f"w{k}" for k in range(4000))),
    (14, " ".join(f"w{k}" for k in range(20, 4000))), (15, "repeat me " * 500),
]


def frame(spark, rows):
    """Rows with more columns, some named as the operators name theirs."""
    own = [(k, text, "s", 1, "n", 2.0) for k, text in rows]
    return spark.createDataFrame(own, "doc_id long, text string, source string, block int, name string, kept double")


@pytest.fixture(scope="module")
def documents(spark, sf_dir):
    return [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]


@pytest.mark.parametrize("module, name", [(exact_dedup, "op4_exact_dedup"), (line_dedup, "op7_line_dedup")])
def test_native_queries_equal_sql(spark, sf_dir, module, name):
    df = module.QUERIES[name](spark, sf_dir)
    assert differences(df, connect(sf_dir), module.ORACLES[name]) == []
    assert "Python" not in df._jdf.queryExecution().toString() and "Arrow" not in df._jdf.queryExecution().toString()


def exact_expected(rows):
    groups = {}
    for k, text in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", text or ""), []).append(k)
    result = []
    for text, ids in groups.items():
        least = min((k for k in ids if k is not None), default=None)
        kept = [k == least for k in ids]
        while kept.count(True) > 1:
            kept[kept.index(True)] = False
        result += [(k, least, len(ids), own, hashlib.sha256(text.encode()).hexdigest()) for k, own in zip(ids, kept)]
    return Counter(result)


@pytest.mark.parametrize("block", [4096, 7])
def test_exact_groups_of_odd_rows(spark, block):
    result = exact_dedup.exact_groups(frame(spark, ODD), block_chars=block)
    assert Counter(map(tuple, result.collect())) == exact_expected(ODD)
    assert exact_dedup.exact_groups(frame(spark, ODD).limit(0)).count() == 0


def test_names_are_of_contents_not_of_hashes(spark):
    texts = [(k, text) for k, text in enumerate(["ab" * 9, "ba" * 9, "ab" * 9, "ab" * 8, "", "b", "ab" * 9 + "a"])]
    named = exact_dedup.name_texts(spark.createDataFrame(texts, "row long, text string"), 3).collect()
    name = {r.row: (r.level, r.name) for r in named}
    assert len(name) == 7 and name[0] == name[2] and len(set(name.values())) == 6


def test_a_key_of_two_blocks_gives_all_new_keys(spark, monkeypatch):
    """Keys of the first seeds stand for many blocks; the names still tell all contents apart."""
    own_key = exact_dedup.block_key

    def poor_key(block, seed):
        key = own_key(block, seed)
        return key if seed == 2 else F.struct((key["a"] % (2 + seed)).alias("a"), F.lit(0).cast("long").alias("b"))

    monkeypatch.setattr(exact_dedup, "block_key", poor_key)
    result = exact_dedup.exact_groups(frame(spark, ODD), block_chars=50)
    assert Counter(map(tuple, result.collect())) == exact_expected(ODD)


def test_blocks_are_cut_once_and_carry_no_text(spark):
    texts = ["", "é" * 9000, "a😀" * 9000, "😀\n\r\u2028x" * 3000, "ab" * 2048, "y" * 4097]
    frame = spark.createDataFrame(list(enumerate(texts)), "row long, text string")
    blocks = exact_dedup.text_blocks(frame)
    got = {(r.row, r.n, r.place): r.block for r in blocks.collect()}
    cuts = {k: [t[i : i + 4096] for i in range(0, len(t), 4096)] or [""] for k, t in enumerate(texts)}
    assert got == {(k, len(own), i): block for k, own in cuts.items() for i, block in enumerate(own)}
    kept = re.findall(r"Generate \w*explode\(.*\), \[([^\]]*)\]", blocks._jdf.queryExecution().executedPlan().toString())
    assert kept and not any("text#" in own for own in kept)


def test_lines_on_about_a_tenth_of_the_pages_of_each_source(spark):
    rows = [
        (1000 * share + k, f"source {share}", f"own {share} {k}" + ("\nall rights" if k < share else "") + ("\nrare" if k >= 96 else ""))
        for share in range(8, 13) for k in range(100)
    ]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = line_dedup.drop_boilerplate(docs).where("n_dropped > 0").groupBy("source").count().collect()
    assert {(r.source, r["count"]) for r in got} == {(f"source {share}", share) for share in range(8, 13)}
    kept = line_dedup.drop_boilerplate(docs)
    assert kept.where("kept_text LIKE '%all rights%'").count() == 0 and kept.where("kept_text LIKE '%rare%'").count() == 20


def test_lines_of_odd_rows(spark):
    pages = [(k, f"menu\nown line {k}\n\n menu") for k in range(8)] + [(8, None), (9, ""), (None, "menu"), (9, "")]
    result = line_dedup.drop_boilerplate(frame(spark, pages), ratio=0.3, min_pages=3)
    got = {(r.doc_id, r.kept_text, r.n_lines, r.n_dropped) for r in result.collect()}
    expected = {(k, f"own line {k}\n", 4, 2) for k in range(8)} | {(8, "", 1, 0), (9, "", 1, 0), (None, "menu", 1, 0)}
    assert got == expected and result.count() == len(pages)
    assert set(frame(spark, pages).columns) < set(result.columns)
    assert line_dedup.drop_boilerplate(frame(spark, pages).limit(0)).count() == 0


def near_expected(rows, threshold=0.8):
    sets = []
    for _, text in rows:
        words = (text or "").encode().split()
        sets.append(frozenset(tuple(words[k : k + 5]) for k in range(len(words) - 4)) if len(words) >= 5 else frozenset([tuple(words)] if words else []))
    group, links = list(range(len(rows))), [0] * len(rows)
    for a in range(len(rows)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common and common >= threshold * (len(sets[a]) + len(sets[b]) - common) - 1e-9:
                links[a] += 1
                links[b] += 1
                old, new = group[a], group[b]
                group = [new if g == old else g for g in group]
    least = {}
    for (k, _), g in zip(rows, group):
        least[g] = min((x for x in (least.get(g), k) if x is not None), default=None)
    return Counter((k, least[g], n) for (k, _), g, n in zip(rows, group, links))


def test_near_duplicates_of_documents(spark, sf_dir, documents):
    got = Counter(tuple(r)[:3] for r in ngram_join.op2_ngram_join(spark, sf_dir).collect())
    assert got == near_expected(documents)


def edited(own, words, edits):
    words = list(words)
    for _ in range(edits):
        words[own.randrange(len(words))] = f"new{own.random()}"
    return " ".join(words)


def test_near_duplicates_in_blocks(spark):
    """A group of near copies that no splitting makes small, and pairs on both sides of the threshold."""
    own = random.Random(5)
    base = [f"b{own.randint(0, 900)}" for _ in range(300)]
    rows = [(k, edited(own, base, own.choice([0, 1, 2, 6]))) for k in range(60)]
    rows += [(100 + k, " ".join(f"z{own.random()}" for _ in range(30))) for k in range(20)] + ODD
    result = ngram_join.near_duplicates(frame(spark, rows), bucket=8, recall=0.999999)
    expected = near_expected(rows)
    got = Counter(map(tuple, result.collect()))
    assert {x[:2] for x in got} == {x[:2] for x in expected}  # no class lacks a member
    lost = sum(x[2] * n for x, n in expected.items()) - sum(x[2] * n for x, n in got.items())
    assert 0 <= lost <= 0.002 * sum(x[2] * n for x, n in expected.items())
    assert ngram_join.near_duplicates(frame(spark, rows).limit(0)).count() == 0


def test_one_of_each(spark):
    kept = ngram_join.one_of_each(frame(spark, ODD)).select("doc_id").collect()
    assert Counter(r.doc_id for r in kept) == Counter(k for k, least, _ in near_expected(ODD) if k == least)


def repeats_expected(rows):
    """Bytes covered by 100-byte strings that start earlier, by looking at all of them."""
    ordered = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, len((rows[i][1] or "").encode()), (rows[i][1] or "").encode()))
    seen, result = set(), []
    for i in ordered:
        data = (rows[i][1] or "").encode()
        gone = np.zeros(len(data), bool)
        for k in range(len(data) - 99):
            own = data[k : k + 100]
            if own in seen:
                gone[k : k + 100] = True
            seen.add(own)
        spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        kept = bytes(np.frombuffer(data, np.uint8)[~gone])
        result.append((rows[i][0], len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return Counter(result)


def passages_expected(rows):
    first, result = {}, []
    ordered = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    key = lambda k: float("inf") if k is None else k
    for k, text in ordered:
        words = (text or "").encode().split()
        for i in range(len(words) - 12):
            first.setdefault(tuple(words[i : i + 13]), key(k))
    for k, text in ordered:
        words = (text or "").encode().split()
        gone = [False] * len(words)
        for i in range(len(words) - 12):
            if first[tuple(words[i : i + 13])] < key(k):
                gone[i : i + 13] = [True] * 13
        kept = b" ".join(word for word, out in zip(words, gone) if not out)
        result.append((k, len(words), sum(gone), hashlib.sha256(kept).hexdigest()))
    return Counter(result)


def test_suffix_dedup(spark, sf_dir, documents):
    got = Counter(map(tuple, suffix_dedup.op9_suffix_dedup(spark, sf_dir).collect()))
    assert got == repeats_expected(documents)


def test_substring_dedup(spark, sf_dir, documents):
    got = Counter(map(tuple, substring_dedup.op3_substring_dedup(spark, sf_dir).collect()))
    assert got == passages_expected(documents)


@pytest.mark.parametrize("block_bytes", [1 << 20, 3000])
def test_passages_of_odd_rows(spark, monkeypatch, block_bytes):
    """Also with many small blocks, and with documents that share parts, edges and periods."""
    monkeypatch.setattr(passages.search, "__defaults__", (None, block_bytes))
    own = random.Random(9)
    parts = [" ".join(f"p{own.randint(0, 40)}" for _ in range(own.choice([6, 13, 30, 60]))) for _ in range(12)]
    rows = ODD + [(100 + k, " ".join(own.choice(parts) for _ in range(own.randint(0, 5)))) for k in range(60)]
    rows += [(200, "ab" * 300), (201, "ba" * 300), (202, "b " * 60), (203, "b " * 13), (204, "b " * 12)]
    repeats = suffix_dedup.drop_repeats(frame(spark, rows)).collect()
    assert Counter((*tuple(r)[:4], hashlib.sha256(bytes(r.kept)).hexdigest()) for r in repeats) == repeats_expected(rows)
    kept = substring_dedup.drop_passages(frame(spark, rows), carry=["source", "block"]).collect()
    assert Counter((*tuple(r)[:3], hashlib.sha256(r.kept.encode()).hexdigest()) for r in kept) == passages_expected(rows)
    assert {(r.source, r.block) for r in kept} == {("s", 1)}
    assert suffix_dedup.drop_repeats(frame(spark, rows).limit(0)).count() == 0


@pytest.mark.parametrize("block_bytes", [1 << 20, 30000])
def test_passages_around_a_line_that_stands_everywhere(spark, monkeypatch, block_bytes):
    """A short line with other neighbours each time, with repeated ones, and lines as long as a window or nearly."""
    monkeypatch.setattr(passages.search, "__defaults__", (None, block_bytes))
    own = random.Random(3)
    word = lambda n: " ".join(f"n{own.randint(0, 10**6)}" for _ in range(n))
    line = "All rights to these pages are with us alone"
    common = [word(own.choice([2, 5, 9])) for _ in range(6)]
    rows = [(k, f"{word(6)}\n{line}\n{word(own.choice([3, 12]))}") for k in range(120)]
    rows += [(200 + k, f"{word(4)} {own.choice(common)} {line} {own.choice(common)} {word(4)}") for k in range(120)]
    rows += [(400 + k, f"{own.choice(common)} {line} of {line} {own.choice(common)}") for k in range(60)]
    rows += [(500 + k, f"{word(3)} {line} and with them that we chose for it so far {word(3)}") for k in range(40)] + ODD
    repeats = suffix_dedup.drop_repeats(frame(spark, rows), hot_rows=4).collect()
    assert Counter((*tuple(r)[:4], hashlib.sha256(bytes(r.kept)).hexdigest()) for r in repeats) == repeats_expected(rows)
    kept = substring_dedup.drop_passages(frame(spark, rows), hot_rows=4).collect()
    assert Counter((*tuple(r)[:3], hashlib.sha256(r.kept.encode()).hexdigest()) for r in kept) == passages_expected(rows)


@pytest.mark.parametrize("operator", [substring_dedup, suffix_dedup])
def test_nothing_is_sent_around_a_hot_line_whose_windows_stand_once(operator):
    own = random.Random(8)
    word = lambda n: " ".join(f"n{own.randint(0, 10**9)}" for _ in range(n))
    texts = [f"{word(20)} All rights to these pages are with us alone {word(20)}" for _ in range(500)]
    block = passages.Block(pa.table({"doc_id": pa.array(range(500), pa.int64()), "text": texts}))
    found = operator.anchors_of(block)

    def replies(hashes, around):
        shard = pa.RecordBatch.from_pydict({"block": [0], "data": [passages.entries_of(hashes, around).tobytes()]})
        return passages.replies_of(pa.chunked_array([b["data"] for b in passages.repeated_hashes(iter([shard]), 50)], pa.binary()))

    known = replies(found.hashes, found.around)
    comes_twice, hot = passages.lookup(found.hashes, known)
    assert 0 < len(known) < 100 and hot.sum() >= 300
    classes = found.hot_hashes(known)
    assert len(classes) >= 300
    places = found.sent(known, replies(classes, classes))[0]
    assert places.tolist() == found.places[comes_twice & ~hot].tolist()


def test_merge_runs_equals_sort():
    own = random.Random(2)
    runs = [sorted(bytes(own.choice(b"ab") for _ in range(100 if own.random() < 0.3 else 3)).ljust(100, b"\0") for _ in range(own.randint(0, 30))) for _ in range(7)]
    shared = lambda a, b: next((k for k in range(100) if a[k] != b[k]), 100)
    prefixes = [[0] * bool(run) + [shared(a, b) for a, b in zip(run, run[1:])] for run in runs]
    run, place, prefix = suffix_dedup.merge_runs(runs, prefixes)
    merged = [runs[r][p] for r, p in zip(run, place)]
    assert merged == sorted(x for own_run in runs for x in own_run)
    assert prefix.tolist() == [0] + [shared(a, b) for a, b in zip(merged, merged[1:])]


def test_fm_index_finds_all_occurrences():
    own = np.random.default_rng(4)
    text = own.integers(0, 5, 400)
    index = FMIndex(text, 16)
    patterns = own.integers(0, 5, (300, 6))
    patterns[:100] = [text[k : k + 6] for k in own.integers(0, 394, 100)]
    matched, low, high = index.matches(patterns)
    for pattern, size, a, b in zip(patterns, matched, low, high):
        tail = pattern[6 - size :]
        places = {k for k in range(400 - size + 1) if (text[k : k + size] == tail).all()}
        assert set(index.suffixes[a:b].tolist()) == places
        assert size == 6 or not any((text[k : k + size + 1] == pattern[5 - size :]).all() for k in range(400 - size))


def test_anchors_of_equal_windows_are_equal():
    own = np.random.default_rng(1)
    values = own.integers(0, 1 << 62, 300).astype(np.uint64)
    valid = own.random(288) < 0.7
    expected = {i + j for i in range(288) if valid[i] for j in range(13) if values[i + j] == values[i : i + 13].min()}
    assert anchors(values, valid, 13).tolist() == sorted(expected)
    assert (window_minima(values, 7) == [values[i : i + 7].min() for i in range(294)]).all()
    hashes = window_hashes(np.tile(values[:20], 2), 13)
    assert (hashes[:8] == hashes[20:]).all() and len(set(hashes[:20].tolist())) == 20


@pytest.mark.parametrize("threshold", [0.5, 0.6, 0.8])
def test_near_pairs_at_other_thresholds(spark, threshold):
    """Pairs just over the threshold and under it, each of its own words."""
    rng = random.Random(int(threshold * 10))
    rows = []
    for k in range(300):
        base = [f"{k}w{i}" for i in range(120)]
        other = list(base)
        for _ in range(rng.randrange(0, 22)):
            other[rng.randrange(len(other))] = f"{k}x{rng.random()}"
        rows += [(2 * k, " ".join(base)), (2 * k + 1, " ".join(other))]
    expected = {}
    for k in range(300):
        sets = [{tuple(words[i : i + 5]) for i in range(len(words) - 4)} for words in (rows[2 * k][1].split(), rows[2 * k + 1][1].split())]
        near = len(sets[0] & sets[1]) >= threshold * len(sets[0] | sets[1])
        expected |= {2 * k: near, 2 * k + 1: near}
    got = {r.doc_id: r.n_links == 1 for r in ngram_join.near_duplicates(frame(spark, rows), threshold=threshold).collect()}
    assert sum(expected.values()) > 80 and got.keys() == expected.keys()
    assert not any(got[k] for k in got if not expected[k])
    assert sum(got[k] for k in got if expected[k]) >= 0.999 * sum(expected.values())


def test_anchors_take_little_beside_their_hashes():
    """Hashes and minima are made in pieces that stay in cache; whole arrays in between took 42 bytes a byte of text."""
    text = bytes(random.Random(3).choices(b"abcdefgh ", k=1 << 20))
    block = passages.Block(pa.table({"doc_id": pa.array([1, 2], pa.int64()), "text": [text[: 1 << 19].decode(), text[1 << 19 :].decode()]}))
    tracemalloc.start()
    try:
        found = suffix_dedup.anchors_of(block)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(found.places) > 10_000
    assert peak < 24 * len(text)


def test_every_window_has_an_anchor_whatever_its_hashes(monkeypatch):
    monkeypatch.setattr(passages, "mixed", lambda values: values % np.uint64(3))
    lengths = np.array([40, 0, 13, 5, 300])
    found = passages.Anchors(np.arange(358, dtype=np.uint64), lengths, 5, 13, 1)
    starts = np.cumsum(lengths) - lengths
    for start, length in zip(starts, lengths):
        for window in range(start, start + length - 12):
            assert ((found.places >= window) & (found.places <= window + 8)).any()


@pytest.mark.parametrize("size", [30, 1000, 40_000])
def test_chunked_helpers_equal_plain_ones(monkeypatch, size):
    own = np.random.default_rng(size)
    monkeypatch.setattr(arrays, "CHUNK", 64)
    for width in (1, 5, 24, 100):
        values = own.integers(0, 1 << 62, size).astype(np.uint64)
        expected = [0] * max(0, size - width + 1)
        for k in range(0, len(expected), max(1, len(expected) // 50)):
            for value in values[k : k + width].tolist():
                expected[k] = (expected[k] * arrays.BASE + value) % 2**64
        got = window_hashes(values, width)
        assert len(got) == len(expected)
        assert all(got[k] == expected[k] for k in range(0, len(expected), max(1, len(expected) // 50)))
        low = values % np.uint64(50)
        valid = own.random(max(0, size - width + 1)) < 0.8
        places = {int(k) for w in np.flatnonzero(valid) for k in w + np.flatnonzero(low[w : w + width] == low[w : w + width].min()) if low[k]}
        assert anchors(low, valid, width).tolist() == sorted(places)
    lengths = own.integers(0, 9, size // 5)
    text = np.repeat(np.arange(len(lengths)), lengths)
    inside = [bool(text[k] == text[k + 3]) for k in range(len(text) - 3)]
    assert passages.inner_windows(lengths, 4).tolist() == inside


@pytest.mark.parametrize("times", [1, 1 << 22])
def test_repeats_of_pairs(times):
    """Also where three numbers don't fit into 63 bits."""
    own = np.random.default_rng(6)
    right, left = own.integers(0, 30, 500) * times, own.integers(0, 30, 500)
    seen, expected = set(), []
    for k, pair in enumerate(zip(right.tolist(), left.tolist())):
        expected += [k] * (pair in seen)
        seen.add(pair)
    assert sorted(suffix_dedup.repeats_of(right, left).tolist()) == expected
    assert suffix_dedup.repeats_of(right[:0], left[:0]).tolist() == []


def test_word_hashes_take_little_beside_the_texts():
    rng = np.random.default_rng(8)
    texts = [bytes(rng.choice(np.frombuffer(b"abcdefgh \n", np.uint8), 1 << 20)) for _ in range(4)]
    ngram_join.word_hashes(texts[:1])
    tracemalloc.start()
    hashes, counts = ngram_join.word_hashes(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 25 * sum(map(len, texts)), peak / sum(map(len, texts))
    alone = [ngram_join.word_hashes([word])[0][0] for word in texts[3].split()[-200:]]
    assert hashes[-200:].tolist() == alone and counts.tolist() == [len(text.split()) for text in texts]


def test_words_longer_than_a_chunk_have_their_own_hashes(monkeypatch):
    rng = random.Random(9)
    texts = [b" ".join(b"w" * rng.choice([1, 2, 15, 16, 17, 40]) for _ in range(30)) for _ in range(4)] + [b"", b" \n ", b"x" * 100]
    whole = ngram_join.word_hashes(texts)
    monkeypatch.setattr(ngram_join, "CHUNK", 16)
    pieces = ngram_join.word_hashes(texts)
    assert [own.tolist() for own in pieces] == [own.tolist() for own in whole]


def test_tasks_over_texts_get_small_batches(spark, monkeypatch):
    text = " ".join(f"word{k}" for k in range(500))
    docs = spark.range(3000, numPartitions=1).select(F.col("id").alias("doc_id"), F.concat(F.lit(text + " "), "id").alias("text"))
    sizes = docs.mapInArrow(lambda batches: (pa.record_batch({"n": [batch.nbytes]}) for batch in batches), "n long")
    with session.small_batches(spark):
        held = [row.n for row in sizes.collect()]
    assert max(held) < session.ARROW_BYTES + 10_000 and sum(held) > 4 * session.ARROW_BYTES

    limits = {}

    def watched(df, label):
        limits[label] = spark.conf.get(session.ARROW_SETTING, None)
        return session.materialize(df, label)

    for module in (ngram_join, packing):
        monkeypatch.setattr(module, "materialize", watched)
    ngram_join.one_of_each(docs.limit(20)).count()
    packing.pack_documents(docs.limit(20), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN).count()
    for label in ("ngram-sets", "links", "pack-pieces"):
        assert limits[label] == str(session.ARROW_BYTES), label
    assert spark.conf.get(session.ARROW_SETTING, None) is None


def test_a_limit_of_the_session_stays(spark):
    spark.conf.set(session.ARROW_SETTING, 12345)
    try:
        with session.small_batches(spark):
            assert spark.conf.get(session.ARROW_SETTING) == "12345"
        assert spark.conf.get(session.ARROW_SETTING) == "12345"
    finally:
        spark.conf.unset(session.ARROW_SETTING)
