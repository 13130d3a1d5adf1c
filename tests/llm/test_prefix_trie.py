"""The prefix trie against a plain dictionary of prefixes."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from feedstat.llm import prefix_trie
from oracle import connect, differences, plan

SCHEMA = "conv_id long, turn long, role string, text string, pos long, digest string, bytes int, j string"


def table(spark, rows):
    return spark.createDataFrame([(*row, 9, "x", 1, "y") for row in rows], SCHEMA).repartition(5)


def sequences(rows):
    """Turns of each conversation in order, as (role, text)."""
    out = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            text = text or ""
            key = (turn is not None, turn or 0, role or "", hashlib.sha256(text.encode()).digest(), text)
            out.setdefault(conv, []).append(key)
    return {conv: [(k[2], k[4]) for k in sorted(own)] for conv, own in out.items()}


def brute(convs):
    members = {}
    for c in sorted(convs):
        for d in range(len(convs[c]) + 1):
            members.setdefault(tuple(convs[c][:d]), []).append(c)
    children = {}
    for name in members:
        if name:
            children.setdefault(name[:-1], []).append(name)
    leaves, saved = {}, {}
    for name in sorted(members, key=len, reverse=True):
        below = children.get(name, [])
        leaves[name] = sum(leaves[c] for c in below) or 1
        text = len(name[-1][1].encode()) if name else 0
        saved[name] = (len(members[name]) - 1) * text + sum(saved[c] for c in below)
    return sorted(
        (own[0], len(name), members[name[:-1]][0] if name else -1, len(own), len(children.get(name, [])), leaves[name], saved[name],
         hashlib.sha256(",".join(str(c) for c in own if len(convs[c]) == len(name)).encode()).hexdigest())
        for name, own in members.items()
    )


def got(df):
    return sorted(tuple(-1 if v is None else v for v in row) for row in df.collect())


def forest(seed, convs=120, longest=40, ids=None):
    """Conversations that branch off earlier ones at random places, some of them copies."""
    rng = random.Random(seed)
    made = []
    for _ in range(convs):
        start = rng.choice(made)[: rng.choice([0, 1, 3, 7, 8, 9, 16, 17, 30, 99])] if made else []
        more = rng.choice([0, 0, 1, 1, 2, 8, rng.randrange(longest)])
        made.append(start + [(rng.choice(["user", "assistant"]), rng.choice("abé") * rng.randrange(4)) for _ in range(more)])
    ids = ids or rng.sample(range(10_000), convs)
    rows = [(c, t, role, text) for c, own in zip(ids, made) for t, (role, text) in enumerate(own)]
    rng.shuffle(rows)
    return rows


def test_query_equals_sql(spark, sf_dir):
    df = prefix_trie.op11_prefix_trie(spark, sf_dir)
    assert differences(df, connect(sf_dir), prefix_trie.ORACLES["op11_prefix_trie"]) == []
    assert "CartesianProduct" not in plan(df) and "NestedLoop" not in plan(df)


@pytest.mark.parametrize("seed", range(3))
def test_trie_equals_dictionary(spark, seed, monkeypatch):
    """Blocks of a few rows and conversations of several parts, so that prefixes cross both."""
    monkeypatch.setattr(prefix_trie, "BLOCK_ROWS", 7 if seed else 1 << 16)
    monkeypatch.setattr(prefix_trie, "SLICE", 2)
    rows = forest(seed)
    assert got(prefix_trie.conversation_trie(table(spark, rows))) == brute(sequences(rows))


def test_rebuilt_conversations(spark):
    """Heads from another conversation: absent ones, short ones, and conversations left without a turn."""
    rows = forest(11, convs=150, longest=14, ids=list(range(-20, 130)))
    rows = [row for row in rows if row[0] % 7]
    turns = prefix_trie.numbered(table(spark, rows)).cache()
    own = {c: turns for c, turns in sequences(rows).items()}
    wanted = {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))  # Spark's and SQL's remainder has the sign of c
        wanted[c] = own.get(base, [])[:h] + mine[h:]
    assert any(not turns for turns in wanted.values())
    assert got(prefix_trie.prefix_nodes(*prefix_trie.grafted(turns))) == brute(wanted)
    turns.unpersist()


def test_odd_rows(spark):
    rows = [
        (1, None, "user", "late"), (1, 0, None, "x"), (1, 0, None, "x"), (1, 0, "", None), (1, 0, "user", "b"), (1, 0, "user", "a"),
        (2, 5, "", ""), (2, None, "user", "late"), (None, 0, "user", "lost"), (3, 1, "user", "é" * 300_000), (4, 7, "user", "é" * 300_000),
    ]
    assert got(prefix_trie.conversation_trie(table(spark, rows))) == brute(sequences(rows))
    assert prefix_trie.conversation_trie(table(spark, [])).count() == 0
    assert prefix_trie.conversation_trie(table(spark, [(None, 0, "user", "lost")])).count() == 0


def test_one_large_group_of_copies(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BLOCK_ROWS", 50)
    copies = [(c, t, "user", f"line {t}") for c in range(400) for t in range(8)]
    rows = copies + [(1000 + c, t, "user", f"line {t % 3} {c}" if t > 2 else f"line {t}") for c in range(60) for t in range(5)]
    assert got(prefix_trie.conversation_trie(table(spark, rows))) == brute(sequences(rows))


def test_extents_from_range_minima():
    rng = np.random.default_rng(1)
    for size in (1, 2, 3, 17, 64, 100):
        lcp = rng.integers(-1, 6, size)
        lcp[0] = -1
        minima = prefix_trie.RangeMinimum(lcp)
        at, depth = (a.ravel() for a in np.meshgrid(np.arange(size), np.arange(0, 7)))
        left, right = minima.left(at, depth), minima.right(at, depth)
        for i, d, a, b in zip(at.tolist(), depth.tolist(), left.tolist(), right.tolist()):
            first, last = i, i + 1
            while first > 0 and lcp[first] >= d:
                first -= 1
            while last < size and lcp[last] >= d:
                last += 1
            assert (a, b) == (first, last)
        start = rng.integers(0, size, 50)
        stop = start + 1 + (rng.random(50) * (size - start)).astype(int)
        stop = np.minimum(stop, size)
        assert minima.least(start, stop).tolist() == [lcp[a:b].min() for a, b in zip(start, stop)]
