"""Encoding, decoding and packing against the tokenizer libraries."""

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from feedstat.llm import bpe, packing

RANKS = P.path("byte_bpe_50k.tiktoken")
TEXTS = [
    None, "", " ", "a", "the the", "   a  b\n\n c \t d ", "aaaaaaa" * 400, "it's I'll  'ss  x  y", "\n \n", "a ",
    "日本語 テスト 🎉🎉 \x1c x", "x<|endoftext|>y", "é" * 300, "a  b  c", "\r\n\r\n x", "12345 678 9",
] + ["word " * 3000, "Zu und. Dieüauß der.\n" * 40]


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def rows(spark, texts):
    return spark.createDataFrame([(k, text, "x") for k, text in enumerate(texts)], "doc_id long, text string, ids_ string")


def test_encode_and_decode(spark, reference):
    docs = rows(spark, TEXTS)
    encoded = bpe.encode(docs, RANKS, P.PATTERN, batch_bytes=2000)
    got = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in encoded.collect()}
    assert got == {k: reference.encode_ordinary(text or "") for k, text in enumerate(TEXTS)}
    back = {r.doc_id: bytes(r.decoded) for r in bpe.decode(encoded, RANKS).collect()}
    assert back == {k: (text or "").encode() for k, text in enumerate(TEXTS)}


def test_replay_of_invented_ranks():
    """A vocabulary in which a merge makes a pair of lower rank."""
    ranks = {bytes([b]): b for b in range(256)}
    for k, token in enumerate([b"aab", b"ab", b"ba", b"aa", b"abab", b"aaaa"]):
        ranks[token] = 256 + k
    replay, own = bpe.MergeReplay(ranks), random.Random(1)
    words = [bytes(own.choice(b"aabc") for _ in range(own.randint(0, 12))) for _ in range(2000)]
    ids, starts = replay.encode(words)
    assert [ids[a:b].tolist() for a, b in zip(starts, starts[1:])] == [replay.encode_one(w) for w in words]


def test_op1_on_documents(spark, sf_dir, reference):
    got = {r.doc_id: tuple(r)[1:] for r in bpe.op1_bpe(spark, sf_dir).collect()}
    for doc_id, text in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect():
        ids = np.array(reference.encode_ordinary(text or ""), "<u4")
        digests = [hashlib.sha256(x).hexdigest() for x in (ids.tobytes(), (text or "").encode())]
        assert got[doc_id] == (len(ids), *digests)


def check_packing(result, texts):
    tokenizer = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    sequences, pieces = {}, {}
    for r in result:
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    total = 0
    for doc_id, text in texts.items():
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        own = sorted(pieces.pop(doc_id), key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(-(-len(ids) // 1024)))
        assert [r.length for r in own[1:]] == [1024] * (len(own) - 1)
        start = 0
        for r in own:
            assert r.start == start and r.ids_crc32 == zlib.crc32(ids[start : start + r.length].tobytes())
            start += r.length
        assert start == len(ids)
        total += start
    assert not pieces
    for own in sequences.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= 1024
    return len(sequences), -(-total // 1024)


def test_op6_on_documents(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    used, least = check_packing(packing.op6_packing(spark, sf_dir).collect(), texts)
    assert used <= least * 1.02 + 1


def test_packing_of_odd_rows(spark):
    docs = rows(spark, TEXTS)
    result = packing.pack_documents(docs, P.path("byte_bpe_50k.json"), P.PATTERN)
    check_packing(result.collect(), dict(enumerate(TEXTS)))
    assert packing.pack_documents(docs.limit(0), P.path("byte_bpe_50k.json"), P.PATTERN).count() == 0
    twice = packing.pack_documents(docs.union(docs), P.path("byte_bpe_50k.json"), P.PATTERN)
    assert twice.count() == 2 * result.count()
    assert twice.select("sequence_id", "offset").distinct().count() == twice.count()


@pytest.mark.parametrize("capacity", [1, 7, 16, 100])
def test_plan_is_a_packing(capacity):
    own = random.Random(capacity)
    for _ in range(60):
        counts = [0] * (capacity + 1)
        for _ in range(own.choice([0, 1, 7, 300])):
            counts[own.choice([own.randint(1, capacity), own.randint(1, -(-capacity // 4)), capacity])] += 1
        free = {}
        for length, plan in packing.make_plan(counts, capacity).items():
            for rank in range(counts[length]):
                first, sequence, offset, each = plan[np.searchsorted(plan[:, 0], rank, side="right") - 1]
                places = range(offset + (rank - first) % each * length, offset + ((rank - first) % each + 1) * length)
                own_places = free.setdefault(sequence + (rank - first) // each, set())
                assert not own_places & set(places)
                own_places |= set(places)
        assert all(places == set(range(len(places))) and len(places) <= capacity for places in free.values())


def test_reduction_never_needs_more_sequences():
    """Against the best of all packings of small instances."""
    def best(lengths, capacity):
        lengths = sorted(lengths, reverse=True)
        most = len(lengths)

        def place(k, room):
            nonlocal most
            if len(room) >= most:
                return
            if k == len(lengths):
                most = len(room)
                return
            for i in range(len(room)):
                if room[i] >= lengths[k] and room[i] not in room[:i]:
                    place(k + 1, room[:i] + [room[i] - lengths[k]] + room[i + 1:])
            place(k + 1, room + [capacity - lengths[k]])

        place(0, [])
        return most

    own = random.Random(3)
    for _ in range(150):
        lengths = [own.randint(1, 12) for _ in range(own.randint(1, 8))]
        counts = [0] * 13
        for length in lengths:
            counts[length] += 1
        fixed = packing.reduce_by_dominance(counts, 12)
        rest = [x for x, n in enumerate(counts) for _ in range(n)]
        assert sum(n for _, n in fixed) + (best(rest, 12) if rest else 0) == best(lengths, 12)


def test_units_join_and_come_apart():
    """Random white space of all kinds, units that share a string, and a store that forgets."""
    import pyarrow as pa
    import regex

    own = random.Random(7)
    parts = [" ", " ", " ", "\n", "\t", "\x1c", "\x85", " ", " ", "a", "bc", "'s", "é", "🎉", "1", ".", "ab.\ncd", "<|endoftext|>", "̀"]
    texts = ["".join(own.choice(parts) for _ in range(own.randrange(30))) for _ in range(3000)] + [t or "" for t in TEXTS]
    tokenizer = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    store, matcher = packing.UnitStore(P.path("byte_bpe_50k.json"), most=300), regex.compile(P.PATTERN)
    for start in range(0, len(texts), 200):
        some = texts[start : start + 200]
        ids, starts = store.encode(pa.array(some), matcher)
        got = [ids[a:b].tolist() for a, b in zip(starts, starts[1:])]
        assert got == [tokenizer.encode(text, add_special_tokens=False).ids for text in some]


def test_units_share_the_parts_that_the_tokenizer_cuts():
    """Words with other signs or line ends around them are encoded once; ids are the tokenizer's."""
    import pyarrow as pa
    import regex

    own = random.Random(11)
    signs = ["", ",", ".", ").", "...", "$$$", "'s", "'s.", "'", "-", "\n", ".\n", "\n\n", ",\n,", "\r\n", "×", "÷.", "…", "\u0301."]
    words = ["word", "Über", "été", "naïvÿ", "42", "x2", "日本", "ß", "don't", "a-b", "\xa0", "_", ""]
    texts = [" ".join(own.choice(signs) + own.choice(words) + own.choice(signs) + own.choice(["", own.choice(words)]) for _ in range(6)) for _ in range(3000)]
    texts += ["word word, word. word\nword word;\nword"] * 2 + ["", ".", "\n", "word.", ".word", "\n."]
    tokenizer = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    store, matcher = packing.UnitStore(P.path("byte_bpe_50k.json")), regex.compile(P.PATTERN)
    store.encode(pa.array(texts[-8:-6]), matcher)
    assert set(store.units.to_pylist()) == {"word", " word", "\nword", ",", ".", ";"}
    ids, starts = store.encode(pa.array(texts), matcher)
    for text, a, b in zip(texts, starts, starts[1:]):
        assert ids[a:b].tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_parts_are_cut_at_signs_and_line_ends():
    import pyarrow as pa

    units = [" word,", " été.\nNon", "", " a-b", " ×.", " x...\n\ny!", "'s"]
    parts, starts = packing.parts_of(pa.array(["lead", *units]).slice(1))
    got = [parts.to_pylist()[a:b] for a, b in zip(starts, starts[1:])]
    assert got == [
        [" word", ","], [" été", ".", "\nNon"], [""], [" a-b"], [" ×."], [" x", "...", "\n\ny", "!"], ["'s"],
    ]
    assert packing.parts_of(pa.array([], pa.string()))[1].tolist() == [0]
