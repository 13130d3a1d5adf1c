"""Top-k search against all inner products, whitening against numpy's eigenvalues."""

import math

import numpy as np
import pytest

from feedstat.llm import top_search, whitening
from oracle import connect, differences, plan

SCHEMA = "vec_id long, embedding array<double>, label int, score long, whitened string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, 7, "x") for i, v in rows], SCHEMA)


def ranked(rows, queries, k):
    """Every row against every query by definition."""
    out = []
    for q, v in queries:
        scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in rows if i != q)
        out += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(scores[:k])]
    return sorted(out)


def searched(spark, rows, queries, k, **sizes):
    frames = [spark.createDataFrame(part, "id long, vector array<long>") for part in (rows, queries)]
    return sorted(tuple(r) for r in top_search.search(*frames, k, **sizes).collect())


def test_query_equals_sql(spark, sf_dir):
    df = top_search.op12_topk(spark, sf_dir)
    assert differences(df, connect(sf_dir), top_search.ORACLES["op12_topk"]) == []
    assert "CartesianProduct" not in plan(df) and "NestedLoop" not in plan(df)


@pytest.mark.parametrize("spread", [3, 90, 10**5, 10**8])
def test_search_equals_all_products(spark, spread):
    """Numbers small enough for each kind of number, with ties, zeros, repeated rows and many shards."""
    rng = np.random.default_rng(spread)
    rows = [(int(i), (rng.integers(-spread, spread + 1, 6) * (rng.random(6) < 0.7)).tolist()) for i in rng.permutation(700)]
    rows += rows[:40]
    queries = [row for row in rows[40:] if row[0] % 9 == 0]
    assert searched(spark, rows, queries, 5, shard_rows=150, block_rows=30) == ranked(rows, queries, 5)


def test_terms_are_left_out_and_probed():
    """One large shard: few rows reach the threshold, and the answer stays that of all products."""
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(40, 32))
    vectors = centres[rng.integers(0, 40, 4000)] + 0.4 * rng.normal(size=(4000, 32))
    ints = np.floor(256 * vectors / np.linalg.norm(vectors, axis=1)[:, None]).astype(np.int64)
    ids = np.arange(4000) * 3
    query, row, score = top_search.search_tile(
        np.ascontiguousarray(ints.T.astype(np.float32)), ids, ints[:60].astype(np.float32), ids[:60], 5
    )
    got = sorted(zip(ids[query].tolist(), ids[row].tolist(), score.astype(int).tolist()))
    rows = [(int(i), v.tolist()) for i, v in zip(ids, ints)]
    assert got == sorted((q, i, s) for q, _, i, s in ranked(rows, rows[:60], 5))


def test_search_odd_rows(spark):
    rows = [(0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [float("nan"), 1.0]), (4, [float("inf"), 0.0]),
            (5, []), (6, [0.5]), (7, [-1.0, -1.0, 9.0]), (7, [-1.0, -1.0, 9.0]), (None, [5.0, 5.0])]
    vectors = top_search.scaled_vectors(table(spark, rows))
    got = sorted(tuple(r) for r in top_search.search(vectors, vectors.where("id = 0"), 5).collect())
    assert got == [(0, 1, 6, 32768), (0, 2, 5, 0), (0, 3, 7, -196608), (0, 4, 7, -196608)]
    assert top_search.search(vectors, vectors.where("id = 99"), 5).count() == 0
    assert top_search.search(vectors.where("id = 99"), vectors, 5).count() == 0
    assert top_search.search(vectors.where("id = 0"), vectors.where("id = 0"), 5).count() == 0


def test_scores_too_large_raise(spark):
    with pytest.raises(Exception, match="64 bits"):
        searched(spark, [(1, [2**40]), (2, [2**40])], [(1, [2**40])], 5)


def brute_whitening(vectors, most=8):
    x = [[math.floor(1024 * c) + 100_000 for c in v] for v in vectors]
    n, width = len(x), len(x[0])
    sums = [sum(row[d] for row in x) for d in range(width)]
    z = np.array([[(n * row[d] - sums[d]) / n for d in range(width)] for row in x])
    values, units = np.linalg.eigh(z.T @ z / n)
    order = np.argsort(-values)[:most]
    deviation = [sum((n * row[d] - sums[d]) ** 2 for d in range(width)) for row in x]
    return n, deviation, z @ units[:, order] / np.sqrt(values[order]), values[order] / values.sum()


def compare(got, ids, vectors, most=8):
    n, deviation, white, explained = brute_whitening(vectors, most)
    by = {}
    for r in got:
        by.setdefault(r["component"], {})[r["vec_id"]] = r
    assert sorted(by) == list(range(1, white.shape[1] + 1))
    for k, own in by.items():
        assert sorted(own) == sorted(ids)
        found = np.array([own[i]["whitened"] for i in ids])
        sign = np.sign(found @ white[:, k - 1])
        assert np.allclose(found, sign * white[:, k - 1], atol=1e-8)
        assert all(own[i]["n"] == n and own[i]["deviation"] == d for i, d in zip(ids, deviation))
        assert all(abs(own[i]["explained"] / explained[k - 1] - 1) < 1e-9 and own[i]["identity_error"] < 1e-9 for i in ids)


def test_whitening_of_all_vectors(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    got = whitening.op13_whitening(spark, sf_dir).collect()
    compare(got, [r["vec_id"] for r in rows], [r["embedding"] for r in rows])


def test_whitening_odd_rows(spark):
    rng = np.random.default_rng(3)
    good = [(i, rng.normal(size=5).tolist()) for i in range(40)] + [(99, [300.0, -200.0, 0.0, 0.25, 1e-9])]
    odd = [(50, None), (51, [1.0, None, 2.0, 0.0, 0.0]), (52, [float("nan")] * 5), (53, [float("-inf")] * 5)]
    got = whitening.whiten(table(spark, good + odd)).collect()
    compare(got, [i for i, _ in good], [v for _, v in good])
    assert set(got[0].asDict()) == {"vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"}


def test_whitening_of_smaller_rank(spark):
    """Dimensions that follow from others, equal rows, short vectors: as many components as there is rank."""
    rng = np.random.default_rng(4)
    flat = [(i, [float(a), float(b), float(a + b), 0.0]) for i, (a, b) in enumerate(rng.integers(-9, 9, (30, 2)))]
    got = whitening.whiten(table(spark, flat + flat[:3])).collect()
    assert sorted({r["component"] for r in got}) == [1, 2] and len(got) == 2 * 33
    assert got[0]["identity_error"] < 1e-9
    assert whitening.whiten(table(spark, [(1, [1.0, 2.0])] * 3)).count() == 0
    assert whitening.whiten(table(spark, [])).count() == 0
    short = [(0, [1.0, 2.0]), (1, [0.5]), (2, []), (3, [4.0, 1.0])]
    padded = [v + [0.0] * (2 - len(v)) for _, v in short]
    compare(whitening.whiten(table(spark, short)).collect(), [0, 1, 2, 3], padded)


def test_deviation_past_64_bits_is_null(spark):
    got = whitening.whiten(table(spark, [(0, [3e9]), (1, [-3e9]), (2, [0.0])])).collect()
    assert [r["deviation"] for r in sorted(got, key=lambda r: r["vec_id"])][:2] == [None, None]


@pytest.mark.parametrize("size", [1, 2, 7, 33])
def test_jacobi_on_cholesky_gives_small_eigenvalues(size):
    rng = np.random.default_rng(size)
    basis, _ = np.linalg.qr(rng.normal(size=(size, size)))
    wanted = np.logspace(0, -9, size)
    matrix = (basis * wanted) @ basis.T
    turned = whitening.orthogonal_columns(whitening.pivoted_cholesky((matrix + matrix.T) / 2))
    assert np.allclose(np.sort((turned * turned).sum(0))[::-1], wanted, rtol=1e-5)
    assert np.allclose(turned @ turned.T, matrix, atol=1e-13)
