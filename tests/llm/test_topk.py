import math
import random

import pytest

from affinis.llm import topk

SCHEMA = "vec_id long, embedding array<float>, rank string"


def brute(rows, every, k=5):
    usable = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in {i: (i, v) for i, v in usable if i % every == 0}.values():
        found = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in usable if i != q and len(a) == len(b))
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(found[:k])]
    return sorted(out)


def found(spark, rows, every, k=5):
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], SCHEMA).repartition(3).withColumn("vec", topk.scaled("embedding"))
    return sorted(tuple(r) for r in topk.top_k(df, df.filter(f"vec_id % {every} = 0"), k).collect())


@pytest.mark.parametrize(("n", "width", "block"), [(3, 4, 4096), (300, 8, 64), (700, 16, 4096)])
def test_against_brute_force(spark, monkeypatch, n, width, block):
    monkeypatch.setattr(topk, "BLOCK", block)
    rng = random.Random(n)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(width)]) for i in range(n)]
    rows = [(i, [float(f"{x:.6f}") for x in v]) for i, v in rows]
    exact = [(r.vec_id, r.embedding) for r in spark.createDataFrame([(i, v, "") for i, v in rows], SCHEMA).collect()]
    assert found(spark, rows, 7) == brute(exact, 7)


def test_ties_nulls_and_lengths(spark):
    rows = [(i, [1.0, 0.0]) for i in range(40)] + [(100, [0.5, 0.5])] * 1
    rows += [(41, None), (42, [None, 1.0]), (43, [float("nan"), 1.0]), (44, [float("inf"), 1.0]), (None, [1.0, 1.0]), (45, [1.0]), (50, [1.0]), (60, []), (61, [])]
    assert found(spark, rows, 10) == brute(rows, 10)


def test_empty(spark):
    assert found(spark, [], 10) == []


def test_repeated_queries_count_once_and_repeated_candidates_are_rows(spark):
    rows = [(0, [1.0]), (0, [1.0]), (1, [0.5]), (1, [0.5]), (2, [0.25])]
    assert found(spark, rows, 10) == [(0, 1, 1, 256 * 128), (0, 2, 1, 256 * 128), (0, 3, 2, 256 * 64)]


@pytest.mark.parametrize("large", [1e8, 3e6, 1e15])
def test_large_components(spark, large):
    """Finite components of any size take part; a score beyond the range of long is its end."""
    rng = random.Random(9)
    rows = [(i, [float(int(rng.gauss(0, 1) * (large if i % 9 == 0 else 1))), rng.choice([0.5, 1.0, large])]) for i in range(90)]
    exact = [(r.vec_id, r.embedding) for r in spark.createDataFrame([(i, v, "") for i, v in rows], SCHEMA).collect()]
    top, low = (1 << 63) - 1, -(1 << 63)
    usable = [(i, [max(low, min(top, math.floor(256 * x))) for x in v]) for i, v in exact]
    expected = []
    for q, a in usable:
        if q % 6 == 0:
            best = sorted((-max(low, min(top, sum(x * y for x, y in zip(a, b, strict=True)))), i) for i, b in usable if i != q)[:5]
            expected += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    assert found(spark, rows, 6) == sorted(expected)


def test_repeated_query_with_a_null_vector(spark):
    rows = [(0, None), (0, [1.0]), (0, None), (1, [0.5])]
    assert found(spark, rows, 2) == [(0, 1, 1, 128 * 256)]


def test_ties_at_large_products():
    """Products that doubles can't tell apart."""
    import numpy as np

    vectors = np.array([[1 << 30, 1 << 27], [1 << 30, (1 << 27) + 1], *[[1, i] for i in range(60)]], np.int64)
    query = np.array([[1 << 30, 1]], np.int64)
    got = topk.search_block(np.arange(62), vectors, np.array([99]), query, 1)
    assert got == [(99, 1, (1 << 60) + (1 << 27) + 1)]
