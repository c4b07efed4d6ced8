"""Neighbours, autocorrelation and adjusted p-values against plain Python."""

import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from affinis.operators import joins, spatial

SCHEMA = "id long, x double, y double, value double"


def brute_edges(points, k):
    out = {}
    for i, x, y, _ in points:
        others = sorted(((x - a) * (x - a) + (y - b) * (y - b), j) for j, a, b, _ in points if j != i)[:k]
        for rank, (d2, j) in enumerate(others, 1):
            out[i, rank] = (j, math.sqrt(d2), 1 / len(others))
    return out


def got_edges(df):
    return {(r.i, r["rank"]): (r.j, r.distance, r.w) for r in df.collect()}


def scattered(kind):
    rng = random.Random(7)
    if kind == "even":
        return [(i, rng.uniform(-3, 3), rng.uniform(5, 9), rng.gauss(0, 1)) for i in range(150)]
    if kind == "hot":  # a dense cell, one place of many points, a grid of ties, and loners far away
        dense = [(i, rng.gauss(0, 1e-6), rng.gauss(0, 1e-6), 1.0) for i in range(80)]
        place = [(100 + i, 4.25, -1.5, 2.0) for i in range(40)]
        ties = [(200 + 6 * a + b, float(a), float(b), 0.5) for a in range(6) for b in range(6)]
        return dense + place + ties + [(900, 1e6, 1e6, 0.0), (901, -1e6, 3.0, 0.0), (902, 1e6 + 1, 1e6, 1.0)]
    return [(i, 2.0, 2.0, float(i)) for i in range(9)]


@pytest.mark.parametrize(("kind", "k"), [("even", 5), ("hot", 4), ("one place", 3), ("hot", 1)])
@pytest.mark.parametrize("small", [True, False])
def test_neighbours(spark, monkeypatch, kind, k, small):
    if small:
        monkeypatch.setattr(spatial, "CELL_PLACES", 6)
        monkeypatch.setattr(spatial, "BLOCK", 4)
    points = scattered(kind)
    assert got_edges(spatial.nearest_neighbours(spark.createDataFrame(points, SCHEMA), k)) == brute_edges(points, k)


def test_few_and_bad_points(spark):
    points = [(1, 0.0, 0.0, 1.0), (2, 3.0, 4.0, 1.0)]
    bad = [(3, None, 0.0, 1.0), (None, 1.0, 1.0, 1.0), (4, float("nan"), 0.0, 1.0), (5, float("inf"), 0.0, 1.0)]
    df = spark.createDataFrame(points + bad, SCHEMA)
    assert got_edges(spatial.nearest_neighbours(df, 3)) == {(1, 1): (2, 5.0, 1.0), (2, 1): (1, 5.0, 1.0)}
    assert spatial.nearest_neighbours(df.filter("id = 1"), 2).count() == 0
    assert spatial.nearest_neighbours(df.limit(0), 2).count() == 0
    with pytest.raises(ValueError):
        spatial.nearest_neighbours(df, 0)


def draws(ids, perms, seed):
    order = sorted(ids)
    out = {0: {i: i for i in order}}
    for p in range(1, perms + 1):
        ranked = sorted(order, key=lambda i: (hashlib.md5(f"{seed}:{p}:{i}".encode()).hexdigest(), i))
        out[p] = dict(zip(ranked, order, strict=True))
    return out


@pytest.fixture(scope="module")
def graph():
    rng = random.Random(3)
    values = [(i, rng.gauss(0, 1) + (i % 20 > 9)) for i in range(60)]
    edges = [(i, (i + d) % 60, 1.0 + d) for i in range(55) for d in (1, 20)] + [(0, j, 0.5) for j in range(2, 50)]  # node 0 is a hub
    return edges, values


@pytest.mark.parametrize("salt", [100_000, 5])
def test_moran(spark, monkeypatch, graph, salt):
    monkeypatch.setattr(joins, "ROWS_PER_SALT", salt)
    edges, values = graph
    perms, n = 19, len(values)
    mean = sum(v for _, v in values) / n
    z = {i: v - mean for i, v in values}
    ss = sum(v * v for v in z.values())
    drawn = draws(z, perms, 5)
    e = spark.createDataFrame([*edges, (1, 999, 4.0), (3, 4, None)], "i long, j long, w double")
    v = spark.createDataFrame([*values, (998, None), (997, float("nan"))], "id long, value double")

    def index(p):
        return round(n * sum(w * z[drawn[p][i]] * z[drawn[p][j]] for i, j, w in edges) / (sum(w for *_, w in edges) * ss), 9)

    seen = [index(p) for p in range(perms + 1)]
    above = sum(s >= seen[0] for s in seen[1:])
    row = spatial.global_moran(e.filter("j < 900"), v, permutations=perms, seed=5).first()
    assert (row.n, row.expected) == (n, pytest.approx(-1 / (n - 1)))
    assert (row.moran_i, row.p_value) == (pytest.approx(seen[0]), (min(above, perms - above) + 1) / (perms + 1))

    degree = {}
    for i, _, w in edges:
        degree[i] = degree.get(i, 0) + w
    expected = {}
    for node in z:
        own = [(j, w / degree[i]) for i, j, w in edges if i == node]
        if not own:
            expected[node] = (None, None, None, None)
            continue
        lags = [sum(w * z[drawn[p][node] if p and drawn[p][j] == node else drawn[p][j]] for j, w in own) for p in range(perms + 1)]
        scores = [round(z[node] * lag / (ss / n), 9) for lag in lags]
        above = sum(s >= scores[0] for s in scores[1:])
        quadrant = (1 if z[node] > 0 else 2) if lags[0] > 0 else (3 if z[node] <= 0 else 4)
        expected[node] = (lags[0], scores[0], quadrant, (min(above, perms - above) + 1) / (perms + 1))
    found = {r.id: r for r in spatial.local_moran(e.filter("j < 900"), v, permutations=perms, seed=5).collect()}
    assert found.keys() == expected.keys()
    adjusted = step_up({i: x[3] for i, x in expected.items() if x[3] is not None})
    for i, (lag, score, quadrant, p) in expected.items():
        r = found[i]
        assert (r.quadrant, r.p_value) == (quadrant, p)
        if p is None:
            assert r.lag is None and r.local_i is None and r.p_adjusted is None
        else:
            assert (r.lag, r.local_i, r.p_adjusted) == (pytest.approx(lag), pytest.approx(score, abs=1e-8), pytest.approx(adjusted[i]))


def test_draws_by_size(spark, monkeypatch, graph):
    """Hashes are made and put in order in as many tasks as there are draws for; ranges of hashes change no draw."""
    monkeypatch.setattr(spatial, "TASK_DRAWS", 100, raising=False)
    monkeypatch.setattr(spatial, "RANGE_NODES", 7, raising=False)
    tasks, made = [], getattr(spatial, "positions_in_ranges", None)
    monkeypatch.setattr(spatial, "positions_in_ranges", lambda df, *a, **b: tasks.append(df.rdd.getNumPartitions()) or made(df, *a, **b), raising=False)
    _, values = graph
    nodes = spatial._nodes(spark.createDataFrame(values, "id long, value double"), "id", "value")
    drawn = {r.id: {d.perm: d.source for d in r.drawn} for r in spatial.shuffled(nodes, 9, 5).collect()}
    assert tasks == [6]  # 60 nodes, 9 permutations
    assert drawn == {i: {p: draw[i] for p, draw in draws(dict(values), 9, 5).items()} for i, _ in values}


def test_an_edge_stays_one_row(spark, graph):
    edges, values = graph
    nodes = spatial._nodes(spark.createDataFrame(values, "id long, value double"), "id", "value")
    drawn, e = spatial.shuffled(nodes, 9, 5), spark.createDataFrame([*edges, (4, 4, 2.0), (999, 1, 1.0)], "i long, j long, w double")
    sums = spatial._lags(e, drawn, 9)
    assert "zip_with" not in sums._jdf.queryExecution().optimizedPlan().toString()  # draws of an edge are not made rows
    listed = {r.id: r.lags for r in spatial._lags_of_repeats(e, drawn).collect()}
    assert {r.id: r.lags for r in sums.collect()} == {i: pytest.approx(lags) for i, lags in listed.items()}


def step_up(p):
    order = sorted(p, key=p.get)
    out, least = {}, 1.0
    for rank in range(len(order), 0, -1):
        i = order[rank - 1]
        ties = sum(v <= p[i] for v in p.values())
        least = min(least, p[i] * len(order) / ties)
        out[i] = least
    return out


def test_adjusted_p_values(spark):
    rng = random.Random(1)
    p = {i: rng.random() ** 3 for i in range(400)} | {i: 0.25 for i in range(400, 600)} | {700: 1.0, 701: 0.0}
    df = spark.createDataFrame([*p.items(), (800, None)], "id long, p double")
    got = {r.id: r.p_adjusted for r in spatial.benjamini_hochberg(df, "p", "id").collect()}
    assert got.pop(800) is None
    assert got == {i: pytest.approx(v) for i, v in step_up(p).items()}


def test_edges_of_nothing(spark):
    e, v = spark.createDataFrame([], "i long, j long, w double"), spark.createDataFrame([(1, 2.0), (2, 3.0)], "id long, value double")
    row = spatial.global_moran(e, v, permutations=3).first()
    assert (row.n, row.moran_i, row.p_value) == (2, None, None)
    assert {r.quadrant for r in spatial.local_moran(e, v, permutations=3).collect()} == {None}


def test_similarity_of_neighbours(spark):
    rng = random.Random(2)
    vectors = [(i, [rng.gauss(0, 1) for _ in range(4)]) for i in range(20)] + [(20, [0.0] * 4)]
    edges = [(i, (i * 7 + 1) % 21) for i in range(21)]

    def cos(a, b):
        norm = math.hypot(*a) * math.hypot(*b)
        return sum(x * y for x, y in zip(a, b, strict=True)) / norm if norm else 0.0

    v = dict(vectors)
    pairs = [cos(v[a], v[b]) for a in v for b in v if a < b]
    row = spatial.neighbour_similarity(spark.createDataFrame(edges, "i long, j long"), spark.createDataFrame([*vectors, (30, None)], "id long, vector array<double>")).first()
    assert (row.n_edges, row.n_pairs) == (21, len(pairs))
    assert row.neighbour_mean == pytest.approx(sum(cos(v[a], v[b]) for a, b in edges) / 21)
    assert row.global_mean == pytest.approx(sum(pairs) / len(pairs))


def test_no_product_of_points(spark):
    df = spark.range(50).select("id", F.rand(1).alias("x"), F.rand(2).alias("y"))
    plan = spatial.nearest_neighbours(df, 2)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
