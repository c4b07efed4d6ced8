import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from affinis.llm import vector_codes as vc

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows):
    """Rows (vec_id, vector, label) in plain Python: (vec_id, label, code, error, label_error, digest), sorted."""
    kept = [(i, [math.floor(1024 * x) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    width = -(-max(len(v) for _, v, _ in kept) // 4) * 4
    kept = sorted([(i, v + [0] * (width - len(v)), label) for i, v, label in kept], key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    w = width // 4
    cut = [[v[p * w : (p + 1) * w] for p in range(4)] for _, v, _ in kept]
    books = [[parts[p] for parts in cut[:256]] for p in range(4)]

    def nearest(part, book):
        return min((sum((x - y) ** 2 for x, y in zip(part, e, strict=True)), k) for k, e in enumerate(book))

    for _ in range(4):
        for p in range(4):
            groups = {}
            for parts in cut:
                groups.setdefault(nearest(parts[p], books[p])[1], []).append(parts[p])
            books[p] = [[sum(c) // len(groups[k]) for c in zip(*groups[k], strict=True)] if k in groups else e for k, e in enumerate(books[p])]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    found = [[nearest(parts[p], books[p]) for p in range(4)] for parts in cut]
    errors = [sum(f[0] for f in each) for each in found]
    labels = {}
    for (_, _, label), error in zip(kept, errors, strict=True):
        labels[label] = labels.get(label, 0) + error
    top = vc.LARGEST
    out = [(i, label, "".join(f"{f[1]:02x}" for f in each), min(e, top), min(labels[label], top), digest) for (i, _, label), each, e in zip(kept, found, errors, strict=True)]
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("vec_id", "label", "code", "error", "label_error", "codebooks_sha256").collect()), key=repr)


@pytest.mark.parametrize(("n", "width", "spread"), [(400, 8, 0.1), (300, 64, 0.2), (30, 8, 1.0), (290, 6, 40.0)])
def test_against_brute_force(spark, n, width, spread):
    rng = random.Random(n)
    rows = [(i, [rng.gauss(0, spread) for _ in range(width)], rng.choice([0, 1, None])) for i in range(n)]
    rows += [(n + i, rows[i % 5][1], 7) for i in range(40)]  # a group of copies
    rng.shuffle(rows)
    assert got(vc.coded(spark.createDataFrame(rows, SCHEMA).repartition(5))) == brute(rows)


def test_edge_cases(spark):
    rows = [(1, [0.5, 1.0], 1), (1, [0.5, 1.0], 1), (1, [-0.25, 0.0], 1), (None, [3.0] * 5, None), (2, None, 1), (3, [None, 1.0], 1), (4, [math.nan], 1), (5, [math.inf], 2), (6, [], None)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(vc.coded(df.withColumn("code", F.lit("x")).withColumn("group", F.lit(1)))) == brute(rows)
    assert vc.coded(df.limit(0)).count() == 0 and vc.coded(df.filter("vec_id = 2")).count() == 0
    assert got(vc.coded(df.filter("vec_id = 6"))) == brute(rows[-1:])


@pytest.mark.parametrize("large", [1e5, 1e8, 1e12])
def test_large_components(spark, large):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 1) * (large if i % 7 == 0 else 1) for _ in range(8)], i % 2) for i in range(280)]
    assert got(vc.coded(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


@pytest.mark.parametrize("step", [1, 16, 64, 256, 4096])
def test_every_step_finds_the_nearest(step):
    rng = np.random.default_rng(step)
    entries = rng.integers(-200, 200, (256, 16))
    entries[40] = entries[7]  # a tie
    parts = np.concatenate([rng.integers(-220, 220, (500, 16)), entries[[7, 40, 3]], entries[:5] * 3])
    far = ((parts[:, None] - entries[None]) ** 2).sum(axis=2)
    grid = vc.Grid(entries, step)
    for _ in range(2):  # from an empty memo, then from the memo
        best, error = grid.nearest(parts)
        assert (best == far.argmin(axis=1)).all() and (error == far.min(axis=1)).all()


def test_cells_leave_few_entries_of_clustered_parts():
    rng = np.random.default_rng(1)
    entries = rng.integers(-4000, 4000, (256, 16))
    parts = entries[rng.integers(0, 20, 9000)] + rng.integers(-2, 3, (9000, 16))
    step = vc.cheapest_step(entries, parts[:8000])
    grid = vc.Grid(entries, step)
    best, _ = grid.nearest(parts)
    assert (best == ((parts[:, None] - entries[None]) ** 2).sum(axis=2).argmin(axis=1)).all()
    assert len(grid.known) < 300 and np.mean([len(c) for _, c in grid.known.values()]) < 128


def test_cells_with_one_hash(monkeypatch):
    monkeypatch.setattr(vc, "mix", lambda keys: keys * np.uint64(0))
    rng = np.random.default_rng(2)
    entries, parts = rng.integers(-90, 90, (50, 4)), rng.integers(-90, 90, (300, 4))
    best, _ = vc.Grid(entries, 16).nearest(parts)
    assert (best == ((parts[:, None] - entries[None]) ** 2).sum(axis=2).argmin(axis=1)).all()
