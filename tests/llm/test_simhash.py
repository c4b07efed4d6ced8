import random

import numpy as np
import pytest
import xxhash
from helpers import components, docs_of, prose
from pyspark.sql import functions as F

from affinis.llm import simhash
from affinis.llm.scratch import Scratch
from affinis.operators import joins


def plain_fingerprint(text):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()]
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", [None, "", " \n", "One", "one TWO", "a b c", "a b a b a b a b", "Ä Ö ä\x0bö x y", "x " * 5_000, "a\x1cb c d"])
def test_fingerprints(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def near_texts(rng, groups, copies, words=40):
    out = []
    for _ in range(groups):
        base = prose(rng, words).split()
        for _ in range(rng.randrange(1, copies + 1)):
            own = list(base)
            for _ in range(rng.randrange(3)):
                own[rng.randrange(len(own))] = prose(rng, 1)
            out.append(" ".join(own))
    return out


def test_components_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 4)  # buckets are met in blocks
    rng = random.Random(1)
    texts = near_texts(rng, 60, 8, 200) + ["", None, " ", "A b", "a B", "the", "the an"] + [prose(rng, 2) for _ in range(50)]
    rng.shuffle(texts)
    got = {r.doc_id: r for r in simhash.components(docs_of(spark, texts).repartition(5)).collect()}
    want = components(texts)
    assert [got[i].component_id for i in range(len(texts))] == want
    assert [got[i].fingerprint for i in range(len(texts))] == [f"{plain_fingerprint(t):016x}" for t in texts]
    assert len(set(want)) < len(texts) - 60


@pytest.mark.parametrize("seed", [1, 2])
def test_no_link_is_lost(spark, seed):
    rng = random.Random(seed)
    prints = [rng.getrandbits(64) for _ in range(60)]
    for p in list(prints):
        flipped = p
        for b in rng.sample(range(64), rng.randrange(1, 5)):
            flipped ^= 1 << b
        prints.append(flipped)
    signed = sorted({p - (1 << 64) if p >> 63 else p for p in prints})
    scratch = Scratch(spark, "links-test")
    found = simhash.links(spark.createDataFrame([(p,) for p in signed], "print long"), scratch).collect()
    near = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 3}
    assert {(min(r.a, r.b), max(r.a, r.b)) for r in found} == near  # pairs here, so the forest is all links
    hooked = {r.node: r.least for r in simhash.smallest_reachable(spark.createDataFrame([(r.a, r.b) for r in found], "a long, b long"), scratch).collect()}
    assert all(hooked[max(p)] == min(p) for p in near)


def test_thresholds_keep_the_principle():
    rng = np.random.default_rng(1)
    for total in (10, 10**5, 10**10):
        plan = simhash.plan_probes(rng.integers(0, 1 << 63, 500).astype(np.uint64), total)
        bits = [b for g, _ in plan for b in g]
        assert len(bits) == len(set(bits))
        # Any three flipped bits leave some group within its threshold.
        for flips in [rng.choice(64, 3, replace=False) for _ in range(300)]:
            assert any(len(set(flips) & set(g)) <= t for g, t in plan)


def test_longest_chain(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101)]
    found = {r.node: r.least for r in simhash.smallest_reachable(spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "chain")).collect()}
    assert found == {i: 0 for i in range(1, 61)} | {101: 100}


def test_nulls_repeats_and_empty(spark):
    docs = spark.createDataFrame([(None, "a b c d"), (5, "a b c d"), (5, "a b c d"), (None, None)], "doc_id long, text string").withColumn("print", F.lit(1))
    got = simhash.components(docs).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in got) == [(0, 0), (0, 5), (5, 5), (5, 5)]
    assert simhash.components(docs.limit(0)).count() == 0
    left = simhash.one_of_each(docs)
    assert left.columns == docs.columns and sorted(r.doc_id or 0 for r in left.collect()) == [0, 0, 5]


def test_rows_that_share_an_id(spark):
    """Of one id, every component keeps a row; near copies of one id keep one."""
    rng = random.Random(7)
    first, second = prose(rng, 60), prose(rng, 60)
    rows = [(5, first, "a"), (5, second, "b"), (5, second, "b"), (6, first, "c"), (9, prose(rng, 60), "d"), (9, "", "e"), (10, None, "f")]
    docs = spark.createDataFrame(rows, "doc_id int, text string, print string")
    left = simhash.one_of_each(docs)
    assert left.columns == docs.columns
    assert sorted(tuple(r) for r in left.collect()) == sorted([rows[0], rows[1], rows[4], rows[5]])


def test_hub_is_spread(spark, monkeypatch):
    monkeypatch.setattr(joins, "ROWS_PER_SALT", 5)
    edges = [(0, i) for i in range(1, 60)] + [(i, 99) for i in range(70, 98)]
    found = {r.node: r.least for r in simhash.smallest_reachable(spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "hub")).collect()}
    assert found == dict.fromkeys(range(1, 60), 0) | dict.fromkeys([*range(71, 98), 99], 70)
    texts = [prose(random.Random(1), 50)] * 40 + [prose(random.Random(2), 50)] * 30
    got = simhash.components(docs_of(spark, texts)).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == [(i, 0 if i < 40 else 40) for i in range(70)]
