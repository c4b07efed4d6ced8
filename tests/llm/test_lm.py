import math
import random
from collections import Counter

import numpy as np
import pytest
from helpers import docs_of, prose

from affinis.llm import lm, queries  # noqa: F401
from affinis.llm.decontaminate import WORD
from affinis.llm.registry import REGISTRY


def brute(texts, order, least=2, backoff=0.4):
    words = [WORD.findall((t or "").lower()) for t in texts]
    counts = [Counter(tuple(w[i : i + n]) for w in words for i in range(len(w) - n + 1)) for n in range(1, order + 1)]
    everything = sum(counts[0].values())

    def score(gram):
        if len(gram) == 1:
            return math.log(counts[0][gram] / everything), 0
        if counts[len(gram) - 1][gram] >= least:
            return math.log(counts[len(gram) - 1][gram] / counts[len(gram) - 2][gram[:-1]]), 1
        value, seen = score(gram[1:])
        return math.log(backoff) + value, seen

    out = []
    for w in words:
        found = [score(tuple(w[max(0, i - order + 1) : i + 1])) for i in range(len(w))]
        out.append((len(w), sum(s for _, s in found), sum(v for v, _ in found)))
    return out


@pytest.mark.parametrize("order", [1, 2, 3])
def test_against_brute_force(spark, monkeypatch, order):
    rng = random.Random(order)
    texts = [prose(rng, rng.randrange(0, 80)) for _ in range(60)] + ["", None, " .,! ", "One one ONE one", "Ä ö 日本", prose(rng, 5_000)]
    texts += texts[:5]
    monkeypatch.setattr(lm, "STRETCH_BYTES", 2_000)
    monkeypatch.setattr(lm, "TABLE_BYTES", 3_000)
    got = {r.doc_id: r for r in lm.scored(docs_of(spark, texts).repartition(3), order=order).collect()}
    for i, (n, seen, score) in enumerate(brute(texts, order)):
        assert (got[i].n_words, got[i].n_seen) == (n, seen)
        assert got[i].log_score == pytest.approx(score, abs=1e-6)


def test_empty_table_and_null_ids(spark):
    docs = docs_of(spark, ["a b"])
    assert lm.scored(docs.limit(0)).count() == 0
    rows = lm.scored(spark.createDataFrame([(None, "a b", 1), (None, None, 2)], "doc_id long, text string, n_words int")).collect()
    assert sorted((r.doc_id, r.n_words) for r in rows) == [(None, 0), (None, 2)]


def test_registered_with_trigrams(spark, tmp_path):
    texts = ["a b c a b c a b d", "x b c", "b c", "a", None]
    docs_of(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.n_words, r.n_seen, r.log_score) for r in REGISTRY["op5_lm_score_trigrams"].run(spark, str(tmp_path)).collect()}
    for i, (n, seen, score) in enumerate(brute(texts, 3)):
        assert got[i] == (n, seen, pytest.approx(score, abs=1e-3))


@pytest.mark.parametrize("size", [0, 1, 5_000])
def test_packed_grams(size):
    grams = np.unique(np.random.default_rng(size).integers(0, 1 << 64, size, np.uint64))
    assert np.array_equal(lm.unpacked_grams(lm.packed_grams(grams), len(grams)), grams)
