import random

import pytest
from helpers import docs_of, prose, without_repeats

from affinis.llm import substring
from affinis.operators import joins


def check(spark, texts, window=35):
    got = {r.row.doc_id: (r.n_words, r.n_removed, r.kept) for r in substring.without_repeats(docs_of(spark, texts).repartition(4), window).collect()}
    assert [got[i] for i in range(len(texts))] == without_repeats(texts, window)
    return sum(g[1] for g in got.values())


def test_planted_passages(spark):
    rng = random.Random(1)
    passages = [prose(rng, n) for n in (34, 35, 36, 50, 60, 120)]
    texts = []
    for _ in range(60):
        parts = [prose(rng, rng.randrange(0, 70)) for _ in range(3)]
        parts.insert(rng.randrange(4), rng.choice(passages))
        texts.append(rng.choice((" ", "\n", "\t ")).join(parts))
    texts += [None, "", " ", passages[2], passages[2], prose(rng, 30) + " " + passages[3] + " " + passages[3]]
    assert check(spark, texts) > 500


def test_near_copies_and_shared_edges(spark):
    rng = random.Random(2)
    base = prose(rng, 300).split()
    texts = []
    for _ in range(25):
        words = list(base)
        for _ in range(rng.randrange(1, 12)):
            words[rng.randrange(300)] = "other" + str(rng.randrange(1000))
        texts.append(" ".join(words[rng.randrange(20) : 300 - rng.randrange(20)]))
    check(spark, texts)


def test_runs_and_periods(spark):
    rng = random.Random(3)
    texts = ["a " * n for n in (10, 34, 35, 36, 80)] + ["a b " * 40, "b a " * 17 + "c", "x y z " * 30, "q " * 20 + prose(rng, 40)]
    texts += [" ".join(rng.choice("ab") for _ in range(120)) for _ in range(12)]
    texts += [" ".join(rng.choice(("a", "a", "a", "b")) for _ in range(400)) for _ in range(6)]
    check(spark, texts)


def test_very_long_text(spark):
    rng = random.Random(4)
    shared = prose(rng, 200)
    check(spark, [f"{prose(rng, 40_000)} {shared} {prose(rng, 40_000)}", shared, prose(rng, 100)])


def test_repeated_rows_nulls_and_clashing_columns(spark):
    rng = random.Random(5)
    text = prose(rng, 60)
    rows = [(None, text, "k", 1), (7, text, "k", 2), (7, text, "k", 2), (8, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string, row int")
    got = substring.without_repeats(docs).collect()
    assert sorted((r.row.doc_id or 0, r.n_words, r.n_removed, r.kept) for r in got) == [(0, 60, 60, ""), (7, 60, 60, ""), (7, 60, 60, ""), (8, 0, 0, "")]
    cut = substring.cleaned(docs)
    assert cut.columns == docs.columns and sorted((r.text is None, r.kept or "") for r in cut.collect()) == [(False, "k")] * 3 + [(True, "")]
    assert substring.without_repeats(docs.limit(0)).count() == 0


def test_cleaned_changes_only_what_repeats(spark):
    rng = random.Random(6)
    shared, alone = prose(rng, 50), "one\n two  three"
    docs = docs_of(spark, [f"start {shared} end", shared, alone])
    got = {r.doc_id: (r.text, r.n_chars) for r in substring.cleaned(docs).collect()}
    assert got == {0: ("start end", 9), 1: ("", 0), 2: (alone, len(alone))}


def test_equal_windows_take_equal_cuts():
    import pyarrow as pa

    rng = random.Random(7)
    shared = prose(rng, 400)
    texts = pa.array([f"{prose(rng, rng.randrange(90))} {shared} {prose(rng, 90)}" for _ in range(20)], pa.large_string())
    found = substring.Windows(texts, 0, len(texts))
    cuts = {}
    for h, c in zip(found.hash.tolist(), found.cut.tolist(), strict=True):
        assert cuts.setdefault(h, c) == c
    assert len(found.taken) < len(found.at) / 4


@pytest.mark.parametrize("window", [20, 35])
def test_other_windows(spark, window):
    rng = random.Random(window)
    shared = prose(rng, window)
    check(spark, [f"{prose(rng, 10)} {shared}", f"{shared} {prose(rng, 10)}", prose(rng, 80)], window)


def test_window_of_very_many_rows(spark, monkeypatch):
    """Its rows go to several tasks, and nothing is lost for that."""
    monkeypatch.setattr(joins, "ROWS_PER_SALT", 5)
    rng = random.Random(9)
    shared = prose(rng, 50)
    texts = [f"{prose(rng, 5)} {shared} {prose(rng, 5)}" for _ in range(60)] + [prose(rng, 60)]
    got = substring.without_repeats(docs_of(spark, texts)).collect()
    assert sorted((r.row.doc_id, r.n_words, r.n_removed, r.kept) for r in got) == [(i, *w) for i, w in enumerate(without_repeats(texts))]


def test_first_slice_without_text():
    """A fresh worker may meet empty texts first."""
    from affinis.llm import words

    words._powers.clear()
    assert len(words.powers(words.BASE, 0)) == 0
    long = words.powers(words.BASE, words.SLICE_BYTES + 200_000)
    assert len(long) == words.SLICE_BYTES + 200_000 and len(words._powers[words.BASE]) <= words.SLICE_BYTES + 65_536
