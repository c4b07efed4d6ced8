import random

import pytest
from helpers import contained, docs_of, prose
from pyspark.sql import functions as F

from affinis.llm import decontaminate as dec


def test_against_brute_force(spark):
    rng = random.Random(1)
    items = [prose(rng, rng.randrange(3, 60)) for _ in range(25)]
    texts = [prose(rng, rng.randrange(0, 200)) for _ in range(60)]
    for n in range(40):  # whole, cut and altered items in longer texts
        words = rng.choice(items).split()
        words = words[: max(1, int(len(words) * rng.choice((1, 1, 0.85, 0.6))))]
        if words and rng.random() < 0.3:
            words[rng.randrange(len(words))] = "changed"
        texts.append(f"{prose(rng, rng.randrange(300))} {' '.join(words).upper()}! {prose(rng, rng.randrange(300))}")
    texts += ["", None, items[7], items[7]]
    items += [items[3], "", None]
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in dec.contained_items(docs_of(spark, texts).repartition(5), benchmark).collect()}
    want = {(d, i) for d, t in enumerate(texts) for i, item in enumerate(items) if contained(t, item)}
    assert got == want and len(want) > 20


def test_very_long_text_and_repeated_rows(spark):
    rng = random.Random(2)
    item = prose(rng, 40)
    long = f"{prose(rng, 60_000)} {item} {prose(rng, 60_000)}"
    docs = spark.createDataFrame([(1, long), (1, long), (None, long)], "doc_id long, text string")
    found = dec.contained_items(docs, spark.createDataFrame([(5, item)], "item_id long, text string")).collect()
    assert sorted((r.doc_id or -1, r.item_id, r.n_shared == r.n_item, r.containment) for r in found) == [(-1, 5, True, 1.0), (1, 5, True, 1.0), (1, 5, True, 1.0)]


@pytest.mark.parametrize("side", ["docs", "items", "both"])
def test_empty_tables(spark, side):
    docs, items = docs_of(spark, ["a b c d e f"]), spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    docs = docs.limit(0) if side != "items" else docs
    items = items.limit(0) if side != "docs" else items
    assert dec.contained_items(docs, items).count() == 0
    assert dec.without_items(docs, items).count() == docs.count()


def test_without_items_keeps_clean_rows_and_all_columns(spark):
    rng = random.Random(3)
    item = prose(rng, 30)
    docs = docs_of(spark, [prose(rng, 50), f"x {item} y", None, "", prose(rng, 50)])
    docs = docs.withColumn("hits", F.lit(1)).withColumn("__key2", F.lit("k")).withColumn("doc_at", F.lit(2)).withColumn("item_text", F.lit("z"))
    left = dec.without_items(docs, spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == [0, 2, 3, 4]


def test_sketch_holds_more_than_what_may_be_missing():
    for n in range(1, 3_000):
        assert dec.sketch_size(n, 0.8) > n - 0.8 * n - 1e-9
