import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from affinis.functions import vectors as V
from affinis.operators import joins
from affinis.operators import similarity as sim
from affinis.operators import topk
from affinis.operators import vocabulary as voc

TEXTS = ["a b c", "a a b", "d e", None, "", "c d d d", "a b c", "e e", "x", "b c d", "q r s t", "a q"]


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "id int, text string")


@pytest.fixture(scope="module")
def vectors(corpus):
    return voc.term_vectors(corpus, "id", "text", stemming=False).cache()


def counts(text):
    return Counter((text or "").split())


def brute(metric, a, b):
    u, v = counts(a), counts(b)
    keys = u | v
    if metric == sim.COSINE:
        norms = math.sqrt(sum(x * x for x in u.values()) * sum(x * x for x in v.values()))
        return sum(u[k] * v[k] for k in keys) / norms if norms else 0.0
    if metric == sim.EUCLIDEAN:
        return math.sqrt(sum((u[k] - v[k]) ** 2 for k in keys))
    return float(sum(abs(u[k] - v[k]) for k in keys))


# -- vocabulary -----------------------------------------------------------------


def test_counts_keep_empty_texts(corpus, vectors):
    assert vectors.count() == len(TEXTS)
    got = {r["id"]: {t["token"]: t["cnt"] for t in r["terms"]} for r in vectors.collect()}
    assert got == {i: dict(counts(t)) for i, t in enumerate(TEXTS)}
    sizes = {r["id"]: (r["sq"], r["l1"]) for r in vectors.collect()}
    assert sizes[5] == (10, 4) and sizes[3] == (0, 0)


def test_vocabulary(corpus):
    tokens = voc.token_counts(corpus, "id", "text")
    got = [r.asDict() for r in voc.fit_vocabulary(tokens).orderBy("idx").collect()]
    total = sum((counts(t) for t in TEXTS), Counter())
    assert [r["token"] for r in got] == sorted(total) and [r["idx"] for r in got] == list(range(len(total)))
    assert {r["token"]: r["tf"] for r in got} == dict(total)
    holders = sum((Counter(set(counts(t))) for t in TEXTS), Counter())
    within = [t for t in total if 2 <= holders[t] <= 0.34 * len(TEXTS)]
    frequent = sorted(within, key=lambda t: (-total[t], t))[:2]
    few = voc.fit_vocabulary(tokens, min_df=2, max_df=0.34, max_features=2)
    assert [r["token"] for r in few.orderBy("idx").collect()] == sorted(frequent)
    with pytest.raises(ValueError):
        voc.require_tokens(voc.fit_vocabulary(tokens, min_df=99))


@pytest.mark.parametrize("per_salt", [2, 100_000])
def test_lookups_with_a_heavy_key(spark, monkeypatch, per_salt):
    monkeypatch.setattr(joins, "ROWS_PER_SALT", per_salt)
    monkeypatch.setattr(joins, "MOST_HEAVY", 2)
    monkeypatch.setattr("affinis.session.BROADCAST_ROWS", 0)  # no table is small
    rows = spark.range(300).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 7).alias("k"))
    table = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n")).withColumn("name", F.concat(F.lit("k"), "k"))
    expected = sorted(rows.join(table, "k").select("id", "name").collect())
    assert sorted(joins.weighted_lookup(rows, table, ["k"], "n", "id").select("id", "name").collect()) == expected
    some = table.filter("k <> 0").select("k", "name")
    got = joins.salted_lookup(rows, some, ["k"], "id", "left")
    assert got.count() == 300 and got.filter("name IS NULL").count() == rows.filter("k = 0").count()


def test_lookups_by_counted_rows(spark, monkeypatch):
    """More rows than the session's partitions are meant for: more tasks, the same rows."""
    rows = spark.range(300).select("id", (F.col("id") % 50).alias("k"))
    table = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n")).withColumn("name", F.concat(F.lit("k"), "k"))
    monkeypatch.setattr(joins, "LOOKUP_ROWS", 15, raising=False)
    found = joins.weighted_lookup(rows, table, ["k"], "n", "id")
    assert _spread(found) > 4  # the session's setting
    assert sorted(found.select("id", "name").collect()) == sorted(rows.join(table, "k").select("id", "name").collect())


def test_frozen_vocabulary(spark):
    fit = spark.createDataFrame([(1, "upland ua"), (2, "lowland ub")], "id int, text string")
    vocabulary = voc.fit_vocabulary(voc.token_counts(fit, "id", "text"))
    asked = spark.createDataFrame([(1, "upland mg"), (2, "mg"), (3, None)], "id int, text string")
    got = {r["id"]: r["l1"] for r in voc.term_vectors(asked, "id", "text", False, vocabulary).collect()}
    assert got == {1: 1, 2: 0, 3: 0}


def test_large_frozen_vocabulary_is_not_sorted(spark, monkeypatch):
    """Texts that ask for few tokens of a large vocabulary: it is read, but neither moved nor sorted; entities without a known token stay."""
    vocabulary = spark.range(500).select(F.concat(F.lit("w"), "id").alias("token"), F.col("id").alias("idx"))
    asked = spark.createDataFrame([(1, "w1 w1 w499"), (2, "none"), (3, None), (None, "w7")], "id int, text string")
    monkeypatch.setattr("affinis.session.BROADCAST_ROWS", 20)  # the vocabulary isn't small, what is asked for is
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        vectors = voc.term_vectors(asked, "id", "text", False, vocabulary)
        terms = voc.indexed_terms(vectors, vocabulary, "id")
        for df in (vectors, terms):
            assert "SortMergeJoin" not in df._jdf.queryExecution().executedPlan().toString()
        assert {r["id"]: r["l1"] for r in vectors.collect()} == {1: 3, 2: 0, 3: 0, None: 1}
        assert {tuple(r) for r in terms.collect()} == {(1, 1, "w1", 2), (1, 499, "w499", 1), (None, 7, "w7", 1)}
        many = spark.range(40).select(F.col("id").cast("int").alias("id"), F.concat(F.lit("w"), "id").alias("text"))
        assert voc.term_vectors(many, "id", "text", False, vocabulary).agg(F.sum("l1")).first()[0] == 40  # asks for more than is small
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_stemmed_counts_join_variants(spark):
    df = spark.createDataFrame([(1, "caprinos caprino alta_caprinos"), (2, "Caprinos")], "id int, text string")
    got = {(r["id"], r["token"]): r["cnt"] for r in voc.text_counts(df, "id", "text").collect()}
    assert got == {(1, "caprin"): 2, (1, "alta_caprinos"): 1, (2, "caprin"): 1}


def test_density(corpus):
    row = voc.density(voc.token_counts(corpus, "id", "text"), "id").first()
    nonzero = sum(len(counts(t)) for t in TEXTS)
    assert (row["n_entities"], row["n_tokens"], row["n_nonzero"]) == (12, 10, nonzero)
    assert row["density"] == pytest.approx(nonzero / 120)


def test_text_shuffles_once(corpus):
    """Counts and vectors of a text are made where its one shuffle put it."""
    texts = corpus.select("id", F.upper("text").alias("text"))
    plan = voc.term_vectors(texts, "id", "text", False)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


# -- pairs ------------------------------------------------------------------------


@pytest.mark.parametrize("few", [True, False])
@pytest.mark.parametrize("metric", sim.METRICS)
@pytest.mark.parametrize("k", [1, 4, 20])
def test_nearest(spark, vectors, metric, k, few, monkeypatch):
    monkeypatch.setattr(sim, "fits_broadcast", lambda df, *a: few)
    queries = vectors.withColumnRenamed("id", "query_id").filter("l1 > 0")
    got = {(r["query_id"], r["rank"]): (r["id"], r["score"]) for r in
           sim.nearest(queries, vectors, k, "query_id", "id", metric, exclude_self=True).collect()}
    sign = -1 if metric == sim.COSINE else 1
    for q, text in enumerate(TEXTS):
        if not counts(text):
            continue
        scored = sorted((sign * brute(metric, text, t), i) for i, t in enumerate(TEXTS) if i != q)[:k]
        for rank, (score, entity) in enumerate(scored, 1):
            assert got[q, rank] == (entity, pytest.approx(sign * score))


@pytest.mark.parametrize("k", [1, 3, 20])
def test_nearest_in_other_groups(spark, vectors, k):
    groups = ["x", "x", "y", "y", "x", "x", "x", "z", "x", "x", None, "x"]
    frame = spark.createDataFrame(list(enumerate(groups)), "id int, g string")
    grouped = vectors.join(frame, "id").cache()
    queries = grouped.withColumnRenamed("id", "query_id")
    got = {(r["query_id"], r["rank"]): r["id"] for r in
           sim.nearest(queries, grouped, k, "query_id", "id", exclude_self=True, group="g").collect()}
    for q, text in enumerate(TEXTS):
        open_to = [i for i in range(len(TEXTS)) if i != q and (groups[i] is None or groups[i] != groups[q])]
        best = sorted((-brute(sim.COSINE, text, TEXTS[i]), i) for i in open_to)[:k]
        assert [got[q, rank] for rank in range(1, len(best) + 1)] == [i for _, i in best]
        assert (q, len(best) + 1) not in got


@pytest.mark.parametrize("min_score", [0.05, 0.3, 0.5, 0.8, 1.0])
def test_similar_profiles(spark, min_score, monkeypatch):
    monkeypatch.setattr(sim, "HOT_TOKEN_ROWS", 3)  # several salts per token
    monkeypatch.setattr(joins, "ROWS_PER_SALT", 4)
    texts = [" ".join(f"t{(i * p) % m}" for p, m in ((1, 5), (3, 7), (5, 11), (7, 13), (2, 4))) + " common" for i in range(60)]
    texts += texts[:10]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    vectors = voc.term_vectors(df, "id", "text", stemming=False).cache()
    profiles = sim.distinct_profiles(vectors, "id").cache()
    distinct = {r["profile"]: r["n_members"] for r in profiles.collect()}
    assert sum(distinct.values()) == 70 and sim.profile_members(vectors, profiles, "id").count() == 70
    got = {(r["left_id"], r["right_id"]): r["score"] for r in sim.similar_profiles(profiles, min_score).collect()}
    expected = {
        (a, b): s
        for a in distinct for b in distinct if a < b
        for s in [brute(sim.COSINE, texts[a], texts[b])] if s >= min_score
    }
    assert got == pytest.approx(expected)


def test_square_scores(spark, vectors):
    ids = spark.createDataFrame([(0,), (2,), (5,)], "id int")
    got = {(r["left_id"], r["right_id"]): r["score"] for r in sim.square_scores(vectors, ids, "id").collect()}
    assert got == pytest.approx({(a, b): brute(sim.COSINE, TEXTS[a], TEXTS[b]) for a in (0, 2, 5) for b in (0, 2, 5)})


# -- dense ------------------------------------------------------------------------


@pytest.fixture(scope="module")
def dense(spark):
    rows = [(i, [float((i * 7) % 5), float((i * 3) % 4) - 1.0, float(i % 3)]) for i in range(40)]
    return spark.createDataFrame(rows, "id int, v array<double>")


@pytest.mark.parametrize("block", [1000, 3])
@pytest.mark.parametrize("metric", sim.METRICS)
def test_dense_nearest(dense, metric, block, monkeypatch):
    monkeypatch.setattr(sim, "DENSE_QUERY_BLOCK", block)
    monkeypatch.setattr(sim, "DENSE_SLICE", 15)
    queries = dense.filter("id < 8").withColumnRenamed("id", "query_id")
    got = {(r["query_id"], r["rank"]): (r["id"], r["score"]) for r in
           sim.dense_nearest(queries, dense, 4, "query_id", "id", "v", metric).collect()}
    rows = {r["id"]: r["v"] for r in dense.collect()}

    def score(a, b):
        if metric == sim.COSINE:
            n = math.hypot(*a) * math.hypot(*b)
            return sum(x * y for x, y in zip(a, b, strict=True)) / n if n else 0.0
        if metric == sim.EUCLIDEAN:
            return math.dist(a, b)
        return sum(abs(x - y) for x, y in zip(a, b, strict=True))

    sign = -1 if metric == sim.COSINE else 1
    for q in range(8):
        best = sorted((round(sign * score(rows[q], v), 9), i) for i, v in rows.items())[:4]
        assert [got[q, r][0] for r in range(1, 5)] == [i for _, i in best]
        assert [got[q, r][1] for r in range(1, 5)] == pytest.approx([sign * s for s, _ in best], abs=1e-8)


def test_pair_metrics(spark):
    df = spark.createDataFrame([([0.0, 0.0, 1.0], [3.0, 4.0, 1.0])], "a array<double>, b array<double>")
    row = sim.pair_metrics(df, "a", "b").first()
    assert row["euclidean"] == 5.0 and row["manhattan"] == 7.0
    assert row["cosine"] == pytest.approx(1 / math.sqrt(26))


@pytest.mark.parametrize(("a", "b"), [([0.0, 0.0], [1.0, 2.0]), ([1.0], [1.0, 2.0])])
def test_pair_errors(spark, a, b):
    df = spark.createDataFrame([(a, b)], "a array<double>, b array<double>")
    assert sim.pair_metrics(df, "a", "b").first()["cosine"] is None
    with pytest.raises(Exception, match="zero vector|different length"):
        sim.pair_metrics(df, "a", "b", strict=True).collect()


def test_ml_vectors(spark):
    df = spark.createDataFrame([([1.0, 0.0, 2.0],)], "a array<double>")
    assert df.select(V.vector_to_array(V.array_to_vector(F.col("a")))).first()[0] == [1.0, 0.0, 2.0]


# -- top-k ------------------------------------------------------------------------


def test_top_k(spark):
    values = [(i * 37) % 101 / 8 for i in range(23)]
    best = sorted(range(23), key=lambda i: -values[i])
    df = spark.createDataFrame(list(enumerate(values)), "id int, score double")
    assert [r["id"] for r in topk.top_k_largest(df, 4).orderBy("rank").collect()] == best[:4]
    without = topk.top_k_largest(df, 4, exclude=F.col("id") == best[1])
    assert [r["id"] for r in without.orderBy("rank").collect()] == [best[0], *best[2:5]]
    assert topk.top_k_largest(df, 50).count() == 23
    near = df.withColumnRenamed("score", "distance")
    assert [r["id"] for r in topk.top_k_smallest(near, 3).orderBy("rank").collect()] == best[::-1][:3]
    with pytest.raises(ValueError):
        topk.top_k_largest(df, 0)


def test_top_k_of_a_large_k_is_cut_in_parts(spark):
    df = spark.range(9_000).select((F.col("id") % 2).alias("g"), "id", F.pmod(F.xxhash64("id"), F.lit(50)).alias("score"))
    got = topk.top_k(df, 1_500, "score", ["id"], ["g"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "__part" in plan
    rows = df.collect()
    for g in (0, 1):
        want = sorted((-r["score"], r["id"]) for r in rows if r["g"] == g)[:1_500]
        assert [(-r["score"], r["id"]) for r in got.filter(F.col("g") == g).orderBy("rank").collect()] == want


def test_ties_go_by_id(spark):
    df = spark.createDataFrame([(3, 1.0), (1, 1.0), (2, 1.0)], "id int, score double")
    assert [r["id"] for r in topk.top_k_largest(df, 2).orderBy("rank").collect()] == [1, 2]


def test_grouped_top_k_limits_before_the_shuffle(spark):
    df = spark.range(100).withColumn("g", F.col("id") % 3)
    plan = topk.top_k(df, 2, "id", ["id"], ["g"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit") < plan.rindex("WindowGroupLimit")
    assert plan.rindex("WindowGroupLimit") > plan.index("Exchange")


def test_sample_is_stable(spark):
    one = topk.seeded_sample(spark.range(100, numPartitions=1), 3, "id").collect()
    assert sorted(one) == sorted(topk.seeded_sample(spark.range(100, numPartitions=9), 3, "id").collect())


def _spread(df):
    """In how many tasks the rows are made; small shuffles without a number of their own are made in one."""
    return df.select(F.spark_partition_id().alias("p")).distinct().count()


def test_tasks_by_size(spark, monkeypatch):
    """Counted tokens and pairs of a task don't grow with the table; rows of one id and of none are still counted together."""
    rows = [(i, f"a b w{i}") for i in range(200)] + [(0, "a c"), (None, "a"), (None, "a")]
    df = spark.createDataFrame(rows, "id long, text string")
    monkeypatch.setattr(voc, "TASK_LETTERS", 100, raising=False)
    counts = voc.token_counts(df, "id", "text")
    assert _spread(counts) >= 8
    assert {(r["id"], r["cnt"]) for r in counts.filter("token = 'a'").collect()} == {(0, 2), (None, 2)} | {(i, 1) for i in range(1, 200)}
    monkeypatch.setattr(sim, "TASK_PAIRS", 100, raising=False)
    vectors = voc.term_vectors(df.filter("id > 0"), "id", "text", stemming=False).cache()
    asked = vectors.filter("id < 5").withColumnRenamed("id", "query_id")
    pairs = sim.scored_pairs(asked, vectors, "query_id", "id")
    assert _spread(pairs) >= 6 and pairs.count() == 4 * 199
