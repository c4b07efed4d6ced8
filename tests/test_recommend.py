import pytest
from crafts import PROFILES
from pyspark.sql import functions as F

from affinis.operators import lookup, recommend
from affinis.sources import landing

ID, NAME, GROUP = "id_municipio", "nome_municipio", "sigla_uf"


@pytest.fixture(scope="module")
def index(profiles):
    return recommend.ProfileIndex.build(profiles, stemming=False)


def ids(spark, *values):
    return spark.createDataFrame([(v,) for v in values], f"{ID} bigint")


def ranked(df):
    return [r[ID] for r in df.orderBy("query_id", "rank").collect()]


def cosine(a, b):
    a, b = set(a.split()), set(b.split())
    return len(a & b) / (len(a) * len(b)) ** 0.5


def expected(text, k, leave=lambda i, group: False):
    """Ids by brute force: the best scores first, equal ones by id."""
    scored = [(-round(cosine(text, t), 9), i) for i, _, g, t in PROFILES if not leave(i, g)]
    return [i for _, i in sorted(scored)[:k]]


def text_of(entity):
    return next(t for i, _, _, t in PROFILES if i == entity)


def test_index(index, profiles):
    assert index.vocabulary.count() == len({t for *_, text in PROFILES for t in text.split()})
    index.check()
    with pytest.raises(ValueError):
        recommend.ProfileIndex(profiles.limit(3), index.vectors).check()
    with pytest.raises(ValueError, match="tags"):
        recommend.ProfileIndex.build(profiles.drop("tags"))
    with pytest.raises(ValueError, match="vocabulary"):
        recommend.ProfileIndex.build(profiles.withColumn("tags", F.lit("")))


def test_saved_index(spark, index, tmp_path):
    landing.save_index(index, str(tmp_path / "index"))
    loaded = landing.load_index(spark, str(tmp_path / "index"), stemming=False)
    assert loaded.fitted is not None  # the saved vocabulary, not one fitted again
    assert sorted(loaded.vocabulary.collect()) == sorted(index.vocabulary.collect())
    assert ranked(loaded.by_entity(ids(spark, 8), 2)) == expected(text_of(8), 2, lambda i, g: i == 8)
    asked = spark.createDataFrame([(1, "coast unheard glass_few")], "query_id int, text string")
    assert ranked(loaded.by_text(asked, 3)) == ranked(index.by_text(asked, 3))
    with pytest.raises(FileNotFoundError):
        landing.load_index(spark, str(tmp_path / "none"))


@pytest.mark.parametrize("entity", [5, 14, 22, 37])
def test_by_entity(spark, index, entity):
    got = index.by_entity(ids(spark, entity), 7).orderBy("rank").collect()
    want = expected(text_of(entity), 7, lambda i, g: i == entity)
    assert [r[ID] for r in got] == want
    assert [r["score"] for r in got] == pytest.approx([cosine(text_of(entity), text_of(i)) for i in want], abs=1e-6)
    assert got[0]["tags"] == text_of(want[0])


def test_other_groups(spark, index):
    got = index.by_entity(ids(spark, 8), 6, other_groups_only=True)
    assert "QA" not in {r[GROUP] for r in got.collect()}
    assert ranked(got) == expected(text_of(8), 6, lambda i, g: g == "QA")


def test_by_name_and_code(spark, index):
    names = spark.createDataFrame([(1, " MONTE CLARO ", None), (2, "nobody", None)], "query_id int, name string, `group` string")
    assert ranked(index.by_name(names, 3)) == expected(text_of(21), 3, lambda i, g: i == 21)
    with pytest.raises(LookupError):
        index.by_name(names, 3, strict=True)
    codes = spark.createDataFrame([(7, "22"), (8, "x"), (9, "1")], "query_id int, code string")
    assert ranked(index.by_code(codes, 2)) == expected(text_of(22), 2, lambda i, g: i == 22)
    with pytest.raises(LookupError):
        index.by_code(codes, 2, strict=True)


def test_by_text(spark, index):
    asked = "plain glass_strong unheard"
    queries = spark.createDataFrame([(1, asked), (2, "nothing known"), (3, None)], "query_id int, text string")
    got = index.by_text(queries, 8).orderBy("rank").collect()
    assert [r[ID] for r in got] == expected("plain glass_strong", 8)
    assert [r["score"] for r in got] == pytest.approx([cosine("plain glass_strong", r["tags"]) for r in got], abs=1e-6)
    status = {r["query_id"]: r["status"] for r in index.text_status(queries).collect()}
    assert status == {1: "found", 2: "no_known_token", 3: "no_known_token"}
    with pytest.raises(ValueError, match="no token"):
        index.by_text(queries, strict=True)
    with pytest.raises(ValueError):
        index.by_text(queries, 0)


def test_explain(spark, index):
    left, right = text_of(8).split(), text_of(30).split()
    row = index.explain(spark.createDataFrame([(8, 30)], "left_id bigint, right_id bigint")).first()
    apart = len(set(left) ^ set(right))
    assert (row["cosine"], row["euclidean"], row["manhattan"]) == pytest.approx((cosine(text_of(8), text_of(30)), apart**0.5, apart))
    assert row["common"] == sorted(set(left) & set(right))
    assert (row["left_only"], row["right_only"]) == (sorted(set(left) - set(right)), sorted(set(right) - set(left)))


def test_explain_references(spark, index):
    schema = "query_id int, left_ref string, left_group string, right_ref string, right_group string"
    asked = spark.createDataFrame([(1, "faro velho", "qd", "8", None), (2, "nobody", None, "8", None), (3, None, None, "8", None)], schema)
    assert [(r["left_id"], r["right_id"]) for r in index.explain_references(asked, strict=False).collect()] == [(30, 8)]
    with pytest.raises(LookupError):
        index.explain_references(asked)


def test_near_twins(spark):
    """Many common tokens and one exclusive token on each side."""
    n = 12
    common = " ".join(f"t{i}" for i in range(n))
    rows = [(1, "a", "X", f"{common} only_a"), (2, "b", "Y", f"{common} only_b")]
    features = spark.createDataFrame(rows, f"{ID} bigint, {NAME} string, {GROUP} string, tags string")
    index = recommend.ProfileIndex.build(features, stemming=False)
    row = index.explain(spark.createDataFrame([(1, 2)], "left_id bigint, right_id bigint")).first()
    assert (row["cosine"], row["euclidean"], row["manhattan"]) == pytest.approx((n / (n + 1), 2**0.5, 2.0))


def test_listing(spark, index):
    row = recommend.shown(index.by_entity(ids(spark, 5), 1)).first()
    assert row["especializacao"] == "x" and row[NAME] == "Faro Novo"


# -- lookup -----------------------------------------------------------------------


def names(spark, *rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "query_id int, name string, `group` string")


def test_resolve_names(spark, profiles):
    asked = names(spark, ("lagoa", None), ("LAGÔA", None), ("faro velho", None), (" faro velho", "qd"), ("Vale do Ipe", None), (None, None))
    got = {r["query_id"]: r for r in lookup.resolve_names(asked, profiles, suggest=True).collect()}
    assert [got[i]["status"] for i in range(6)] == ["found", "found", "ambiguous", "found", "not_found", "not_found"]
    assert got[0][ID] == 9 and got[1][ID] == 14 and got[3][ID] == 30
    assert got[2]["groups"] == ["QA", "QD"] and got[2][ID] is None
    assert got[4]["suggestions"] == ["Vale do Ipê (QE)"]
    with pytest.raises(LookupError, match="ambiguous"):
        lookup.resolve_names(asked, profiles, strict=True)


def test_a_missing_group_is_listed(spark):
    rows = [(1, "Twin", "G"), (2, "Twin", None)]
    entities = spark.createDataFrame(rows, f"{ID} int, {NAME} string, {GROUP} string")
    got = lookup.resolve_names(names(spark, ("twin", None)), entities).first()
    assert got["status"] == "ambiguous" and got["groups"] == ["", "G"]
    hits = lookup.search(spark.createDataFrame([(1, "twin")], "query_id int, part string"), entities).collect()
    assert sorted((r[NAME], r[GROUP] or "", r["stage"]) for r in hits) == [("Twin", "", "substring"), ("Twin", "G", "substring")]


def test_resolve_codes(spark, profiles):
    asked = spark.createDataFrame([(1, "21"), (2, "9999999"), (3, "no_number"), (4, "10d"), (5, None)], "query_id int, code string")
    got = {r["query_id"]: (r["status"], r[ID]) for r in lookup.resolve_codes(asked, profiles).collect()}
    assert got == {1: ("found", 21), 2: ("not_found", None), 3: ("invalid", None), 4: ("invalid", None), 5: ("invalid", None)}


def test_resolve_references(spark, profiles):
    rows = [(1, "22", None), (2, "lagoa", None), (3, "Lagôa", "QA"), (4, None, None)]
    asked = spark.createDataFrame(rows, "query_id int, ref string, `group` string")
    got = {r["query_id"]: (r["status"], r[ID]) for r in lookup.resolve_references(asked, profiles).collect()}
    assert got == {1: ("found", 22), 2: ("found", 9), 3: ("not_found", None), 4: ("invalid", None)}


def test_search(spark, profiles):
    asked = spark.createDataFrame([(1, "CLAR"), (2, "Vale do Ipe"), (3, ""), (4, "o vel"), (5, "a")], "query_id int, part string")
    got = {}
    for r in lookup.search(asked, profiles).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["stage"], r[NAME]))
    assert got[1] == [("substring", "Monte Claro")]
    assert got[2] == [("fuzzy", "Vale do Ipê")]
    assert 3 not in got
    assert got[4] == [("substring", "Faro Velho")] * 2
    assert [n for _, n in got[5]] == [n for _, n, *_ in PROFILES if "a" in n.lower()]


WORDS = ["small ring", "red widget", "blue bolt", "hot gear", "small gizmo", "smal rng", "gear hot", "bolt", "b", "aa", "aab", "old plate"]
ASKED = ["smll ring", "rd widget", "bolt blue", "gear", "aaa", "small", "plate old", "zzz", "B"]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@pytest.mark.parametrize("cutoff", [0.5, 0.7, 0.9])
def test_fuzzy_against_every_pair(spark, cutoff):
    entities = spark.createDataFrame([(i, w, "g") for i, w in enumerate(WORDS)], f"{ID} int, {NAME} string, {GROUP} string")
    asked = spark.createDataFrame([(w, w) for w in ASKED], "query_id string, part string")
    got = {}
    for r in lookup.fuzzy_hits(asked, entities, 10, cutoff=cutoff).collect():
        got.setdefault(r["query_id"], []).append((r["ratio"], r[NAME]))
    for word in ASKED:
        near = [(1 - distance(word, w) / max(len(word), len(w)), w) for w in WORDS]
        want = sorted((x for x in near if x[0] >= cutoff - 1e-9), key=lambda x: (round(x[0], 9), x[1]), reverse=True)[:10]
        assert [n for _, n in sorted(got.get(word, []), key=lambda x: (round(x[0], 9), x[1]), reverse=True)] == [n for _, n in want]


def test_substring_against_every_pair(spark):
    entities = spark.createDataFrame([(i, w, "g") for i, w in enumerate(WORDS)], f"{ID} int, {NAME} string, {GROUP} string")
    parts = ["l", "al", "all", "small r", "RING", "t b", "bolt", "(", "aa", "zz"]
    asked = spark.createDataFrame([(w, w) for w in parts], "query_id string, part string")
    got = {}
    for r in lookup.substring_hits(asked, entities, 100).collect():
        got.setdefault(r["query_id"], set()).add(r[ID])
    assert got == {p: hits for p in parts if (hits := {i for i, w in enumerate(WORDS) if p.lower() in w})}


def test_ratio_of_matching_blocks(spark):
    """All pairs as the standard library rates them, in its order."""
    import difflib
    import random

    from affinis.operators import lookup
    from affinis.spec import LIVESTOCK

    rng = random.Random(4)
    names = sorted({"".join(rng.choice("abcdé ") for _ in range(rng.randint(1, 9))) for _ in range(150)} | {"Monte Alto", "Monte Alta", "monte alto"})
    asked = {f"q{i}": name[::-1] if i % 4 == 0 else name[:-1] + rng.choice("abx") for i, name in enumerate(names[::3])} | {"long": "ab" * 150, "none": "", "null": None}
    entities = spark.createDataFrame([(i, n, "U") for i, n in enumerate(names * 2)], f"{LIVESTOCK.entity} int, {LIVESTOCK.name} string, {LIVESTOCK.group} string")
    queries = spark.createDataFrame(list(asked.items()), "query_id string, part string")
    for cutoff in (0.7, 0.4):
        hits = lookup.ratio_hits(queries, entities, 4, cutoff=cutoff).collect()
        got = {q: [r[LIVESTOCK.name] for r in sorted((r for r in hits if r.query_id == q), key=lambda r: (r.ratio, r[LIVESTOCK.name]), reverse=True)] for q in asked}
        assert got == {q: difflib.get_close_matches(part, names, 4, cutoff) if part and part.strip() else [] for q, part in asked.items()}
    found = lookup.search(queries, entities, 5, fuzzy=lookup.ratio_hits)
    assert found.filter("stage = 'fuzzy'").count() > 0


def test_substring_of_shared_names_and_runs(spark, monkeypatch):
    """Names and endings that very many share: no pair twice, equal questions as often as they were asked."""
    from affinis.operators import joins

    monkeypatch.setattr(joins, "ROWS_PER_SALT", 20)
    names = [f"Customer#{i:05d}" for i in range(300)] + ["Same Name"] * 50
    entities = spark.createDataFrame([(i, n, "g") for i, n in enumerate(names)], f"{ID} int, {NAME} string, {GROUP} string")
    parts = [(n, n[:-1]) for n in names[:300:7]] + [("same", "me na"), ("same", "me na"), ("twice", "00012"), ("twice", "00012"), ("0", "0"), ("all", "customer#"), ("far", "x" * 40)]
    got = {}
    asked = spark.createDataFrame(parts, "query_id string, part string")
    monkeypatch.setattr("affinis.operators.joins.fits_broadcast", lambda *_: False)
    for r in lookup.substring_hits(asked, entities, 3).collect():
        got.setdefault(r["query_id"], []).append(r[ID])
    want = {}
    for q, p in parts:
        want.setdefault(q, []).extend(i for i, n in enumerate(names) if p.strip().lower() in n.lower())
    assert {q: sorted(ids) for q, ids in got.items()} == {q: sorted(ids)[:3] for q, ids in want.items() if ids}
