import random
import re
from itertools import permutations

from helpers import prose
from pyspark.sql import functions as F

from affinis.llm import filter_audit
from affinis.operators import joins

DOCS, LABELS = "doc_id long, text string, lang string", "doc_id long, quality int, toxic int"


def fails(text, copied):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    found = {
        "A": len(words) < 100,
        "B": 100 * len(set(words)) < 80 * len(words),
        "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
        "D": bool(re.search(r"[#$%&*|]", text)),
        "E": copied,
    }
    return {name for name, bad in found.items() if bad}


def brute(docs, labels):
    rows = []
    for doc_id, text, lang in docs:
        copied = doc_id is not None and any(i is not None and i < doc_id and (t or "") == (text or "") for i, t, _ in docs)
        own = [x for x in labels if doc_id is not None and x[0] == doc_id]
        rows.append((lang or "", fails(text or "", copied), any(x[1] == 1 for x in own), any(x[2] == 1 for x in own)))
    out = {}
    for part in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left, seen = mine, []
            for step, name in enumerate(order, 1):
                removed = [r for r in left if name in r[1]]
                left = [r for r in left if name not in r[1]]
                shapley[name] += len(removed)
                seen.append((step, name, len(left), len(removed), sum(name in r[1] for r in mine) - len(removed), sum(r[1] == {name} for r in mine), sum(r[2] for r in removed), sum(r[3] for r in removed)))
            for step, name, *counts in seen:
                out[part, "".join(order), step] = [name, *counts]
        for (p, _, _), values in out.items():
            if p == part:
                values.append(shapley[values[0]])
    return {k: tuple(v[1:]) for k, v in out.items()}


def got(df):
    columns = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    return {(r.part, r.filter_order, r.step): tuple(r[c] for c in columns) for r in df.collect()}


def sample():
    rng = random.Random(2)
    docs = []
    for i in range(60):
        text = prose(rng, rng.choice([40, 130]))
        text = text.upper() if rng.random() < 0.2 else text
        text = " ".join(f"{w}{k}" for k, w in enumerate(text.split())) if rng.random() < 0.5 else text
        text += " 5 %" if rng.random() < 0.3 else ""
        docs.append((i, text, rng.choice(["en", "fr", None])))
    docs += [(100 + i, docs[i][1], docs[i + 1][2]) for i in range(12)] + [(200 + i, docs[0][1], "en") for i in range(20)]
    docs += [(None, docs[0][1], "en"), (None, None, "fr"), (300, "", ""), (301, None, "en"), (300, "", ""), (5, docs[5][1], docs[5][2])]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(0, 320, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1)]
    return docs, labels


def test_against_brute_force(spark):
    docs, labels = sample()
    d, la = spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)
    expected = brute(docs, labels)
    assert got(filter_audit.audit(d, la)) == expected
    clashing = d.selectExpr("*", "1 as part", "2 as row_at", "true as A", "'x' as filter", "3 as n")
    assert got(filter_audit.audit(clashing, la.selectExpr("*", "1 as good"))) == expected


def test_heavy_copies(spark, monkeypatch):
    monkeypatch.setattr(joins, "ROWS_PER_SALT", 3)
    monkeypatch.setattr(joins, "MOST_HEAVY", 2)
    monkeypatch.setattr("affinis.session.BROADCAST_ROWS", 0)
    docs, labels = sample()
    assert got(filter_audit.audit(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS))) == brute(docs, labels)


def test_empty_tables(spark):
    docs, labels = spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)
    assert filter_audit.audit(docs, labels).count() == 0
    one = spark.createDataFrame([(1, "some " * 300_000, "en")], DOCS)
    found = filter_audit.audit(one, labels)
    assert found.count() == 600 and found.agg(F.sum("removed")).first()[0] == 120


def test_failing_rows_are_never_broadcast(spark):
    """Neither side of the joins goes to the driver, however small its tables are said to be, and each is one join."""
    rows = [(i, "en", i % 2 == 0, i % 5 == 0) for i in range(40)]
    failing = {name: spark.createDataFrame(rows[at:], "row_at long, part string, good boolean, toxic boolean") for at, name in enumerate("ABCDE")}
    found = filter_audit.interactions(failing)
    first = {(r.filter, r.prefix): (r.removed, r.redundant) for r in found.collect()}
    assert first["A", 0] == (40, 0) and first["A", 2] == (1, 39) and first["E", 14] == (0, 36)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan
    assert plan.count("Anti") == plan.count("LeftSemi") > 0 and found._jdf.queryExecution().optimizedPlan().toString().count("LeftAnti") == 1
