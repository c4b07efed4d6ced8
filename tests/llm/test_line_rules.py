import re
from collections import Counter

import pytest
from helpers import docs_of, prose
from hypothesis import given, settings
from hypothesis import strategies as st

from affinis.llm import line_rules
from affinis.llm.queries_rules import op11

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def normal(line):
    return " ".join(WORD.findall(line.translate(str.maketrans(line_rules.WRITTEN, line_rules.NORMAL))))


def base(text):
    words = WORD.findall(text or "")
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    repeated = {j for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    failed = len(words) < 10 or 100 * len(repeated) > 20 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(line_rules.SYMBOLS, text or "")), len(lines) - len(set(lines)), len(repeated), failed


def brute(rows):
    """(text, host) rows to (base measures, failed, lines removed, words removed, kept, text left)."""
    texts = {}
    for text, host in rows:
        texts.setdefault(host, set()).add(text or "")
    shares = Counter((host, line) for host, group in texts.items() for text in group for line in {normal(x) for x in text.split("\n")} - {""})
    out = []
    for text, host in rows:
        gone = [x for x in (text or "").split("\n") if (n := shares[host, normal(x)]) > line_rules.LINE_DOCUMENTS and n * line_rules.LINE_SHARE > len(texts[host])]
        *measures, failed = base(text)
        removed = sum(len(WORD.findall(x)) for x in gone)
        kept = not failed and measures[0] - removed >= 10 and 100 * removed <= 50 * measures[0]
        left = "\n".join(x for x in (text or "").split("\n") if x not in gone)
        out.append((*measures, failed, len(gone), removed, kept, left))
    return out


COLUMNS = [*line_rules.BASE, "base_failed", "n_lines_removed", "words_removed", "kept"]


def got(df):
    return [tuple(r[c] for c in COLUMNS) for r in df.orderBy("row.doc_id").collect()]


def table(spark, rows):
    return spark.createDataFrame([(i, t, h) for i, (t, h) in enumerate(rows)], "doc_id long, text string, source string")


@pytest.fixture(scope="module")
def rows():
    import random

    rng = random.Random(5)
    banner, licence = "Subscribe  NOW 2024 to\tour letter", [prose(rng, 11) for _ in range(3)]
    out = []
    for i in range(200):
        host = ("a", "b", None)[i % 3]
        lines = [prose(rng, 12), banner.upper() if i % 2 else banner, prose(rng, 9)]
        if i % 5 == 0:
            lines = [prose(rng, 10), *licence]
        out.append(("\n".join(lines), host))
    out += [(out[0][0], "a")] * 40  # copies of one document count once
    out += [(None, "a"), ("", None), (" \n\t", "b"), ("one two three four five " * 6, "a"), ("x\n\nx\ny y", "b"), ("aé " * 12 + "#|<", "c")]
    return out


def test_against_brute_force(spark, rows):
    assert got(line_rules.judged(table(spark, rows))) == [r[:-1] for r in brute(rows)]
    assert any(r[-2] is False and not r[5] for r in brute(rows)) and any(r[7] and r[8] for r in brute(rows))


def test_cleaned(spark, rows):
    df = table(spark, rows).selectExpr("*", "1L as n_chars", "'x' as lines", "2 as gone", "3 as row_at")
    found = line_rules.cleaned(df)
    assert found.columns == df.columns
    expected = [(i, r[-1], len(r[-1]) if r[6] else 1, "x", 2, 3) for i, r in enumerate(brute(rows)) if r[8]]
    assert [(r.doc_id, r.text, r.n_chars, r.lines, r.gone, r.row_at) for r in found.orderBy("doc_id").collect()] == expected


WORDS = st.lists(st.sampled_from(["a", "b", "\n", "\t", " ", "é", "a b", "#", "\x0b", " ", "\x1c"]), max_size=40).map(" ".join)


@settings(max_examples=6, deadline=None)
@given(texts=st.lists(st.one_of(st.none(), WORDS), min_size=1, max_size=25))
def test_measures_of_any_text(spark, texts):
    rows = [(t, "h") for t in texts]
    assert [r[:6] for r in got(line_rules.judged(table(spark, rows)))] == [base(t) for t in texts]


def test_edge_cases(spark):
    long = prose(__import__("random").Random(1), 60_000)
    df = docs_of(spark, [long, None, long, "ab " * 30_000])
    found = [tuple(r[c] for c in COLUMNS) for r in line_rules.judged(df).orderBy("row.doc_id").collect()]
    assert [r[:6] for r in found] == [base(t) for t in (long, None, long, "ab " * 30_000)]
    assert line_rules.judged(df.limit(0)).count() == 0 and line_rules.cleaned(df.limit(0)).count() == 0
    twice = spark.createDataFrame([(None, "t " * 20, None)] * 2, "doc_id long, text string, source string")
    assert line_rules.judged(twice).count() == 2


def test_no_python_in_the_plan(spark, tmp_path):
    docs_of(spark, ["a b c"]).write.parquet(f"{tmp_path}/documents.parquet")
    plan = op11(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
