import re

import pytest
from pyspark.sql import functions as F

from affinis.functions import text as tx
from affinis.functions.stem import add_stem

SAMPLES = [
    "Rio Grande do Sul", "Sul/Sudoeste de Minas", "  a \t b\n\nc  ", "", None, "São-João d'Água", "à è ' x",
    "__a__", "\xa0x y\x1cz ", "Ünïcode ÇÃO", "a/-b", "tab\there",
]


def column(spark, values, function, kind="string"):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(function(F.col("v"))).collect()]


def test_normalise(spark):
    expected = ["" if s is None else re.sub(r"\s+", " ", s.strip()) for s in SAMPLES]
    assert column(spark, SAMPLES, tx.normalise_text) == expected


def test_snake_token(spark):
    got = dict(zip(SAMPLES, column(spark, SAMPLES, tx.snake_token), strict=True))
    assert got["Rio Grande do Sul"] == "rio_grande_do_sul"
    assert got["Sul/Sudoeste de Minas"] == "sul_sudoeste_de_minas"
    assert got["São-João d'Água"] == "são_joão_d_água"
    assert got["à è ' x"] == "x"
    assert got["a/-b"] == "a_b"
    assert got[None] == got[""] == ""
    assert got["__a__"] == "a"


def test_tokens(spark):
    expected = [[] if s is None else s.lower().split() for s in SAMPLES]
    assert column(spark, SAMPLES, tx.tokens) == expected


def test_marked_number(spark):
    values = ["-", "...", "..", "X", "12", "10d", "1e3", "", " ", "-5", "abc", "0x1F", ".5", "7."]
    got = column(spark, values, lambda c: tx.marked_number(c, ["-"], ["...", "..", "X"]))
    assert got == [0.0, None, None, None, 12.0, None, 1000.0, None, None, -5.0, None, None, 0.5, 7.0]


def test_names(spark):
    df = spark.createDataFrame([(" são paulo\t", "São Paulo"), ("Sao Paulo", "São Paulo")], "a string, b string")
    assert [r[0] for r in df.select(tx.same_name(F.col("a"), F.col("b"))).collect()] == [True, False]
    df = spark.createDataFrame([("São Paulo (SP)", "(sp"), ("abc", ".")], "a string, b string")
    assert [r[0] for r in df.select(tx.contains_text(F.col("a"), F.col("b"))).collect()] == [True, False]


@pytest.mark.parametrize(
    ("word", "stem"),
    [
        ("bovinocultura", "bovinocultur"),
        ("avicultura", "avicultur"),
        ("caprinos", "caprin"),
        ("falaremos", "fal"),
        ("comeremos", "com"),
        ("cantaríamos", "cant"),
        ("partiremos", "part"),
        ("falássemos", "fal"),
        ("sul_sudoeste_de_minas", "sul_sudoeste_de_minas"),
        ("especializado_em_bovinocultura", "especializado_em_bovinocultura"),
        ("s", "s"),
        ("mg", "mg"),
    ],
)
def test_stem(spark, word, stem):
    df = spark.createDataFrame([(word,)], "w string")
    assert add_stem(df, "w", "s").first()["s"] == stem


def test_stem_plan_is_small(spark):
    """The driver's share of stemming doesn't grow out of its memory: the rules are no part of the plan."""
    df = spark.createDataFrame([("bovinos",), ("a_b",), ("",), (None,)], "w string")
    stems = add_stem(df.distinct(), "w", "s")
    assert len(stems._jdf.queryExecution().toString()) < 20_000
    assert {r["w"]: r["s"] for r in stems.collect()} == {"bovinos": "bovin", "a_b": "a_b", "": "", None: None}
