"""Quality rules by cross-document line frequency, with DataFrame functions alone.

A line is normalised (ASCII letters lower, digits 0, white space one space) and hashed
together with its host. A host's documents are its distinct texts, so copies of one
document count once; what many different documents of a host say is boilerplate. Lines
in more documents than both limits allow are removed, and documents that lose most of
their words, or keep too few, are rejected. Texts are read once: measures and line
hashes of every row are written, and only hashes and counts are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinis.llm.columns import SPACE, row_numbered, trimmed, words
from affinis.llm.scratch import Scratch
from affinis.operators.joins import attached, weighted_lookup

LINE_DOCUMENTS = 10  # distinct documents of the host that may share a line
LINE_SHARE = 200  # a line may also stand in one in so many of the host's documents
MIN_WORDS = 10
MOST_REPEATED = 20  # per cent of the words in repeated windows
MOST_REMOVED = 50  # per cent of the words in removed lines
REPEAT_WINDOW = 5
SYMBOLS = "[#*$%&|<>]"
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: ASCII letters and digits, and what a normalised line has for them.
WRITTEN, NORMAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789", "abcdefghijklmnopqrstuvwxyz000000000"


def _window_hashes() -> Column:
    """A long for each window: half a hash of its words, then the number of its first word."""
    at = F.sequence(F.lit(0).cast("bigint"), F.size("w").cast("bigint") - REPEAT_WINDOW)
    words_at = [lambda i, k=k: F.get("w", i.cast("int") + k) for k in range(REPEAT_WINDOW)]
    packed = F.transform(at, lambda i: F.xxhash64(*[word(i) for word in words_at]).bitwiseAND(F.lit(-1 << 32)).bitwiseOR(i))
    return F.when(F.size("w") >= REPEAT_WINDOW, F.sort_array(packed))


def _with_repeats(df: DataFrame) -> DataFrame:
    """Add n_repeat_words; half hashes choose the windows that may be equal, and their words decide.

    Arrays that a lambda reads are columns of a projection of their own: an expression
    in a lambda would be computed again for each item.
    """

    def like_neighbour(items: str, key) -> Column:
        return F.filter(items, lambda x, i: (key(x) == key(F.get(items, i - 1))) | (key(x) == key(F.get(items, i + 1))))

    spelled = F.transform("near", lambda x: F.struct(F.array_join(F.slice("w", x.bitwiseAND(F.lit((1 << 32) - 1)).cast("int") + 1, REPEAT_WINDOW), " ").alias("s"), x.alias("p")))
    places = F.sort_array(F.transform("same", lambda x: x["p"].bitwiseAND(F.lit((1 << 32) - 1))))
    covered = F.aggregate(
        "places",
        F.struct(F.lit(-REPEAT_WINDOW).cast("bigint").alias("last"), F.lit(0).cast("bigint").alias("n")),
        lambda acc, p: F.struct(p.alias("last"), (acc["n"] + F.least(F.lit(REPEAT_WINDOW).cast("bigint"), p - acc["last"])).alias("n")),
        lambda acc: acc["n"],
    )
    return (
        df.withColumn("h", _window_hashes())
        .withColumn("near", like_neighbour("h", lambda x: F.shiftright(x, 32)))
        .drop("h")
        .withColumn("spelled", F.sort_array(spelled))
        .drop("near")
        .withColumn("same", like_neighbour("spelled", lambda x: x["s"]))
        .drop("spelled")
        .withColumn("places", places)
        .drop("same")
        .withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("bigint")))
        .drop("places")
    )


def measured(rows: DataFrame, host: str) -> DataFrame:
    """Add the base measures, and ``host_key``, ``text_key`` and ``lines`` (key, place, number of words) of each row."""
    normal = F.regexp_replace(F.translate("text", WRITTEN, NORMAL), r"[\x20\x09\x0B-\x0D]+", " ")
    hashed = F.transform(
        F.split(normal, "\n"),
        lambda line, i: F.struct(F.btrim(line).alias("line"), i.alias("at")),
    )
    filled = rows.withColumn("text", F.coalesce("text", F.lit(""))).withColumn("t", trimmed("text"))
    counted = (
        _with_repeats(filled.withColumn("w", words("t")).drop("t"))
        .withColumn("n_words", F.size("w").cast("bigint"))
        .withColumn("word_chars", F.char_length(F.array_join("w", "")).cast("bigint"))
        .drop("w")
        .withColumn("n_symbols", F.regexp_count("text", F.lit(SYMBOLS)).cast("bigint"))
        .withColumn("plain", F.filter(F.split("text", "\n"), lambda line: F.btrim(line, F.lit(SPACE)) != ""))
        .withColumn("n_dup_lines", (F.size("plain") - F.size(F.array_distinct("plain"))).cast("bigint"))
        .drop("plain")
    )
    return (
        counted.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")))
        .withColumn("host_key", F.xxhash64(host))
        .withColumn("text_key", F.xxhash64("text"))
        .withColumn("normal", F.filter(hashed, lambda x: x["line"] != ""))
        .withColumn(
            "lines",
            F.transform(
                "normal",
                lambda x: F.struct(
                    F.xxhash64(F.col(host), x["line"]).alias("key"),
                    x["at"].alias("at"),
                    (F.char_length(x["line"]) - F.char_length(F.translate(x["line"], " ", "")) + 1).alias("n"),
                ),
            ),
        )
        .drop("normal")
    )


def frequent_lines(whole: DataFrame, scratch: Scratch) -> DataFrame:
    """(key, n): hashes of lines above both limits, and how many lines of the table have them."""
    lines = whole.select("host_key", "text_key", F.explode("lines.key").alias("key"))
    per_text = lines.groupBy("host_key", "key", "text_key").agg(F.count(F.lit(1)).alias("n"))
    per_line = per_text.groupBy("host_key", "key").agg(F.count(F.lit(1)).alias("n_documents"), F.sum("n").alias("n"))
    shared = scratch.written(per_line.filter(F.col("n_documents") > LINE_DOCUMENTS), "shared-lines")
    hosts = whole.groupBy("host_key", "text_key").agg(F.lit(1).alias("one")).groupBy("host_key").agg(F.count("one").alias("n_host"))
    above = attached(shared, hosts, "host_key", "key").filter(F.col("n_documents") * LINE_SHARE > F.col("n_host"))
    return scratch.written(above.select("key", "n"), "frequent-lines")


def _removed(whole: DataFrame, scratch: Scratch) -> DataFrame:
    """(row_at, gone, words_removed) of the rows that hold a frequent line."""
    frequent = frequent_lines(whole, scratch).withColumnRenamed("n", "n_lines")
    lines = whole.select("row_at", F.inline("lines"))
    found = weighted_lookup(lines, frequent, ["key"], "n_lines", "row_at")
    return found.groupBy("row_at").agg(F.collect_list("at").alias("gone"), F.sum("n").cast("bigint").alias("words_removed"))


def judged(docs: DataFrame, host: str = "source", scratch: Scratch | None = None, with_text: bool = False) -> DataFrame:
    """Each row of ``docs`` with its measures and the verdict.

    Returns (row, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    n_lines_removed, words_removed, kept), and with ``with_text`` also ``text`` and the places
    ``gone`` of its removed lines. ``row`` is the struct of the other columns, whatever
    their names. A null text is empty and fails the base rules; rows without a host form a
    host of their own; repeated rows each get a row and count as one document. An empty
    table gives no rows.
    """
    scratch = scratch or Scratch(docs.sparkSession, "lines")
    others = [c for c in docs.columns if c != "text"]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in others]).alias("row"), F.col(f"`{host}`").alias("host"), "text")
    own = ["row", *(["text"] if with_text else [])]
    whole = scratch.written(row_numbered(measured(rows, "host")).select("row_at", *own, *BASE, "base_failed", "host_key", "text_key", "lines"), "measured")
    found = whole.drop("lines", "host_key", "text_key").join(_removed(whole, scratch), "row_at", "left")
    words_removed = F.coalesce("words_removed", F.lit(0).cast("bigint"))
    left = F.col("n_words") - words_removed
    depleted = (left < MIN_WORDS) | (100 * words_removed > MOST_REMOVED * F.col("n_words"))
    return found.select(
        *own,
        *BASE,
        "base_failed",
        F.coalesce(F.size("gone"), F.lit(0)).cast("bigint").alias("n_lines_removed"),
        words_removed.alias("words_removed"),
        (~F.col("base_failed") & ~depleted).alias("kept"),
        *(["gone"] if with_text else []),
    )


def cleaned(docs: DataFrame, host: str = "source") -> DataFrame:
    """The kept rows of ``docs``, all columns, without the frequent lines in ``text``; ``n_chars`` is counted again where one went.

    Nulls, repeated rows and empty tables are as in :func:`judged`.
    """
    found = judged(docs, host, with_text=True).filter("kept").withColumn("parts", F.split("text", "\n"))
    stays = F.array_except(F.sequence(F.lit(0), F.size("parts") - 1), "gone")
    text = F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(F.transform(stays, lambda i: F.get("parts", i)), "\n"))
    ready = found.withColumn("left", text)
    columns = {c: F.col("row").getField(c) for c in docs.columns if c != "text"} | {"text": F.col("left")}
    if "n_chars" in columns:
        columns["n_chars"] = F.when(F.col("gone").isNull(), columns["n_chars"]).otherwise(F.char_length("left").cast("long"))
    return ready.select(*[columns[c].alias(c) for c in docs.columns])
