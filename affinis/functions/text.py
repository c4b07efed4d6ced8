"""Column functions for cleaning and splitting text. All of them stay in the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as whitespace, besides the space itself.
SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
NUMBER = r"^[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity))$"

# Letters a profile token may keep besides a-z and 0-9.
TOKEN_LETTERS = "áéíóúâêîôûãõçñü"


def _blank(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(""))


def _spaced(text: Column) -> Column:
    """Every whitespace character as a plain space: cheaper than a Unicode pattern."""
    return F.translate(text, SPACES, " " * len(SPACES))


def normalise_text(text: Column) -> Column:
    """Strip, and collapse runs of whitespace to one space; NULL gives ''."""
    spaced = F.trim(_spaced(_blank(text)))
    return F.when(spaced.contains("  "), F.regexp_replace(spaced, " +", " ")).otherwise(spaced)


def snake_token(text: Column) -> Column:
    """One lower-case token joined by underscores; NULL gives ''."""
    kept = F.regexp_replace(F.lower(_spaced(_blank(text))), rf"[^a-z0-9{TOKEN_LETTERS} /_-]", " ")
    return F.regexp_replace(F.regexp_replace(kept, "[ /-]+", "_"), "^_+|_+$", "")


def marked_number(text: Column, zero_marks: Sequence[str], null_marks: Sequence[str]) -> Column:
    """Number text with marks: a zero mark is 0, a null mark or other text is NULL."""
    return (
        F.when(text.isin(*zero_marks), F.lit(0.0))
        .when(text.isin(*null_marks), F.lit(None))
        .when(text.rlike(NUMBER), text.try_cast("double"))
    )


def words(text: Column) -> Column:
    """Words split at whitespace; NULL gives an empty array."""
    return F.filter(F.split(_spaced(_blank(text)), " "), lambda word: word != "")


def tokens(text: Column) -> Column:
    """Lower-case words split at whitespace; NULL gives an empty array."""
    return words(F.lower(text))


def join_words(*parts: Column) -> Column:
    """Parts separated by single spaces; empty and NULL parts leave no gap."""
    return normalise_text(F.concat_ws(" ", *parts))


def name_key(text: Column) -> Column:
    """Lower case without outer spaces; inner spaces and accents count."""
    outer = f"^[ {SPACES}]+|[ {SPACES}]+$"
    return F.lower(F.regexp_replace(text, outer, ""))


def same_name(left: Column, right: Column) -> Column:
    """Equality without case or outer spaces."""
    return name_key(left) == name_key(right)


def contains_text(text: Column, part: Column) -> Column:
    """Literal substring test without case."""
    return F.lower(text).contains(name_key(part))


def shown_specialty(specialty: Column, prefix: str) -> Column:
    """A specialty for display: without its prefix, underscores as spaces."""
    return F.replace(F.replace(specialty, F.lit(prefix), F.lit("")), F.lit("_"), F.lit(" "))
