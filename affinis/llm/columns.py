"""Column expressions on whole texts that several operators share; all of them run in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space around the words `[^\x20\x09-\x0D]+`, as characters and as a pattern.
SPACE = " \t\n\x0b\x0c\r"
SPACES = r"[\x20\x09-\x0D]+"


def trimmed(text: str) -> Column:
    """The text without white space at its ends (null: empty); the input of :func:`words`."""
    return F.btrim(F.coalesce(F.col(text), F.lit("")), F.lit(SPACE))


def words(trimmed_text: str) -> Column:
    """The words of a trimmed text; name it in a projection of its own, as it is read several times."""
    return F.when(F.col(trimmed_text) == "", F.array().cast("array<string>")).otherwise(F.split(trimmed_text, SPACES))


def row_numbered(df):
    """``df`` with a number for each row; it holds only once the table is written."""
    return df.withColumn("row_at", F.monotonically_increasing_id())
