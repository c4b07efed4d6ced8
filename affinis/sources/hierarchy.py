"""Nested territory records to a flat, typed dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The nested record, and the flat columns with their paths in it.
RECORD = (
    "id bigint, nome string, microrregiao struct<id: bigint, nome: string, "
    "mesorregiao: struct<id: bigint, nome: string, UF: struct<id: bigint, sigla: string, nome: string, "
    "regiao: struct<id: bigint, sigla: string, nome: string>>>>"
)
MESO = "microrregiao.mesorregiao"
FLAT = {
    "id_municipio": "id",
    "nome_municipio": "nome",
    "id_microrregiao": "microrregiao.id",
    "nome_microrregiao": "microrregiao.nome",
    "id_mesorregiao": f"{MESO}.id",
    "nome_mesorregiao": f"{MESO}.nome",
    "id_uf": f"{MESO}.UF.id",
    "sigla_uf": f"{MESO}.UF.sigla",
    "nome_uf": f"{MESO}.UF.nome",
    "id_regiao": f"{MESO}.UF.regiao.id",
    "sigla_regiao": f"{MESO}.UF.regiao.sigla",
    "nome_regiao": f"{MESO}.UF.regiao.nome",
}


def flatten(records: DataFrame) -> DataFrame:
    """Twelve flat columns; a missing level gives NULLs."""
    return records.select([F.col(path).alias(name) for name, path in FLAT.items()])


def typed(flat: DataFrame) -> DataFrame:
    """Ids as bigint, the rest as string; an empty table is an error."""
    if flat.isEmpty():
        raise ValueError("the territory table is empty")
    return flat.select(
        [F.col(c).cast("bigint" if c.startswith("id_") else "string").alias(c) for c in flat.columns]
    )


def from_json_column(df: DataFrame, column: str) -> DataFrame:
    """Flat dimension from records held as JSON text."""
    record = F.from_json(F.col(column), RECORD).alias("record")
    return flatten(df.select(record).select("record.*"))


def read_json(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Flat dimension from a landed JSON array, or from one record per line.

    One record per line splits over tasks; an array file is read by one task.
    """
    return flatten(spark.read.schema(RECORD).option("mode", "FAILFAST").json(path, multiLine=not lines))


def flat_schema() -> T.StructType:
    return T.StructType(
        [T.StructField(c, T.LongType() if c.startswith("id_") else T.StringType()) for c in FLAT]
    )
