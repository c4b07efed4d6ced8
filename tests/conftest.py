import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

sys.path.insert(0, str(Path(__file__).resolve().parent))

from crafts import PROFILES  # noqa: E402

from affinis.sources.landing import RAW_COLUMNS  # noqa: E402
from affinis.spec import LIVESTOCK  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("affinis-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def raw_rows(spark):
    """Make a raw table from (key, category, value) rows."""

    def make(rows):
        fixed = {"NC": "6", "NN": "Município", "MC": "24", "MN": "Cabeças", "D2C": "2024", "D2N": "2024", "D4C": "1"}
        full = [
            tuple({**fixed, "D1C": key, "D1N": key, "D3C": "105", "D3N": "e", "D4N": category, "V": value}[c] for c in RAW_COLUMNS)
            for key, category, value in rows
        ]
        return spark.createDataFrame(full, ", ".join(f"{c} string" for c in RAW_COLUMNS))

    return make


@pytest.fixture(scope="session")
def raw(raw_rows):
    return raw_rows(
        [
            ("71", "Galináceos - total", "640"),
            ("71", "Bovino", "12"),
            ("72", "Suíno - total", "88"),
            ("72", LIVESTOCK.ignored_categories[0], "31"),
            ("72", "Bovino", ".."),
            ("73", "  Bovino", "905"),
            ("73", "Suíno - total", "-"),
            ("74", "Galináceos - total", "-"),
        ]
    )


@pytest.fixture(scope="session")
def dimension(spark):
    return spark.createDataFrame(
        [
            (71, "Pedra Alta", "Centro", "AA", "Serra Azul/Vale"),
            (72, "Rio Fundo", "Litoral", "BB", "Costa Norte"),
            (73, "Vila Nova", "Litoral", "CC", "Baía de Areia"),
            (74, "Campo Só", "Centro", "BB", "Mata - Funda"),
            (75, "Ilhote", None, None, None),
        ],
        "id_municipio bigint, nome_municipio string, nome_regiao string, sigla_uf string, nome_mesorregiao string",
    )


@pytest.fixture(scope="session")
def profiles(spark):
    return spark.createDataFrame(
        [(i, n, u, "meso", "regiao", "especializado_em_x", t) for i, n, u, t in PROFILES],
        "id_municipio bigint, nome_municipio string, sigla_uf string, nome_mesorregiao string, "
        "nome_regiao string, especializacao string, tags string",
    )
