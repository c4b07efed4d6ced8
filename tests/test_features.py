import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from affinis.operators import features as feat
from affinis.operators import quality
from affinis.operators.cleaning import clean, unmapped
from affinis.sources import batches, hierarchy, landing
from affinis.spec import LIVESTOCK

ID = "id_municipio"


def wide(spark, columns):
    rows = [(i, *map(float, vs)) for i, vs in enumerate(zip(*columns.values(), strict=True))]
    return spark.createDataFrame(rows, f"{ID} bigint, " + ", ".join(f"{c} double" for c in columns))


def by_id(df, column):
    return [r[column] for r in df.orderBy(ID).collect()]


def test_clean(raw):
    cleaned = clean(raw)
    assert cleaned.columns == [ID, "ano", "atividade", "valor"]
    assert [f.dataType.simpleString() for f in cleaned.schema] == ["bigint", "bigint", "string", "double"]
    rows = {(r[ID], r["atividade"]): r["valor"] for r in cleaned.collect()}
    assert rows == {
        (71, "avicultura"): 640.0, (71, "bovinocultura"): 12.0, (72, "suinocultura"): 88.0, (72, "bovinocultura"): None,
        (73, "bovinocultura"): 905.0, (73, "suinocultura"): 0.0, (74, "avicultura"): 0.0,
    }
    assert cleaned.count() == 7


def test_clean_needs_its_columns(raw):
    with pytest.raises(ValueError, match="D4N"):
        clean(raw.drop("D4N"))


def test_bad_key_is_an_error(raw_rows):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        clean(raw_rows([("12x", "Bovino", "1")])).collect()


def test_unmapped(raw_rows):
    rows = raw_rows([("1", "Bovino", "1"), ("1", "Muar", "1"), ("2", " Muar", "2"), ("1", "Galináceos - galinhas", "1")])
    assert [r[0] for r in unmapped(rows).collect()] == ["Muar"]


def test_widen_sums_and_fills(raw):
    got = feat.widen(clean(raw))
    assert got.columns == [ID, "avicultura", "bovinocultura", "suinocultura"]
    rows = {r[ID]: tuple(r)[1:] for r in got.collect()}
    assert rows == {71: (640.0, 12.0, 0.0), 72: (0.0, 0.0, 88.0), 73: (0.0, 905.0, 0.0), 74: (0.0, 0.0, 0.0)}


def test_enrich_keeps_every_dimension_row(raw, dimension):
    got = feat.enrich(dimension, feat.widen(clean(raw)))
    assert got.count() == 5
    assert got.filter(F.col(ID) == 75).first()["bovinocultura"] == 0.0


def band_of(value, positive):
    if value == 0:
        return "sem"
    if len(positive) < 3:
        return "presente"
    low, high = np.quantile(positive, (0.33, 0.66))
    return "baixa" if value <= low else "media" if value <= high else "alta"


@pytest.mark.parametrize("values", [[0, 3, 7, 0, 12, 20, 33, 41, 58, 90, 150], [4, 4, 4, 4], [9, 1, 5], [0, 6], [2, 8], [0, 0]])
def test_bands_against_numpy(spark, values):
    df = wide(spark, {"bovinocultura": values})
    got = [b.split("_")[0] for b in by_id(feat.add_bands(df, feat.band_thresholds(df, ["bovinocultura"])), "perfil_bovinocultura")]
    assert got == [band_of(v, [x for x in values if x > 0]) for v in values]


def test_negative_value_is_low(spark):
    df = wide(spark, {"bovinocultura": [-5, 1, 2, 3]})
    got = by_id(feat.add_bands(df, feat.band_thresholds(df, ["bovinocultura"])), "perfil_bovinocultura")
    assert got[0] == "baixa_bovinocultura"


def test_no_activity(spark):
    df = wide(spark, {"bovinocultura": [0, 1], "suinocultura": [0, 0]})
    assert by_id(feat.add_specialty(df), "especializacao")[0] == "sem_producao_pecuaria"
    none = df.select(ID)
    assert by_id(feat.add_specialty(none), "especializacao") == ["sem_producao_pecuaria"] * 2
    assert by_id(feat.add_diversity(none), "n_atividades") == [0, 0]


@pytest.mark.parametrize("modulus", [3, 7, 50])  # many zeros and ties, fewer, nearly none
def test_specialty_against_pandas(spark, modulus):
    frame = pd.DataFrame({a: [(i * k) % modulus for i in range(60)] for a, k in zip(LIVESTOCK.main_activities, (1, 2, 3, 4, 5), strict=True)})
    df = wide(spark, {c: frame[c].tolist() for c in frame})
    ranks = frame.astype(float).replace(0, float("nan")).rank(pct=True, method="max")
    some = frame.sum(axis=1) > 0
    best = ranks[some].idxmax(axis=1)
    expected = ["especializado_em_" + best[i] if some[i] else "sem_producao_pecuaria" for i in range(60)]
    assert by_id(feat.add_specialty(df), "especializacao") == expected


def test_diversity(spark):
    columns = {"bovinocultura": [0, 4, 0, 6], "suinocultura": [0, 0, 3, 1], "avicultura": [0, 9, 0, 2]}
    got = feat.add_diversity(wide(spark, columns))
    present = [[a for a in columns if columns[a][i] > 0] for i in range(4)]
    assert by_id(got, "n_atividades") == [len(p) for p in present]
    assert by_id(got, "atividades_presentes") == [" ".join(p) for p in present]


def test_profile_text_needs_parts(spark):
    with pytest.raises(ValueError):
        feat.add_profile_text(spark.range(1))


def test_feature_table(raw, dimension):
    table = feat.build_features(raw, dimension)
    got = {r[ID]: r for r in table.collect()}
    assert set(got) == {71, 72, 73, 74, 75}
    assert got[71]["tags"] == (
        "centro aa serra_azul_vale presente_avicultura presente_bovinocultura sem_suinocultura "
        "especializado_em_avicultura bovinocultura avicultura"
    )
    assert got[72]["tags"] == (
        "litoral bb costa_norte sem_avicultura sem_bovinocultura presente_suinocultura especializado_em_suinocultura suinocultura"
    )
    assert got[74]["tags"] == "centro bb mata_funda sem_avicultura sem_bovinocultura sem_suinocultura sem_producao_pecuaria"
    assert got[75]["tags"] == "sem_avicultura sem_bovinocultura sem_suinocultura sem_producao_pecuaria"
    assert got[75]["n_atividades"] == 0
    assert table.columns[-4:] == ["especializacao", "n_atividades", "atividades_presentes", "tags"]
    assert table.columns[5:11] == [
        "avicultura", "bovinocultura", "suinocultura", "perfil_bovinocultura", "perfil_suinocultura", "perfil_avicultura",
    ]


# -- quality --------------------------------------------------------------------


@pytest.mark.parametrize(("received", "status"), [(3, "ok"), (98, "ok"), (90, "warning"), (50, "warning"), (30, "error")])
def test_coverage(spark, received, status):
    requested = spark.range(3 if received == 3 else 100)
    row = quality.coverage(requested, spark.range(received), "id").first()
    assert row["status"] == status
    assert row["n_missing"] == row["n_requested"] - received
    assert row["sample"] == list(range(received, row["n_requested"]))[:10]


def test_coverage_counts_unrequested_keys(spark):
    row = quality.coverage(spark.range(10), spark.range(5, 25), "id").first()
    assert (row["n_requested"], row["n_received"], row["n_missing"]) == (10, 20, 5)


def test_coverage_strict_and_unchecked(spark):
    with pytest.raises(RuntimeError):
        quality.coverage(spark.range(100), spark.range(30), "id", strict=True)
    unchecked = quality.coverage(spark.range(5), spark.range(5).toDF("x"), "id").first()
    assert unchecked["status"] == "unchecked"


def test_consistency(spark):
    row = quality.consistency(spark.range(5), spark.range(2, 8), "id").first()
    assert row.asDict() == {"n_features": 5, "n_vectors": 6, "only_features": 2, "only_vectors": 3}
    with pytest.raises(ValueError):
        quality.consistency(spark.range(5), spark.range(4), "id", strict=True)


# -- sources --------------------------------------------------------------------


def nested(spark):
    rows = [
        (901, "Ponta", (90, "Enseada", (9, "Costa Baixa", (4, "LT", "Litoral", (1, "OE", "Oeste"))))),
        (9999999, "Município Fantasma", None),
    ]
    return spark.createDataFrame(rows, hierarchy.RECORD)


def test_flatten(spark):
    flat = hierarchy.typed(hierarchy.flatten(nested(spark)))
    assert flat.schema == hierarchy.flat_schema()
    rows = {r[ID]: r for r in flat.collect()}
    assert rows[901]["sigla_uf"] == "LT" and rows[901]["nome_regiao"] == "Oeste"
    assert sum(v is None for v in rows[9999999]) == 10


def test_empty_territory_is_an_error(spark):
    with pytest.raises(ValueError):
        hierarchy.typed(hierarchy.flatten(nested(spark).limit(0)))


def test_json_array(spark, tmp_path):
    rows = [r["j"] for r in nested(spark).select(F.to_json(F.struct("*")).alias("j")).collect()]
    (tmp_path / "places.json").write_text("[" + ",\n".join(rows) + "]", encoding="utf-8")
    assert hierarchy.read_json(spark, str(tmp_path / "places.json")).count() == 2


def test_write_once(spark, tmp_path):
    path = str(tmp_path / "t")
    assert landing.land_once(spark.range(3), path).count() == 3
    assert landing.land_once(spark.range(9), path).count() == 3
    assert landing.land_once(spark.range(9), path, force=True).count() == 9
    with pytest.raises(FileNotFoundError):
        landing.load(spark, str(tmp_path / "missing"))


def test_period_partition_is_pruned(spark, tmp_path):
    df = spark.range(100).withColumn("ano", (2020 + F.col("id") % 4).cast("int"))
    landed = landing.land_measurements(df, str(tmp_path / "m"), "ano")
    one = landing.for_period(landed, "ano", 2021)
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ano" in plan and one.count() == 25
    assert {r["ano"] for r in landing.for_period(landed, "ano").collect()} == {2023}


def test_batches(spark):
    sizes = [r["count"] for r in batches.assign_batches(spark.range(5571), "id").groupBy("batch").count().orderBy("batch").collect()]
    assert sizes == [500] * 11 + [71]
    with pytest.raises(ValueError):
        batches.assign_batches(spark.range(3), "id", 0)


def test_key_lists(spark):
    df = spark.createDataFrame([("b", 3), ("a", 2), ("b", 1), (None, 9), ("b", 2)], "uf string, id bigint")
    got = {(r["uf"], r["part"]): r["keys"] for r in batches.key_lists(df, "uf", "id", 2).collect()}
    assert got == {("a", 0): [2], ("b", 0): [1, 2], ("b", 1): [3]}


def test_half_written_table_is_written_anew(spark, tmp_path):
    path = str(tmp_path / "table")
    spark.range(3).write.parquet(path)
    (tmp_path / "table" / "_SUCCESS").unlink()
    assert landing.land_once(spark.range(5), path).count() == 5
    assert landing.land_once(spark.range(9), path).count() == 5
    assert landing.land_once(spark.range(9), path, force=True).count() == 9


def test_sample_for_ranges_does_not_grow_with_partitions(spark):
    from affinis.operators import ordering

    df = spark.range(40_000)
    few, many = (ordering.split_points(df.repartition(n), ["id"], ["id"], 10) for n in (2, 60))
    assert [tuple(r) for r in few] == [tuple(r) for r in many] and 5 < len(few) < 10


def test_batch_union(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "one"))
    spark.range(2).withColumn("x", F.lit(1)).write.parquet(str(tmp_path / "two"))
    found, failed = landing.landed_batches(spark, {n: str(tmp_path / n) for n in ("one", "two", "three")})
    union = landing.union_batches(found)
    assert list(failed) == ["three"] and "three" in failed["three"] and union.count() == 5 and union.filter("x IS NULL").count() == 3
    expected = spark.createDataFrame([("one",), ("three",)], "batch string")
    assert [r[0] for r in landing.failed_batches(union, expected).collect()] == ["three"]
    with pytest.raises(RuntimeError):
        landing.union_batches({})
