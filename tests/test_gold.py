import pytest

from conftest import rows
from letrado.plans import features, gold

# Two states; state 1 has towns a (three years) and b, state 2 has town c.  Expected values are worked
# out beside each assertion.
IND = [("a", 2001, 40.0, 10, False), ("a", 2002, 55.0, 20, True), ("a", 2003, 52.5, 30, True),
       ("b", 2003, 61.0, 5, True), ("c", 2003, 30.25, 7, False)]
MUN = [("a", "ALTO", "1", "NO"), ("b", "BAIXO", "1", "NO"), ("c", "CERRO", "2", "SU")]
UFS = [("1", "NO", "NORTE"), ("2", "SU", "SUL")]


@pytest.fixture()
def tables(spark):
    return {
        "ind": spark.createDataFrame(IND, "id_municipio string, ano int, indicador_alfabetizacao double, "
                                          "quantidade_matriculas bigint, meta_atingida boolean"),
        "mun": spark.createDataFrame(MUN, "id_municipio string, nome_municipio string, id_uf string, sigla_uf string"),
        "ufs": spark.createDataFrame(UFS, "id_uf string, sigla_uf string, nome_uf string"),
        "mm": spark.createDataFrame([("a", 2003, 50.0), ("c", 2003, 31.0)],
                                    "id_municipio string, ano int, meta_municipio double"),
        "muf": spark.createDataFrame([("1", "NO", 2003, 58.0), ("2", "SU", 2003, 33.0)],
                                     "id_uf string, sigla_uf string, ano int, meta_uf double"),
        "mb": spark.createDataFrame([(2001, 41.0), (2002, 45.0), (2003, 48.0)], "ano int, meta_nacional double"),
    }


def test_indicador_municipio_gap_and_status(tables):
    t = tables
    g = gold.build_indicador_municipio(t["ind"], t["mun"], t["ufs"], t["mm"], t["mb"])
    by = {(r["id_municipio"], r["ano"]): r for r in g.collect()}
    a = by[("a", 2003)]
    assert a["gap_vs_meta_municipio"] == 2.5 and a["status_meta_municipio"] == "ATINGIDA"     # 52.5 - 50
    assert a["gap_vs_meta_nacional"] == 4.5 and a["nome_uf"] == "NORTE"                       # 52.5 - 48
    assert by[("b", 2003)]["status_meta_municipio"] == "SEM_META"
    assert by[("c", 2003)]["status_meta_municipio"] == "NAO_ATINGIDA"                         # 30.25 < 31
    assert g.columns == gold.INDICADOR_MUNICIPIO_COLS


def test_painel_nacional(tables):
    p = {r["ano"]: r for r in gold.build_painel_nacional(tables["ind"], tables["mb"]).collect()}
    r = p[2003]
    assert (r["indicador_medio_nacional"], r["total_municipios"], r["municipios_meta_atingida"]) == (47.92, 3, 2)  # 143.75 / 3
    assert (r["pct_municipios_alfabetizados"], r["meta_nacional"], r["gap_meta"]) == (66.67, 48.0, -0.08)
    assert r["total_matriculas"] == 42


def test_a_repeated_municipality_counts_once(tables):
    twice = tables["ind"].unionByName(tables["ind"].where("id_municipio = 'b'"))
    p = {r["ano"]: r for r in gold.build_painel_nacional(twice, tables["mb"]).collect()}
    e = {(r["id_uf"], r["ano"]): r for r in gold.build_evolucao_uf(twice, tables["mun"], tables["ufs"], tables["muf"]).collect()}
    assert p[2003]["total_municipios"] == 3 and e["1", 2003]["total_municipios"] == 2


def test_evolucao_uf_yoy(tables):
    t = tables
    e = gold.build_evolucao_uf(t["ind"], t["mun"], t["ufs"], t["muf"])
    one = sorted(rows(e.where("id_uf = '1'"), "ano", "indicador_medio", "variacao_yoy", "pct_municipios_meta_atingida"))
    assert one == [(2001, 40.0, None, 0.0), (2002, 55.0, 15.0, 100.0), (2003, 56.75, 1.75, 100.0)]   # (52.5 + 61) / 2
    x = gold.build_evolucao_uf_export(t["ind"], t["mun"], t["ufs"])
    assert sorted(rows(x.where("id_uf = '1'"), "variacao_yoy")) == [(0.0,), (1.75,), (15.0,)]


def test_all_null_enrolment_sums_to_zero(spark, tables):
    ind = spark.createDataFrame([("a", 2003, 60.0, None, True)],
                                "id_municipio string, ano int, indicador_alfabetizacao double, "
                                "quantidade_matriculas bigint, meta_atingida boolean")
    assert gold.build_painel_nacional(ind, tables["mb"]).first()["total_matriculas"] == 0


def test_ml_features_lags_trend_and_gap(tables):
    t = tables
    g = gold.build_indicador_municipio(t["ind"], t["mun"], t["ufs"], t["mm"], t["mb"])
    f = features.build_ml_features(g, with_target=True)
    r = f.where("id_municipio = 'a' AND ano = 2003").first()
    assert (r["indicador_lag1"], r["indicador_lag2"], r["tendencia_historica"]) == (55.0, 40.0, 15.0)
    assert r["gap_historico_vs_meta_municipio"] == 5.0 and r["indicador_alfabetizacao"] == 52.5      # 55 - 50
    assert r["meta_atingida"] is True and r["target_meta_atingida"] == 1
    assert f.count() == 2          # rows without lag1 are dropped


def test_lag_is_row_based_over_missing_year(spark):
    ind = spark.createDataFrame([("1", 2020, 10.0), ("1", 2022, 30.0)],
                                "id_municipio string, ano int, indicador_alfabetizacao double")
    g = ind.selectExpr("*", "'n' nome", "'S' sigla_uf", "'1' id_uf", "50.0 meta_municipio", "50.0 meta_nacional",
                       "cast(null as bigint) quantidade_matriculas", "false meta_atingida")
    r = features.build_ml_features(g).first()
    assert (r["ano"], r["indicador_lag1"]) == (2022, 10.0)
