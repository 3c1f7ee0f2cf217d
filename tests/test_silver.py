from conftest import rows
from letrado.operators.dedup import keep_latest
from letrado.operators.integrity import orphans, referential_filter
from letrado.operators.reshape import fill_missing, unpivot_years
from letrado.plans import silver

UFS = [("35", "SP", "São Paulo"), ("33", "RJ", "Rio de Janeiro"), ("31", "MG", "Minas Gerais")]
MUN = [("3550308", "São Paulo", "SP", "35"), ("3304557", "Rio de Janeiro", "RJ", "33"),
       ("3106200", "Belo Horizonte", "MG", "31")]
IND = [("3550308", 2022, 72.5, 10000), ("3304557", 2022, 68.1, 8000), ("3106200", 2022, 75.0, 7000),
       ("3550308", 2023, 74.3, 10200)]
ALU = [("A01", "3550308", 2023, 750.0), ("A02", "3550308", 2023, 700.0), ("A03", "3304557", 2023, 743.0),
       ("A04", "9999999", 2023, 800.0)]


def ufs(spark):
    return silver.transform_ufs(spark.createDataFrame(UFS, "id_uf string, sigla string, nome string"))


def mun(spark, extra=()):
    b = spark.createDataFrame(MUN + list(extra), "id_municipio string, nome string, sigla_uf string, id_uf string")
    return silver.transform_municipios(b, ufs(spark))


def test_dedup_on_key(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "id int, v string")
    assert sorted(rows(keep_latest(df, ["id"], []))) == [(1, "b"), (2, "c")]


def test_dedup_latest_timestamp_and_deterministic_tie(spark):
    df = spark.createDataFrame(
        [(1, "2024-01-01", 5, "old"), (1, "2024-02-01", 1, "new"), (2, "2024-01-01", 1, "x"),
         (2, "2024-01-01", 2, "y")], "id int, ts string, seq int, v string")
    got = sorted(rows(keep_latest(df, ["id"], ["ts", "seq"]), "id", "v"))
    assert got == [(1, "new"), (2, "y")]


def test_fill_missing_skips_absent_columns(spark):
    df = spark.createDataFrame([(None, "SP"), ("X", None)], "nome string, sigla string")
    out = fill_missing(df, {"nome": "NAO INFORMADO", "absent": "z", "sigla": None})
    assert out.columns == ["nome", "sigla"]
    assert rows(out) == [("NAO INFORMADO", "SP"), ("X", None)]


def test_referential_filter_and_orphans(spark):
    df = spark.createDataFrame([("SP",), ("XX",), (None,)], "sigla_uf string")
    ref = ufs(spark)
    assert rows(referential_filter(df, ref, "sigla_uf")) == [("SP",)]
    assert set(rows(orphans(df, ref, "sigla_uf"))) == {(None,), ("XX",)}


def test_transform_ufs_normalises(spark):
    got = sorted(rows(ufs(spark)))
    assert ("35", "SP", "SAO PAULO") in got and len(got) == 3


def test_transform_municipios_drops_unknown_state(spark):
    got = rows(mun(spark, [("9999999", "Inexistente", "ZZ", "99"), ("1", None, " sp", "35")]),
               "id_municipio", "nome_municipio", "sigla_uf")
    ids = {r[0] for r in got}
    assert "9999999" not in ids and {"3550308", "3304557", "3106200", "1"} <= ids
    assert ("1", "NAO INFORMADO", "SP") in got


def test_transform_indicador_flag_and_no_duplicates(spark):
    b = spark.createDataFrame(IND + [("3550308", 2022, 40.0, 1)],
                              "id_municipio string, ano int, indicador_alfabetizacao double, "
                              "quantidade_matriculas bigint")
    out = silver.transform_indicador(b, mun(spark))
    assert out.count() == out.select("id_municipio", "ano").distinct().count() == 4
    assert all(r["meta_atingida"] == (r["indicador_alfabetizacao"] >= 50) for r in out.collect())


def test_indicador_bad_text_nan_and_coalesce(spark):
    b = spark.createDataFrame(
        [("3550308", 2022, "n/d", "61.5", "abc", "2022-01-01"), ("3304557", 2022, None, "NaN", "5", "2022-01-01"),
         ("3106200", 2022, "55.0", "10", None, "2022-01-01")],
        "id_municipio string, ano int, taxa_alfabetizacao string, indicador_alfabetizacao string, "
        "quantidade_matriculas string, _ingestion_timestamp string")
    got = sorted(rows(silver.transform_indicador(b, mun(spark)),
                      "id_municipio", "indicador_alfabetizacao", "quantidade_matriculas"))
    # NaN becomes NULL and the row is dropped; 'n/d' falls back to the other column
    assert got == [("3106200", 55.0, None), ("3550308", 61.5, None)]


def test_transform_alunos_cutoff_743_and_ri(spark):
    b = spark.createDataFrame(ALU, "id_aluno string, id_municipio string, ano int, proficiencia double")
    got = sorted(rows(silver.transform_alunos(b, mun(spark)), "id_aluno", "aluno_alfabetizado"))
    assert got == [("A01", True), ("A02", False), ("A03", True)]


def test_unpivot_drops_null_years(spark):
    df = spark.createDataFrame([("SP", 70.0, None)], "sigla_uf string, meta_alfabetizacao_2024 double, "
                                                     "meta_alfabetizacao_2025 double")
    assert rows(unpivot_years(df, ["sigla_uf"], "meta")) == [("SP", 2024, 70.0)]


def test_meta_uf_looks_up_state_id(spark):
    b = spark.createDataFrame([(" sp", 70.0), ("zz", 50.0)], "sigla_uf string, meta_alfabetizacao_2024 double")
    assert rows(silver.transform_meta_uf(b, ufs(spark))) == [("35", "SP", 2024, 70.0)]


def test_meta_long_form_accepted(spark):
    b = spark.createDataFrame([(2021, 55.0), (2021, 56.0), (2022, 60.0)], "ano int, meta double")
    assert sorted(rows(silver.transform_meta_brasil(b))) == [(2021, 56.0), (2022, 60.0)]


def _events(spark, rows):
    return spark.createDataFrame(rows, "event_id string, event_type string, event_timestamp timestamp_ntz, "
                                       "id_municipio string, ano int, indicador_alfabetizacao double, "
                                       "quantidade_matriculas bigint")


def test_stream_overrides_batch_with_options(spark):
    import datetime as dt
    b = spark.createDataFrame(IND, "id_municipio string, ano int, indicador_alfabetizacao double, "
                                   "quantidade_matriculas bigint")
    t = dt.datetime(2024, 1, 1)
    ev = _events(spark, [("e1", "INDICADOR_ATUALIZADO", t, "3550308", 2022, 10.0, 1),
                         ("e2", "META_REVISADA", t + dt.timedelta(hours=1), "3550308", 2022, 20.0, 2),
                         ("e3", "INDICADOR_ATUALIZADO", t, "3304557", 2022, None, 3)])
    m = mun(spark)

    def value(**kw):
        out = silver.transform_indicador(b, m, stream=ev, **kw)
        return {r["id_municipio"]: r["indicador_alfabetizacao"] for r in out.where("ano = 2022").collect()}

    assert value()["3550308"] == 20.0                       # newest event wins
    assert value(event_types=["INDICADOR_ATUALIZADO"])["3550308"] == 10.0
    assert value()["3304557"] == 68.1                       # a NULL event value does not override
    assert "3304557" not in value(skip_null=False)          # ...unless asked: the key then drops (D11)


def test_hot_key_with_a_third_of_the_rows(spark):
    import datetime as dt
    import random
    rnd = random.Random(7)
    rows = []
    base = dt.datetime(2022, 1, 1)
    for i in range(3000):
        hot = i % 3 == 0                       # one key carries a third of all rows
        key = "3550308" if hot else rnd.choice(["3304557", "3106200"])
        rows.append((key, 2022, float(rnd.randint(0, 9999)) / 100, i, base + dt.timedelta(minutes=rnd.randint(0, 500)), i))
    b = spark.createDataFrame(rows, "id_municipio string, ano int, indicador_alfabetizacao double, "
                                    "quantidade_matriculas bigint, _ingestion_timestamp timestamp_ntz, "
                                    "_record_id bigint").repartition(6)
    out = silver.transform_indicador(b, mun(spark))
    assert "Partial" in out._jdf.queryExecution().executedPlan().toString()
    want = {}
    for key, _, v, _, ts, rid in rows:             # brute force: latest time, then highest record id
        if key not in want or (ts, rid) > want[key][0]:
            want[key] = ((ts, rid), v)
    got = {r["id_municipio"]: r["indicador_alfabetizacao"] for r in out.collect()}
    assert got == {k: v for k, (_, v) in want.items()}
