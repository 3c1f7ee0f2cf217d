"""Rejected rows: both reasons that follow the ranking come from one pass over an entity."""

from collections import Counter

from letrado.operators.integrity import orphans
from letrado.plans import rejects, silver
from letrado.queries import bronze
from pyspark.sql import functions as F

SF_SMALL = "/root/testdata/sf0.001"


def _messy(spark):
    """Bronze with values that are no numbers, rows without a municipality and repeated keys."""
    b = {e: bronze(spark, SF_SMALL)[e] for e in ("ufs", "municipios", "indicador_alfabetizacao", "alunos", "meta_brasil",
                                                 "meta_uf", "meta_municipio")}
    alunos = b["alunos"].withColumn("proficiencia", F.when(F.crc32("id_aluno") % 5 == 0, "n/d").otherwise(F.col("proficiencia").cast("string")))
    alunos = alunos.withColumn("id_municipio", F.when(F.crc32("id_aluno") % 7 == 0, None).otherwise(F.col("id_municipio")))
    b["alunos"] = alunos.unionByName(alunos.where(F.crc32("id_aluno") % 3 == 0))
    b["indicador_alfabetizacao"] = b["indicador_alfabetizacao"].withColumn(
        "indicador_alfabetizacao", F.when(F.col("_record_id") % 4 == 0, None).otherwise(F.col("indicador_alfabetizacao")))
    return b


def test_one_pass_gives_the_rows_of_both_reasons(spark):
    b = _messy(spark)
    s = silver.build_silver(b)
    got = Counter((r.entity, r.reason, r.row) for r in rejects.rejected_rows(b, s).collect()
                  if r.entity in ("alunos", "indicador_alfabetizacao") and r.reason in (rejects.NO_VALUE, rejects.ORPHAN))
    want = Counter()
    ind = silver.rank_measurements(silver._batch_measurements(b["indicador_alfabetizacao"]))
    for entity, ranked, valued, value in (
            ("indicador_alfabetizacao", ind, silver.prepare_indicador(b["indicador_alfabetizacao"]), "indicador_alfabetizacao"),
            ("alunos", silver.ranked_alunos(b["alunos"]), silver.prepare_alunos(b["alunos"]), "proficiencia_saeb")):
        for reason, df in ((rejects.NO_VALUE, ranked.where(F.col(value).isNull())),
                           (rejects.ORPHAN, orphans(valued, s["municipios"], "id_municipio"))):
            rows = df.select(F.to_json(F.struct(*df.columns))).collect()
            assert rows, (entity, reason)
            want.update((entity, reason, r[0]) for r in rows)
    assert got == want


def test_an_entity_is_ranked_once(spark):
    b = bronze(spark, SF_SMALL)
    plan = rejects.rejected_rows(b, silver.build_silver(b))._jdf.queryExecution().optimizedPlan().toString()
    ranked = [line for line in plan.splitlines() if "Window [row_number()" in line]
    assert sum("id_aluno" in line for line in ranked) == 1
    assert sum("_event_id" in line or "_seq" in line for line in ranked) == 1
