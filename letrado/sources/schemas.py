"""Declared schemas of the stored layers.

Readers give these to Spark instead of trusting file footers: a file without a
column yields NULLs, a file with another type fails.  REQUIRED columns become
non-null quality checks.  Names and types are fixed values of the data model.
"""

from __future__ import annotations

from pyspark.sql.types import StructType

SCHEMAS: dict[tuple[str, str], str] = {
    ("silver", "ufs"): "id_uf string, sigla_uf string, nome_uf string",
    ("silver", "municipios"): "id_municipio string, nome_municipio string, sigla_uf string, id_uf string",
    ("silver", "indicador_alfabetizacao"):
        "id_municipio string, ano int, indicador_alfabetizacao double, quantidade_matriculas bigint, meta_atingida boolean, "
        "_priority int, _order_ts timestamp_ntz, _seq bigint, _event_id string, _bucket int",
    ("silver", "alunos"): "id_aluno string, ano int, id_municipio string, proficiencia_saeb double, aluno_alfabetizado boolean",
    ("silver", "meta_brasil"): "ano int, meta_nacional double",
    ("silver", "meta_uf"): "id_uf string, sigla_uf string, ano int, meta_uf double",
    ("silver", "meta_municipio"): "id_municipio string, ano int, meta_municipio double",
    ("gold", "indicador_municipio"):
        "id_municipio string, nome string, sigla_uf string, id_uf string, nome_uf string, ano int, "
        "indicador_alfabetizacao double, quantidade_matriculas bigint, meta_municipio double, meta_nacional double, "
        "gap_vs_meta_municipio double, gap_vs_meta_nacional double, status_meta_municipio string, meta_atingida boolean",
    ("gold", "evolucao_uf"):
        "id_uf string, sigla_uf string, nome_uf string, ano int, indicador_medio double, indicador_min double, "
        "indicador_max double, total_municipios bigint, matriculas_total bigint, municipios_meta_atingida bigint, "
        "meta_uf double, pct_municipios_meta_atingida double, variacao_yoy double",
    ("gold", "painel_nacional"):
        "ano int, indicador_medio_nacional double, total_municipios bigint, municipios_meta_atingida bigint, "
        "total_matriculas bigint, meta_nacional double, pct_municipios_alfabetizados double, gap_meta double",
    ("gold", "ml_features"):
        "id_municipio string, nome string, sigla_uf string, id_uf string, ano int, indicador_lag1 double, "
        "indicador_lag2 double, tendencia_historica double, gap_historico_vs_meta_municipio double, "
        "gap_historico_vs_meta_nacional double, meta_municipio double, meta_nacional double, "
        "quantidade_matriculas bigint, indicador_alfabetizacao double, meta_atingida boolean",
}
REQUIRED: dict[tuple[str, str], tuple[str, ...]] = {
    ("gold", "indicador_municipio"): ("id_municipio", "ano"),
    ("gold", "evolucao_uf"): ("id_uf", "ano"),
    ("gold", "painel_nacional"): ("ano",),
    ("gold", "ml_features"): ("id_municipio", "ano"),
}
AUDIT = {"silver": "_silver_timestamp timestamp, processed_date date", "gold": "_gold_timestamp timestamp, gold_date date"}


def stored_schema(layer: str, entity: str) -> StructType | None:
    """Data, audit and date columns of a stored table; None where nothing is declared (bronze keeps
    what its source sent)."""
    ddl = SCHEMAS.get((layer, entity))
    return None if ddl is None else StructType.fromDDL(f"{ddl}, {AUDIT[layer]}")
