"""Reject accounting: where every bronze row of an entity ends.

Per entity the input rows equal the kept rows plus the rejects of each reason:
no key, no value, a duplicate, an orphan.  Wide goal tables count one row per
year column.  ``reject_counts`` counts, ``rejected_rows`` keeps the rows that
were turned away (duplicates aside, whose survivor is kept) as JSON with their
reason.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from letrado.functions.scalar import norm_text, safe_double
from letrado.operators.integrity import orphans
from letrado.operators.reshape import year_columns
from letrado.plans import silver
from letrado.plans.silver import DUPLICATE, INPUT, KEPT, NO_KEY, NO_VALUE, ORPHAN

BAD_VALUE = "valor_invalido"


def _year() -> Column:
    return F.col("ano").try_cast("int")


def _keyed(bronze: DataFrame, entity: str) -> Column:
    return {"ufs": lambda: F.col("id_uf").isNotNull(), "municipios": lambda: F.col("id_municipio").isNotNull(),
            "indicador_alfabetizacao": lambda: F.col("id_municipio").isNotNull() & _year().isNotNull(),
            "alunos": lambda: _year().isNotNull()}[entity]()


def _cells(bronze: DataFrame, ids: list[str]) -> DataFrame:
    """One row per (row, year column), the value as text; nothing dropped."""
    cols = year_columns(bronze)
    return bronze.select(*ids, *[F.col(c).cast("string").alias(c) for c in cols]).unpivot(ids, cols, "coluna", "valor")


def _survivors(typed: DataFrame, keys: list[str], keyed: Column, order: list[str], payload: list[str]) -> DataFrame:
    """One row per key: n rows, and the row that silver keeps (``w``); one row with NULL keys for all rows without a
    key.  The greatest struct is the row that ``keep_latest`` ranks first: NULLs are smallest in it, last there."""
    order = [c for c in order if c in typed.columns]
    cells = [F.when(keyed, F.col(k)).alias(k) for k in keys]
    return (typed.select(*cells, keyed.alias("_keyed"), F.struct(*order, *payload).alias("w"))
            .groupBy(*keys, "_keyed").agg(F.count(F.lit(1)).alias("n"), F.max("w").alias("w")))


def _known(per: DataFrame, ref: DataFrame, key: Column, ref_key: str) -> DataFrame:
    """``per`` with ``known``: whether the reference holds ``key``."""
    refs = ref.select(F.col(ref_key).alias("_ref")).where(F.col("_ref").isNotNull()).distinct()
    return per.join(refs, key == F.col("_ref"), "left").withColumn("known", F.col("_ref").isNotNull()).drop("_ref")


def _sum(of, when=None) -> Column:
    of = F.col(of) if isinstance(of, str) else of
    return F.coalesce(F.sum(of if when is None else F.when(when, of)), F.lit(0)).cast("bigint")


def _rows(entity: str, counts: DataFrame, reasons: list[str]) -> DataFrame:
    return counts.select(F.lit(entity).alias("entity"),
                         F.inline(F.array(*[F.struct(F.lit(r).alias("reason"), F.col(r).alias("n_rows")) for r in reasons])))


def _keyed_entity(entity: str, typed: DataFrame, keys: list[str], keyed: Column, order: list[str], payload: list[str],
                  value: str | None = None, ref: tuple[DataFrame, str] | None = None) -> DataFrame:
    """Every count of an entity from one pass over its rows: no key, duplicates, no value, orphans, kept."""
    per = _survivors(typed, keys, keyed, order, payload)
    valued = F.col("_keyed") if value is None else F.col("_keyed") & F.col("w")[value].isNotNull()
    kept = valued
    if ref is not None:
        key = F.col(ref[1]) if ref[1] in keys else F.col("w")[ref[1]]
        per = _known(per, ref[0], key, ref[1])
        kept = valued & F.col("known")
    one = F.lit(1)
    counts = per.agg(_sum("n").alias(INPUT), _sum("n", ~F.col("_keyed")).alias(NO_KEY),
                     _sum(F.col("n") - 1, F.col("_keyed")).alias(DUPLICATE), _sum(one, F.col("_keyed") & ~valued).alias(NO_VALUE),
                     _sum(one, valued & ~kept).alias(ORPHAN), _sum(one, kept).alias(KEPT))
    return _rows(entity, counts, [INPUT, NO_KEY, DUPLICATE, *([NO_VALUE] if value else []), *([ORPHAN] if ref else []), KEPT])


def _goal_cells(bronze: DataFrame, ids: list[str]) -> DataFrame:
    """One row per goal cell with its year and whether it holds a goal; nothing dropped."""
    if year_columns(bronze):
        cells = _cells(bronze, ids)
        return cells.select(*ids, F.substring("coluna", -4, 4).cast("int").alias("ano"), safe_double("valor").isNotNull().alias("valid"))
    value = next(c for c in bronze.columns if c.startswith("meta"))
    return bronze.select(*ids, _year().alias("ano"), (safe_double(value).isNotNull() & _year().isNotNull()).alias("valid"))


def _goal_entity(entity: str, bronze: DataFrame, ids: list[str], ref: tuple[DataFrame, str] | None = None) -> DataFrame:
    """Goals: no value, duplicates, orphans, kept, from one pass over the cells."""
    per = (_goal_cells(bronze, ids).groupBy(*ids, "ano")
           .agg(F.count(F.lit(1)).alias("n"), F.count_if("valid").alias("n_valid")))
    any_valid = F.col("n_valid") > 0
    kept = any_valid
    if ref is not None:
        per = _known(per, ref[0], F.col(ids[0]).cast("string"), ref[1])
        kept = any_valid & F.col("known")
    counts = per.agg(_sum("n").alias(INPUT), _sum(F.col("n") - F.col("n_valid")).alias(NO_VALUE),
                     _sum(F.col("n_valid") - 1, any_valid).alias(DUPLICATE), _sum(F.lit(1), any_valid & ~kept).alias(ORPHAN),
                     _sum(F.lit(1), kept).alias(KEPT))
    return _rows(entity, counts, [INPUT, NO_VALUE, DUPLICATE, *([ORPHAN] if ref else []), KEPT])


def _meta_uf(bronze: DataFrame, ufs: DataFrame) -> DataFrame:
    """State goals are looked up by their code before duplicates go, so orphans come first here."""
    per = (_goal_cells(bronze, ["sigla_uf"]).withColumn("sigla_uf", norm_text("sigla_uf")).groupBy("sigla_uf", "ano")
           .agg(F.count(F.lit(1)).alias("n"), F.count_if("valid").alias("n_valid")))
    ids = ufs.groupBy("sigla_uf").agg(F.collect_set("id_uf").alias("ids"))       # states of one code: hardly ever two
    each = per.join(ids, "sigla_uf", "left").select("ano", "n", "n_valid", F.posexplode_outer("ids").alias("pos", "id_uf"))
    first = F.coalesce(F.col("pos"), F.lit(0)) == 0
    known = first & F.col("pos").isNotNull()
    counts = each.agg(
        _sum("n", first).alias(INPUT), _sum(F.col("n") - F.col("n_valid"), first).alias(NO_VALUE),
        _sum("n_valid", first & F.col("pos").isNull()).alias(ORPHAN), _sum("n_valid", known).alias("found"),
        F.count_distinct(F.when(F.col("pos").isNotNull() & (F.col("n_valid") > 0), F.struct("id_uf", "ano"))).alias(KEPT))
    return _rows("meta_uf", counts.withColumn(DUPLICATE, F.col("found") - F.col(KEPT)), [INPUT, NO_VALUE, ORPHAN, DUPLICATE, KEPT])


def reject_counts(bronze, s) -> DataFrame:
    """(entity, reason, n_rows): input, what each reason took, and what was kept.

    One pass per entity: rows are counted by key with the row that silver would keep,
    and every step is a flag of that one row.  ``s`` gives the dimensions that keys are checked against."""
    b, municipios = bronze, (s["municipios"], "id_municipio")
    ufs = b["ufs"].select(F.col("id_uf").cast("string").alias("id_uf"))
    alunos = silver.typed_alunos(b["alunos"])
    if "id_aluno" not in alunos.columns:        # without ids every row is its own
        alunos = alunos.withColumn("id_aluno", F.monotonically_increasing_id())
    ind = silver.typed_measurements(b["indicador_alfabetizacao"])
    parts = [
        _keyed_entity("ufs", ufs, ["id_uf"], F.col("id_uf").isNotNull(), [], ["id_uf"]),
        _keyed_entity("municipios", silver.typed_municipios(b["municipios"]), ["id_municipio"],
                      F.col("id_municipio").isNotNull(), list(silver.ORDER_COLS), silver.MUNICIPIO_PAYLOAD,
                      ref=(s["ufs"], "sigla_uf")),
        _keyed_entity("indicador_alfabetizacao", ind, ["id_municipio", "ano"],
                      F.col("id_municipio").isNotNull() & F.col("ano").isNotNull(), silver.LINEAGE_COLS,
                      silver.MEASUREMENT_PAYLOAD, "indicador_alfabetizacao", municipios),
        _keyed_entity("alunos", alunos, ["id_aluno", "ano"], F.col("ano").isNotNull(), list(silver.ORDER_COLS),
                      silver.ALUNO_PAYLOAD, "proficiencia_saeb", municipios),
        _goal_entity("meta_brasil", b["meta_brasil"], []),
        _meta_uf(b["meta_uf"], s["ufs"]),
        _goal_entity("meta_municipio", b["meta_municipio"], ["id_municipio"], municipios),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _json(cols: list[str]) -> Column:
    return F.to_json(F.struct(*[F.col(c) for c in cols]))


def _valueless_or_orphans(entity: str, ranked: DataFrame, value: str, ref: DataFrame, key: str) -> DataFrame:
    """The rows of both reasons from one pass: ranked once, looked up once.  An orphan's key comes first in its row."""
    no_value, cols = F.col(value).isNull(), ranked.columns
    away = _known(ranked, ref, F.col(key), key).where(no_value | ~F.col("known"))
    return away.select(F.lit(entity).alias("entity"), F.when(no_value, F.lit(NO_VALUE)).otherwise(F.lit(ORPHAN)).alias("reason"),
                       F.when(no_value, _json(cols)).otherwise(_json([key, *[c for c in cols if c != key]])).alias("row"))


def rejected_rows(bronze, s) -> DataFrame:
    """(entity, reason, row as JSON) of the rows that silver turned away."""
    def tagged(entity: str, reason: str, df: DataFrame) -> DataFrame:
        return df.select(F.lit(entity).alias("entity"), F.lit(reason).alias("reason"), _json(df.columns).alias("row"))

    b, parts = bronze, []
    for entity in ("ufs", "municipios", "indicador_alfabetizacao", "alunos"):
        parts.append(tagged(entity, NO_KEY, b[entity].where(~_keyed(b[entity], entity))))
    ranked = silver.rank_measurements(silver._batch_measurements(b["indicador_alfabetizacao"]))
    for entity, df, value in (("indicador_alfabetizacao", ranked, "indicador_alfabetizacao"),
                              ("alunos", silver.ranked_alunos(b["alunos"]), "proficiencia_saeb")):
        parts.append(_valueless_or_orphans(entity, df, value, s["municipios"], "id_municipio"))
    for entity, ids in (("meta_brasil", []), ("meta_uf", ["sigla_uf"]), ("meta_municipio", ["id_municipio"])):
        cells = _cells(b[entity], ids)
        parts.append(tagged(entity, BAD_VALUE, cells.where(F.col("valor").isNotNull() & safe_double("valor").isNull())))
    parts.append(tagged("municipios", ORPHAN, orphans(silver.prepare_municipios(b["municipios"]), s["ufs"], "sigla_uf")))
    parts.append(tagged("meta_municipio", ORPHAN,
                        orphans(silver.prepare_meta_municipio(b["meta_municipio"]), s["municipios"], "id_municipio")))
    parts.append(tagged("meta_uf", ORPHAN, orphans(silver.prepare_meta_uf(b["meta_uf"]), s["ufs"], "sigla_uf")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
