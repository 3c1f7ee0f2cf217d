"""Registered queries: one per operator group of the pipeline.

Each entry takes ``(spark, sf_dir)``, reads the driver's tables under
``sf_dir`` and returns a lazy DataFrame over the whole tables.  Run-time audit
columns (timestamps of the run) are left out so results are reproducible.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from letrado.functions.scalar import norm_text, safe_double, safe_long
from letrado.operators.integrity import orphans, referential_filter
from letrado.operators.reshape import unpivot_years
from letrado.plans import features, gold, silver
from letrado.plans.lazy import LazyTables
from letrado.session import materialize
from letrado.sources import mapping
from letrado.sources.tables import read_table

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}


def query(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        return fn
    return deco


def bronze(spark: SparkSession, d: str) -> LazyTables:
    return mapping.bronze_entities(spark, d)


def silver_tables(spark: SparkSession, d: str) -> LazyTables:
    return silver.build_silver(bronze(spark, d))


def gold_tables(spark: SparkSession, d: str) -> LazyTables:
    return gold.build_gold(silver_tables(spark, d))


def _checkpointed(tables) -> LazyTables:
    """Each entity is materialised once on first use (a Parquet table under
    ``spark.checkpoint.dir``), as the job does by writing a layer and reading
    it back; for queries that consume silver/gold several times."""
    return LazyTables({k: (lambda k=k: materialize(tables[k], k)) for k in tables})


# -- step 0: scalar helpers over whole tables ---------------------------------

@query("norm_text")
def q_norm_text(spark, d):
    b = bronze(spark, d)["municipios"]
    return b.select("id_municipio", norm_text("nome").alias("nome_norm"),
                    norm_text("sigla_uf").alias("sigla_norm"))


@query("safe_cast_coalesce")
def q_safe_cast_coalesce(spark, d):
    b = bronze(spark, d)["indicador_alfabetizacao"]
    return b.select(
        "_record_id",
        F.coalesce(safe_double("taxa_alfabetizacao"), safe_double("indicador_alfabetizacao"))
         .alias("indicador_alfabetizacao"),
        safe_long("quantidade_matriculas").alias("quantidade_matriculas"))


@query("unpivot_years")
def q_unpivot_years(spark, d):
    return unpivot_years(bronze(spark, d)["meta_municipio"], ["id_municipio"], "meta_municipio")


# -- step 1: the flagship ----------------------------------------------------

@query("painel_nacional")
def q_painel_nacional(spark, d):
    s = silver_tables(spark, d)
    return gold.build_painel_nacional(s["indicador_alfabetizacao"], s["meta_brasil"])


# -- step 2: silver ----------------------------------------------------------

@query("silver_ufs")
def q_silver_ufs(spark, d):
    return silver_tables(spark, d)["ufs"]


@query("silver_municipios")
def q_silver_municipios(spark, d):
    return silver_tables(spark, d)["municipios"]


@query("silver_indicador")
def q_silver_indicador(spark, d):
    return silver_tables(spark, d)["indicador_alfabetizacao"]


@query("silver_alunos")
def q_silver_alunos(spark, d):
    return silver_tables(spark, d)["alunos"]


@query("silver_meta_brasil")
def q_silver_meta_brasil(spark, d):
    return silver_tables(spark, d)["meta_brasil"]


@query("silver_meta_uf")
def q_silver_meta_uf(spark, d):
    return silver_tables(spark, d)["meta_uf"]


@query("silver_meta_municipio")
def q_silver_meta_municipio(spark, d):
    return silver_tables(spark, d)["meta_municipio"]


@query("ri_orphans")
def q_ri_orphans(spark, d):
    """Rows each referential check removes, per entity (``left_anti`` counts)."""
    b = bronze(spark, d)
    ufs = silver.transform_ufs(b["ufs"])
    mun_pre = silver.prepare_municipios(b["municipios"])
    mun = referential_filter(mun_pre, ufs, "sigla_uf")
    checks = [
        ("municipios", "sigla_uf", orphans(mun_pre, ufs, "sigla_uf")),
        ("indicador_alfabetizacao", "id_municipio",
         orphans(silver.prepare_indicador(b["indicador_alfabetizacao"]), mun, "id_municipio")),
        ("alunos", "id_municipio", orphans(silver.prepare_alunos(b["alunos"]), mun, "id_municipio")),
        ("meta_municipio", "id_municipio",
         orphans(silver.prepare_meta_municipio(b["meta_municipio"]), mun, "id_municipio")),
        ("meta_uf", "sigla_uf", orphans(silver.prepare_meta_uf(b["meta_uf"]), ufs, "sigla_uf")),
    ]
    parts = [df.agg(F.count(F.lit(1)).alias("orphan_rows"))
               .select(F.lit(e).alias("entity"), F.lit(k).alias("key"), "orphan_rows")
             for e, k, df in checks]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# -- step 3: gold ------------------------------------------------------------

@query("indicador_municipio")
def q_indicador_municipio(spark, d):
    return gold_tables(spark, d)["indicador_municipio"]


@query("status_counts")
def q_status_counts(spark, d):
    return gold.status_counts(gold_tables(spark, d)["indicador_municipio"])


@query("evolucao_uf")
def q_evolucao_uf(spark, d):
    return gold_tables(spark, d)["evolucao_uf"]


@query("evolucao_uf_export")
def q_evolucao_uf_export(spark, d):
    s = silver_tables(spark, d)
    return gold.build_evolucao_uf_export(s["indicador_alfabetizacao"], s["municipios"], s["ufs"])


@query("painel_export")
def q_painel_export(spark, d):
    s = silver_tables(spark, d)
    return gold.build_painel_nacional(s["indicador_alfabetizacao"], s["meta_brasil"], gap_from_rounded=True)


@query("distinct_sketches")
def q_distinct_sketches(spark, d):
    """Municipalities per state and year, per state, per year and in all: exact, and whether the estimate from the
    sketches stored per state and year lies within three standard errors."""
    from letrado.plans import sketches
    s = silver_tables(spark, d)
    ind, mun = materialize(s["indicador_alfabetizacao"], "indicador"), materialize(s["municipios"], "municipios")
    stored = materialize(sketches.municipality_sketches(ind, mun), "sketches")
    return sketches.compare(stored, ind, mun)


# -- step 4: features --------------------------------------------------------

@query("ml_features")
def q_ml_features(spark, d):
    return features.build_ml_features(gold_tables(spark, d)["indicador_municipio"])


@query("ml_features_target")
def q_ml_features_target(spark, d):
    return features.build_ml_features(gold_tables(spark, d)["indicador_municipio"], with_target=True)


def _stored_by_municipality(spark, d):
    """Silver written once, the municipal tables bucketed by municipality."""
    from letrado.session import scratch_path
    from letrado.sources.bucketed import BucketedSilver

    root = scratch_path(spark, "bucketed")
    wanted = ("ufs", "municipios", "indicador_alfabetizacao", "meta_brasil", "meta_municipio")
    s = silver_tables(spark, d)
    return BucketedSilver(spark, root, f"letrado_{root[-12:]}").write_all({e: s[e] for e in wanted})


@query("indicador_municipio_stored")
def q_indicador_municipio_stored(spark, d):
    """The municipal indicator from silver tables bucketed by municipality: the fact is not moved."""
    return gold.build_gold(_stored_by_municipality(spark, d))["indicador_municipio"]


@query("ml_features_stored")
def q_ml_features_stored(spark, d):
    """The lag features from the same tables: joins and lags on the stored distribution."""
    return features.build_ml_features(q_indicador_municipio_stored(spark, d))


# -- step 5: sources and sinks -------------------------------------------------

ROUNDTRIP_YEAR = 1998        # year partition read back in partition_roundtrip
RUN_DATE = "2024-01-31"      # run date of the registered queries (fixed for reproducibility)
AS_OF = "2024-01-31 00:00:00"


@query("partition_roundtrip")
def q_partition_roundtrip(spark, d):
    """Write gold indicador_municipio partitioned by (gold_date, ano) and
    clustered, then read one year back through partition pruning."""
    return q_partition_roundtrip_all(spark, d).where(F.col("ano") == ROUNDTRIP_YEAR)


@query("partition_roundtrip_all")
def q_partition_roundtrip_all(spark, d):
    """The same with every written year read back."""
    from letrado.session import scratch_path
    from letrado.sources import io

    root = scratch_path(spark, "roundtrip")
    io.write_layer(gold_tables(spark, d)["indicador_municipio"], root, "gold", "indicador_municipio", RUN_DATE)
    # written without the run's audit column, which the declared schema then fills with NULL
    return io.read_layer(spark, root, "gold", "indicador_municipio", RUN_DATE).drop("_gold_timestamp")


@query("export_totals")
def q_export_totals(spark, d):
    """All four gold tables exported as Parquet and CSV: rows and enrolments read back from either copy."""
    from letrado.session import scratch_path
    from letrado.sources import io

    s = _checkpointed(silver_tables(spark, d))
    g = gold.build_gold(s)
    ind = materialize(g["indicador_municipio"], "indicador_municipio")
    tables = {"indicador_municipio": (ind, "quantidade_matriculas"), "evolucao_uf": (g["evolucao_uf"], "matriculas_total"),
              "painel_nacional": (g["painel_nacional"], "total_matriculas"),
              "ml_features": (features.build_ml_features(ind), "quantidade_matriculas")}
    root, parts = scratch_path(spark, "export"), []
    for name, (df, total) in tables.items():
        io.export_dual(df, [f"{root}/{name}"])
        pq = spark.read.parquet(f"{root}/{name}/parquet")
        csv = spark.read.schema(pq.schema).option("header", True).csv(f"{root}/{name}/csv")
        parts += [df.agg(F.count(F.lit(1)).alias("n_rows"), F.sum(total).alias("matriculas")).select(
            F.lit(name).alias("table_name"), F.lit(kind).alias("format"), "n_rows", "matriculas")
            for kind, df in (("parquet", pq), ("csv", csv))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("dual_format_export")
def q_dual_format_export(spark, d):
    """Export the national panel as Parquet and CSV; read the CSV back with
    the Parquet copy's schema (no inference)."""
    from letrado.session import scratch_path
    from letrado.sources import io

    base = scratch_path(spark, "export/painel_nacional")
    io.export_dual(q_painel_nacional(spark, d), [base])
    schema = spark.read.parquet(f"{base}/parquet").schema
    return spark.read.schema(schema).option("header", True).csv(f"{base}/csv")


# -- step 6: quality -----------------------------------------------------------

def _quality_sources(spark, d, layers=None):
    if layers is None:
        s = silver_tables(spark, d)
        layers = (s, gold.build_gold(s))
    s, g = layers
    return {
        ("silver", "ufs"): lambda: s["ufs"],
        ("silver", "municipios"): lambda: s["municipios"],
        ("silver", "indicador_alfabetizacao"): lambda: s["indicador_alfabetizacao"],
        ("gold", "indicador_municipio"): lambda: g["indicador_municipio"],
        ("gold", "painel_nacional"): lambda: g["painel_nacional"],
        ("gold", "evolucao_uf"): lambda: g["evolucao_uf"],
        ("gold", "ml_features"): lambda: features.build_ml_features(g["indicador_municipio"]),
    }


def _written_layers(spark, d):
    """Silver and gold each written once; the checks read the written tables."""
    s = _checkpointed(silver_tables(spark, d))
    return s, _checkpointed(gold.build_gold(s))


@query("quality_report")
def q_quality_report(spark, d):
    from letrado.plans import quality
    return quality.quality_report(_quality_sources(spark, d, _written_layers(spark, d)), spark=spark)


@query("quality_summary")
def q_quality_summary(spark, d):
    from letrado.plans import quality
    return quality.quality_summary(materialize(q_quality_report(spark, d), "quality_report"))


@query("quality_report_incremental")
def q_quality_report_incremental(spark, d):
    """The same report from stored check states of two days, into which every table's rows are dealt by a hash."""
    from letrado.plans import quality
    from letrado.plans.quality_states import QualityStates
    from letrado.session import scratch_path
    states = QualityStates(spark, scratch_path(spark, "quality-states"))
    sources = _quality_sources(spark, d, _written_layers(spark, d))
    for (layer, entity) in quality.ENTITY_RULES:
        df = sources[layer, entity]()
        part = F.pmod(F.xxhash64(*df.columns), F.lit(2))
        for i, day in enumerate(("2024-01-30", "2024-01-31")):
            states.add(day, layer, entity, df.where(part == i))
    return states.report()


@query("gold_silver_consistency")
def q_gold_silver_consistency(spark, d):
    from letrado.plans import quality
    s = silver_tables(spark, d)
    g = gold.build_gold(s)
    return quality.gold_silver_consistency(g["indicador_municipio"], s["indicador_alfabetizacao"])


# -- step 7: streaming (batch form over the whole events table) -----------------

def _messages(spark, d):
    return mapping.stream_messages(read_table(spark, d, "events"))


def _events(spark, d):
    from letrado.streaming.events import prepare_events
    return prepare_events(_messages(spark, d))


@query("stream_decode")
def q_stream_decode(spark, d):
    """Push-delivery form: base64 message data -> JSON -> flat event."""
    from letrado.streaming.events import FLAT_COLS, decode_base64, flatten_events, parse_messages
    b64 = _messages(spark, d).select(F.base64(F.encode("value", "UTF-8")).alias("data"))
    decoded = b64.select(decode_base64("data").alias("value"))
    return flatten_events(parse_messages(decoded)).select(*FLAT_COLS)


@query("stream_validate")
def q_stream_validate(spark, d):
    return _events(spark, d).select("event_id", "is_valid", "reject_reason")


@query("stream_quarantine")
def q_stream_quarantine(spark, d):
    return (_events(spark, d).where(~F.col("is_valid"))
            .select("event_id", "reject_reason", "id_municipio", "ano", "indicador_alfabetizacao"))


@query("stream_flatten")
def q_stream_flatten(spark, d):
    """silver.streaming_events: valid, enriched events (run date left out)."""
    from letrado.streaming.events import FLAT_COLS, enrich_events
    valid = _events(spark, d).where(F.col("is_valid")).select(*FLAT_COLS)
    return enrich_events(valid).drop("_processing_date")


@query("stream_upsert")
def q_stream_upsert(spark, d):
    """Silver indicador with the stream merged in: per (id_municipio, ano) a
    valid event beats the batch row, the newest event beats older ones."""
    b = bronze(spark, d)
    s = silver.build_silver(b)
    valid = _events(spark, d).where(F.col("is_valid"))
    return silver.transform_indicador(b["indicador_alfabetizacao"], s["municipios"], stream=valid)


@query("stream_upsert_versioned")
def q_stream_upsert_versioned(spark, d):
    """The same through the merge table: silver as its first version, the events in micro-batches, a compaction in
    between, and the newest version read with the changes that came after it."""
    from letrado.session import scratch_path
    from letrado.streaming.merge_table import IndicadorTable, in_batches
    s = silver.build_silver(bronze(spark, d), keep_lineage=True)
    table = IndicadorTable(spark, scratch_path(spark, "indicador"))
    municipios = materialize(s["municipios"], "municipios")
    table.create(silver.transform_indicador(bronze(spark, d)["indicador_alfabetizacao"], municipios, keep_lineage=True))
    for i, batch in enumerate(in_batches(_events(spark, d).where(F.col("is_valid")), 3)):
        table.upsert(batch, "events", i)
        if i == 1:
            table.compact()
    return table.current(municipios).select(*silver.INDICADOR_COLS)


@query("event_log_days")
def q_event_log_days(spark, d):
    """Deliveries stored by the event log in micro-batches and compacted into days: per day the deliveries and the
    messages told apart by their hash."""
    from letrado.session import scratch_path
    from letrado.streaming.merge_table import EventLog, in_batches
    log = EventLog(spark, scratch_path(spark, "event-log"))
    events = _events(spark, d).withColumn("_received_at", F.col("event_timestamp").cast("timestamp"))
    events = events.where(F.col("is_valid")).select("event_id", "_message_hash", "_received_at")
    for i, batch in enumerate(in_batches(events, 3)):
        log.append(batch, "events", i)
        if i == 1:
            log.compact()
    log.append(events, "again", 0)        # another stream delivers every message once more
    log.compact()
    return (log.deliveries().groupBy(F.col("_day").alias("day"))
            .agg(F.count(F.lit(1)).alias("n_deliveries"), F.count_distinct("_message_hash").alias("n_messages")))


@query("stream_accounting")
def q_stream_accounting(spark, d):
    """Deliveries by outcome: received = stored + redelivered + quarantined by reason."""
    from letrado.streaming.upsert import stream_accounting
    return stream_accounting(_events(spark, d))


# -- step 8: observability -----------------------------------------------------

@query("freshness")
def q_freshness(spark, d):
    from letrado.plans import observability as obs
    b = bronze(spark, d)
    ev = read_table(spark, d, "events").select(F.col("ts").alias("_ingestion_timestamp"))
    return obs.freshness({"indicador_alfabetizacao": b["indicador_alfabetizacao"],
                          "alunos": b["alunos"], "streaming": ev}, AS_OF)


@query("gold_completeness")
def q_gold_completeness(spark, d):
    from letrado.plans import observability as obs
    return obs.gold_completeness(spark, gold_tables(spark, d))


@query("alert_windows")
def q_alert_windows(spark, d):
    from letrado.plans import observability as obs
    return obs.alert_windows(obs.event_metrics(_events(spark, d)))


@query("ingestion_metrics")
def q_ingestion_metrics(spark, d):
    from letrado.plans import observability as obs
    return obs.ingestion_metrics(q_reject_counts(spark, d))


@query("reject_counts")
def q_reject_counts(spark, d):
    """Per entity: input rows, what each reject reason took, kept rows."""
    from letrado.plans import rejects
    b = bronze(spark, d)
    return rejects.reject_counts(b, silver.build_silver(b))


@query("rejected_rows")
def q_rejected_rows(spark, d):
    """The rejected rows kept aside, counted by entity and reason."""
    from letrado.plans import rejects
    b = bronze(spark, d)
    kept = rejects.rejected_rows(b, silver.build_silver(b))
    return kept.groupBy("entity", "reason").agg(F.count("row").alias("n_rows"))


def _run_events(spark, d) -> DataFrame:
    """The run-event log one pipeline run writes: one row per stage entity."""
    from letrado.plans import observability as obs
    from letrado.plans import quality, rejects
    b = bronze(spark, d)
    s = _checkpointed(silver.build_silver(b))
    g = gold.build_gold(s)
    m = materialize(obs.ingestion_metrics(rejects.reject_counts(b, s)), "metrics")
    run = F.lit("run_" + RUN_DATE.replace("-", ""))
    bronze_ev = m.select(run.alias("run_id"), F.lit("bronze").alias("stage"), "entity",
                         F.when(F.col("bronze_rows") > 0, F.lit("SUCCESS")).otherwise(F.lit("FAILED"))
                          .alias("status"))
    silver_ev = m.select(run.alias("run_id"), F.lit("silver").alias("stage"), "entity", "status")
    gold_ev = obs.table_row_counts(g).select(
        run.alias("run_id"), F.lit("gold").alias("stage"), F.col("table_name").alias("entity"),
        F.when(F.col("row_count") > 0, F.lit("SUCCESS")).otherwise(F.lit("FAILED")).alias("status"))
    summ = quality.quality_summary(quality.quality_report(_quality_sources(spark, d, (s, g)), spark=spark))
    quality_ev = summ.select(
        run.alias("run_id"), F.lit("quality").alias("stage"), F.lit("validation").alias("entity"),
        F.when(F.col("total") == 0, F.lit("FAILED_NO_CHECKS")).when(F.col("failed") > 0, F.lit("WARNINGS"))
         .otherwise(F.lit("SUCCESS")).alias("status"))
    return bronze_ev.unionByName(silver_ev).unionByName(gold_ev).unionByName(quality_ev)


@query("run_status")
def q_run_status(spark, d):
    """Stage statuses and the overall status of a run, from its event log."""
    from letrado.plans import observability as obs
    ev = _run_events(spark, d)
    stages = obs.stage_status(ev)
    overall = obs.run_status(ev).select("run_id", F.lit("overall").alias("stage"),
                                        F.col("overall_status").alias("status"))
    return stages.unionByName(overall)


# -- step 9: machine learning --------------------------------------------------

def _features(spark, d):
    return features.build_ml_features(gold_tables(spark, d)["indicador_municipio"])


def _features_materialized(spark, d):
    # model fitting passes over its input many times: materialise it once
    return materialize(_features(spark, d), "ml_features")


@query("ml_class_weights")
def q_ml_class_weights(spark, d):
    from letrado.functions.scalar import round2
    from letrado.plans import ml
    w = ml.class_weights(_features(spark, d))
    return w.select(ml.LABEL, "n_class", "n", round2("weight").alias("weight"))


@query("ml_predict")
def q_ml_predict(spark, d):
    from letrado.plans import ml
    f = _features_materialized(spark, d)
    model, _ = ml.train(f)
    return ml.predict(model, f)


@query("ml_evaluate")
def q_ml_evaluate(spark, d):
    from letrado.plans import ml
    model, test = ml.train(_features_materialized(spark, d))
    return ml.evaluate(model, test)


@query("ml_split")
def q_ml_split(spark, d):
    """Labelled rows and goals met on the training and the held-out side."""
    from letrado.plans import ml
    return ml.split_counts(_features(spark, d))


@query("ml_predict_checks")
def q_ml_predict_checks(spark, d):
    from letrado.plans import ml
    return ml.prediction_checks(materialize(q_ml_predict(spark, d), "predictions"))


@query("ml_evaluate_checks")
def q_ml_evaluate_checks(spark, d):
    from letrado.plans import ml
    model, test = ml.train(_features_materialized(spark, d))
    return ml.evaluation_checks(ml.evaluate(model, test), test)


@query("ml_cluster_totals")
def q_ml_cluster_totals(spark, d):
    from letrado.plans import ml
    return ml.cluster_totals(q_ml_clusters(spark, d))


@query("uf_convergence")
def q_uf_convergence(spark, d):
    from letrado.plans import ml
    return ml.uf_convergence(gold_tables(spark, d)["evolucao_uf"])


@query("ml_clusters")
def q_ml_clusters(spark, d):
    from letrado.plans import ml
    return ml.vulnerability_clusters(_features_materialized(spark, d))
