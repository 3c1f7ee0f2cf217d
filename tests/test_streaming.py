import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from letrado.plans import silver
from letrado.queries import bronze
from letrado.sources import mapping
from letrado.streaming.events import decode_base64, enrich_events, prepare_events
from letrado.streaming.runner import start_event_stream
from letrado.streaming.upsert import IndicadorUpsert, compact, current_indicador, event_log, stream_accounting


def msg(event_id, id_mun, ano, ind, ts="2024-01-02T00:00:00.000000", etype="INDICADOR_ATUALIZADO"):
    payload = {"ano": ano, "indicador_alfabetizacao": ind, "fonte": "t"}
    if id_mun is not None:
        payload["id_municipio"] = id_mun
    return json.dumps({"event_id": event_id, "event_type": etype, "timestamp": ts, "payload": payload})


def events_of(spark, lines):
    return prepare_events(spark.createDataFrame([(x,) for x in lines], "value string"))


def test_validate_three_cases(spark):
    ev = events_of(spark, [msg("1", "3550308", 2024, 82.5), msg("2", None, 2024, 82.5),
                           msg("3", "3550308", 2024, 150.0)])
    got = sorted(rows(ev, "event_id", "is_valid", "reject_reason"))
    assert got == [("1", True, None), ("2", False, "sem_id_municipio"), ("3", False, "indicador_fora_do_intervalo")]


def test_corrupt_line_and_textual_value_are_rejected_per_row(spark):
    ev = events_of(spark, [msg("1", "1", 2024, 10.0), "{not json", msg("2", "1", 2024, "x"),
                           msg("3", "1", 2024, 20.0)])
    got = sorted(rows(ev, "is_valid", "reject_reason"), key=str)
    assert got == [(False, "indicador_invalido"), (False, "registro_corrompido"), (True, None), (True, None)]


def test_defaults_and_enrich(spark):
    ev = events_of(spark, [json.dumps({"event_id": "9", "payload": {"id_municipio": "1"}})])
    r = enrich_events(ev, F.lit("2024-01-31").cast("date")).first()
    assert r["ano"] == 2024 and r["_layer"] == "bronze_streaming" and r["_pipeline_version"] == "1.0.0"
    assert str(r["_processing_date"]) == "2024-01-31" and r["_source"] == "streaming_pubsub"


def test_base64_message_body(spark):
    df = spark.createDataFrame([("eyJhIjogMX0=",)], "data string")
    assert df.select(decode_base64("data")).first()[0] == '{"a": 1}'


def _write_lines(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")


def _base_silver(spark, root):
    b = bronze(spark, SF_SMALL)
    s = silver.build_silver(b, keep_lineage=True)
    s["municipios"].write.mode("overwrite").parquet(f"{root}/silver/municipios")
    s["indicador_alfabetizacao"].write.mode("overwrite").partitionBy("ano", "_bucket").parquet(f"{root}/silver/ind")
    return b, s


def _run(spark, root, src, ckpt):
    q = start_event_stream(spark, src, f"{root}/changes", f"{root}/quarantine", f"{root}/events", checkpoint=ckpt,
                           available_now=True, max_files_per_trigger=1)
    q.awaitTermination(600)
    assert q.exception() is None


def _current(spark, root):
    return current_indicador(spark, f"{root}/silver/ind", f"{root}/changes", spark.read.parquet(f"{root}/silver/municipios"))


def test_stream_upsert_matches_batch_form_and_replays(spark, tmp_root):
    b, s = _base_silver(spark, tmp_root)
    msgs = [r[0] for r in mapping.stream_messages(spark.read.parquet(f"{SF_SMALL}/events.parquet")).collect()]
    src = f"{tmp_root}/src"
    third = len(msgs) // 3
    _write_lines(f"{src}/a.json", msgs[:third])
    _write_lines(f"{src}/b.json", msgs[third:2 * third] + ["{broken", msg("x1", "1", 1996, "abc")])
    _write_lines(f"{src}/c.json", msgs[2 * third:])
    _run(spark, tmp_root, src, f"{tmp_root}/ckpt1")

    cols = silver.INDICADOR_COLS
    got = _current(spark, tmp_root).select(*cols)
    valid = events_of(spark, msgs).where("is_valid")
    want = silver.transform_indicador(b["indicador_alfabetizacao"], s["municipios"], stream=valid).select(*cols)
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0

    q = spark.read.parquet(f"{tmp_root}/quarantine")
    assert q.where("_message_id LIKE '%b.json#%' AND _received_at IS NOT NULL").count() >= 2
    log = spark.read.parquet(f"{tmp_root}/events")
    assert log.where("_message_id IS NULL").count() == 0
    assert log.select("_message_id").distinct().count() == log.count()         # one id per line, not per file
    reasons = {r[0] for r in q.select("reject_reason").distinct().collect()}
    assert {"registro_corrompido", "indicador_invalido", "sem_id_municipio"} <= reasons

    # replay every file from a fresh checkpoint: silver and the deduplicated log must not change
    before, stored = sorted(rows(got)), event_log(spark, f"{tmp_root}/events").count()
    _run(spark, tmp_root, src, f"{tmp_root}/ckpt2")
    assert sorted(rows(_current(spark, tmp_root).select(*cols))) == before
    assert event_log(spark, f"{tmp_root}/events").count() == stored
    assert spark.read.parquet(f"{tmp_root}/events").count() == 2 * log.count()  # the first stream's batches are still there

    # compaction writes a new folder with the same rows
    compact(spark, f"{tmp_root}/silver/ind", f"{tmp_root}/changes", s["municipios"], f"{tmp_root}/silver/ind2")
    assert sorted(rows(spark.read.parquet(f"{tmp_root}/silver/ind2").select(*cols))) == before
    with pytest.raises(ValueError):
        compact(spark, f"{tmp_root}/silver/ind", f"{tmp_root}/changes", s["municipios"], f"{tmp_root}/silver/ind")


NOW = "2024-01-05T00:00:00.000000"
CASES = {
    "no id": [[msg(None, str(i), 1996, 10.0 + i)] for i in range(4)],
    "no time": [[msg(f"t{i}", str(i), 1996, 10.0, ts=None)] for i in range(3)],
    "future": [[msg("f1", "1", 1996, 10.0, ts="2099-01-01T00:00:00")], [msg("f2", "2", 1996, 20.0, ts=NOW)],
               [msg("f3", "3", 1996, 30.0, ts="1970-01-01T00:00:00")]],
    "late": [[msg("n", "1", 1996, 90.0, ts=NOW)], [msg("o", "1", 1996, 10.0, ts="2024-01-03T00:00:00.000000")]],
    "corrupt twice": [["{x", "{x"], ["{x"]],
    "redelivered": [[msg("r", "1", 1996, 50.0), msg("r", "1", 1996, 50.0)], [msg("r", "1", 1996, 50.0)]],
}


@pytest.mark.parametrize("case", sorted(CASES))
@pytest.mark.parametrize("separate_runs", [True, False])
def test_every_delivery_is_stored_quarantined_or_a_redelivery(spark, tmp_root, case, separate_runs):
    src, batches = f"{tmp_root}/src", CASES[case]
    for i, lines in enumerate(batches):
        _write_lines(f"{src}/{i}.json", lines)
        if separate_runs:
            _run(spark, tmp_root, src, f"{tmp_root}/ckpt")
    if not separate_runs:
        _run(spark, tmp_root, src, f"{tmp_root}/ckpt")
    log = spark.read.parquet(f"{tmp_root}/events")
    quarantine = spark.read.parquet(f"{tmp_root}/quarantine")
    stored, logged, aside = event_log(spark, f"{tmp_root}/events").count(), log.count(), quarantine.count()
    sent = [line for lines in batches for line in lines]
    assert logged + aside == len(sent)
    want = {"no id": (4, 0), "no time": (0, 3), "future": (1, 2), "late": (2, 0), "corrupt twice": (0, 3), "redelivered": (1, 0)}
    assert (stored, aside) == want[case]
    counted = {(r.outcome, r.reason): r.n_events for r in
               stream_accounting(prepare_events(spark.createDataFrame([(x,) for x in sent], "value string")
                                                .withColumn("_received_at", F.current_timestamp()))).collect()}
    assert counted["received", None] == len(sent)
    assert sum(n for (o, _), n in counted.items() if o != "received") == len(sent)
    assert counted.get(("stored", None), 0) == stored
    assert sum(n for (o, _), n in counted.items() if o == "quarantined") == aside


def test_late_older_event_loses(spark, tmp_root):
    _base_silver(spark, tmp_root)
    src = f"{tmp_root}/src"
    for i, lines in enumerate(CASES["late"]):
        _write_lines(f"{src}/{i}.json", lines)
        _run(spark, tmp_root, src, f"{tmp_root}/ckpt")
    r = _current(spark, tmp_root).where("id_municipio = '1' AND ano = 1996").collect()
    assert len(r) == 1 and r[0]["indicador_alfabetizacao"] == 90.0


def test_read_error_is_raised_and_silver_stays(spark, tmp_root):
    _base_silver(spark, tmp_root)
    base = f"{tmp_root}/silver/ind"
    files = [os.path.join(d, f) for d, _, names in os.walk(base) for f in names if f.endswith(".parquet")]
    before = {f: open(f, "rb").read() for f in files}
    for f in files:
        if "ano=1995" in f:
            open(f, "wb").write(b"damaged")
    src = f"{tmp_root}/src"
    _write_lines(f"{src}/1.json", [msg("n", "1", 1996, 90.0)])
    _run(spark, tmp_root, src, f"{tmp_root}/ckpt")                # the stream does not touch silver
    assert all(open(f, "rb").read() == data for f, data in before.items() if "ano=1995" not in f)
    with pytest.raises(Exception):
        _current(spark, tmp_root).count()
    with pytest.raises(FileNotFoundError):
        current_indicador(spark, f"{tmp_root}/none", f"{tmp_root}/nothing", spark.read.parquet(f"{tmp_root}/silver/municipios"))


def test_interrupted_write_leaves_silver_whole(spark, tmp_root, monkeypatch):
    _base_silver(spark, tmp_root)
    before = sorted(rows(spark.read.parquet(f"{tmp_root}/silver/ind").select(*silver.INDICADOR_COLS)))
    src = f"{tmp_root}/src"
    _write_lines(f"{src}/1.json", [msg("n", "1", 1996, 90.0)])
    real = IndicadorUpsert._write

    def broken(df, path):
        if "/changes/" in path:
            raise OSError("disk gone")
        real(df, path)

    monkeypatch.setattr(IndicadorUpsert, "_write", staticmethod(broken))
    q = start_event_stream(spark, src, f"{tmp_root}/changes", f"{tmp_root}/quarantine", f"{tmp_root}/events",
                           checkpoint=f"{tmp_root}/ckpt", available_now=True)
    with pytest.raises(Exception):
        q.awaitTermination(600)
    assert sorted(rows(spark.read.parquet(f"{tmp_root}/silver/ind").select(*silver.INDICADOR_COLS))) == before
    monkeypatch.setattr(IndicadorUpsert, "_write", staticmethod(real))
    _run(spark, tmp_root, src, f"{tmp_root}/ckpt")                # the batch is replayed
    assert _current(spark, tmp_root).where("id_municipio = '1' AND ano = 1996").first()["indicador_alfabetizacao"] == 90.0
    assert event_log(spark, f"{tmp_root}/events").count() == 1
