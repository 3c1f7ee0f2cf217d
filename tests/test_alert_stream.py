"""Streamed alert windows and bounded redelivery state against their batch forms."""

import time

import pytest
from pyspark.sql import functions as F

from conftest import rows
from letrado.plans.observability import alert_windows, event_metrics
from letrado.sources.versioned import VersionedTable
from letrado.streaming.alerts import LATE, UNDATED, AlertWindows, start_alert_stream
from letrado.streaming.events import prepare_events
from letrado.streaming.merge_table import EventLog, IndicadorTable
from letrado.streaming.redelivery import flag_redeliveries, use_rocksdb
from letrado.streaming.runner import event_source, run_stream_for, start_versioned_stream
from test_streaming import _base_silver, _write_lines, events_of, msg


def at(minute, ok=True, event="e"):
    return msg(f"{event}{minute}", "1", 1996, 50.0 if ok else 500.0, ts=f"2024-01-02T10:{minute:02d}:00.000000")


BATCHES = [
    [at(0), at(1, False), at(2, False), msg("u1", "1", 1996, 5.0, ts=None)],
    [at(3, False), at(16), at(17)],                                     # 10:00-10:05 ends before the next watermark (10:07)
    [at(4, False, "late"), at(6, False, "open"), at(18), "{corrupt"],   # the first is late; 10:05-10:10 is still open
    [at(59), at(16, False, "more")],
    [at(20, event="late"), msg("u2", None, 1996, 5.0, ts=None)],
]
LATE_TIMES = {"2024-01-02 10:04:00", "2024-01-02 10:20:00"}


def metrics_of(spark, lines):
    return event_metrics(events_of(spark, lines))


def check(spark, alerts):
    everything = metrics_of(spark, [x for b in BATCHES for x in b])
    late = alerts.late()
    assert {str(r["ts"]) for r in late.where(F.col("reason") == LATE).collect()} == LATE_TIMES
    assert late.where(F.col("reason") == UNDATED).count() == everything.where("ts IS NULL").count() == 3
    in_time = everything.exceptAll(late.drop("reason"))
    want = alert_windows(in_time)
    assert sorted(rows(alerts.windows().select(*want.columns)), key=str) == sorted(rows(want), key=str)
    # windows and side table together are the batch form over all metrics
    sums = alerts.windows().agg(F.sum("n_events")).first()[0] + late.count()
    assert sums == everything.count()


def test_streamed_windows_equal_the_batch_form_with_late_ones_aside(spark, tmp_root):
    src, ckpt = f"{tmp_root}/src", f"{tmp_root}/ckpt"
    for i, lines in enumerate(BATCHES):
        _write_lines(f"{src}/{i}.json", lines)
        stream = event_metrics(prepare_events(event_source(spark, src, max_files_per_trigger=1)))
        q = start_alert_stream(spark, stream, f"{tmp_root}/alerts", ckpt, available_now=True, compact_every=2)
        q.awaitTermination(600)
        assert q.exception() is None
    alerts = AlertWindows(spark, f"{tmp_root}/alerts")
    check(spark, alerts)
    before = sorted(rows(alerts.windows()), key=str)
    alerts.compact()
    assert sorted(rows(alerts.windows()), key=str) == before and alerts.table.changes().count() == 0


class Crash(Exception):
    pass


def test_a_batch_run_again_after_a_crash_decides_as_before(spark, tmp_root, monkeypatch):
    alerts = AlertWindows(spark, f"{tmp_root}/alerts")
    alerts.create()
    real = VersionedTable.append
    for i, lines in enumerate(BATCHES):
        def broken(self, *args, **more):
            if self.path.endswith("/windows"):
                raise Crash
            return real(self, *args, **more)

        monkeypatch.setattr(VersionedTable, "append", broken)          # between the side table and the windows
        with pytest.raises(Crash):
            alerts.add(metrics_of(spark, lines), "s", i)
        monkeypatch.setattr(VersionedTable, "append", real)
        for _ in range(2):
            alerts.add(metrics_of(spark, lines), "s", i)
    check(spark, alerts)


# -- redelivery ---------------------------------------------------------------------------

def run(spark, root, retention=3600.0):
    q = start_versioned_stream(spark, f"{root}/src", f"{root}/ind", f"{root}/quarantine", f"{root}/events", checkpoint=f"{root}/ckpt",
                               available_now=True, max_files_per_trigger=1, compact_every=0, retention_seconds=retention)
    run_stream_for(q, 600)
    assert q.exception() is None
    return q


def flags(spark, root):
    log = EventLog(spark, f"{root}/events").deliveries()
    return sorted((r["event_id"], r["_redelivery"]) for r in log.collect())


def test_redeliveries_are_flagged_on_arrival_and_after_a_restart(spark, tmp_root):
    _, s = _base_silver(spark, tmp_root)
    t = IndicadorTable(spark, f"{tmp_root}/ind")
    t.create(s["indicador_alfabetizacao"])
    late = msg("l", "1", 1996, 10.0, ts="2020-01-01T00:00:00.000000")
    _write_lines(f"{tmp_root}/src/1.json", [msg("a", "1", 1996, 90.0), msg("a", "1", 1996, 90.0), msg("b", "2", 1996, 40.0)])
    run(spark, tmp_root)
    assert flags(spark, tmp_root) == [("a", False), ("a", True), ("b", False)]
    _write_lines(f"{tmp_root}/src/2.json", [msg("b", "2", 1996, 40.0), late, "{broken", "{broken"])
    run(spark, tmp_root)                                               # a new query from the same checkpoint
    assert flags(spark, tmp_root) == [("a", False), ("a", True), ("b", False), ("b", True), ("l", False)]
    log = EventLog(spark, f"{tmp_root}/events")
    assert sorted(r["event_id"] for r in log.messages().collect()) == ["a", "b", "l"]
    assert EventLog(spark, f"{tmp_root}/quarantine").deliveries().where("_redelivery").count() == 1


def test_state_expires_after_the_retention(spark, tmp_root):
    use_rocksdb(spark)
    src = f"{tmp_root}/src"
    found = []

    def batch(i, lines):
        _write_lines(f"{src}/{i}.json", lines)
        events = flag_redeliveries(prepare_events(event_source(spark, src, max_files_per_trigger=1)), 20)
        q = (events.writeStream.foreachBatch(lambda df, n: found.append(sorted((r["event_id"], r["_redelivery"]) for r in df.collect())))
             .option("checkpointLocation", f"{tmp_root}/ckpt").trigger(availableNow=True).start())
        q.awaitTermination(600)
        assert q.exception() is None
        return q.recentProgress[-1]["stateOperators"][0]["numRowsTotal"]

    kept = batch(1, [msg(f"m{i}", "1", 1996, 50.0) for i in range(40)])
    assert found[-1] == sorted((f"m{i}", False) for i in range(40)) and kept >= 40
    time.sleep(21)
    left = batch(2, [msg("new", "1", 1996, 50.0)])
    assert left < kept / 4                                             # the first forty have gone
    batch(3, [msg("m0", "1", 1996, 50.0), msg("new", "1", 1996, 50.0)])
    assert ("m0", False) in found[-1]                                  # forgotten, so it counts as new
