"""Versioned tables: pinned readers, atomic commits, crashes at every step, compaction, vacuum, idempotent batches."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from letrado.plans import silver
from letrado.queries import bronze
from letrado.sources.versioned import CommitConflict, VersionedTable, file_slots
from letrado.streaming.events import prepare_events
from letrado.streaming.merge_table import EventLog, IndicadorTable, in_batches
from letrado.streaming.runner import start_versioned_stream
from test_streaming import _write_lines, events_of, msg


def numbers(spark, *values, part="p"):
    return spark.createDataFrame([(v, part, f"row {v}") for v in values], "n int, part string, text string")


def latest(df):
    """Merge rule of these tests: per n the longest text."""
    return df.groupBy("n", "part").agg(F.max("text").alias("text"))


@pytest.fixture()
def table(spark, tmp_root):
    t = VersionedTable(spark, f"{tmp_root}/table")
    assert t.create(numbers(spark, 1).schema, ["part"]) and not t.create(numbers(spark, 1).schema, ["part"])
    return t


def held(df):
    return sorted(r["n"] for r in df.collect())


def test_reader_keeps_its_version_through_appends_and_a_compaction(spark, table):
    table.append(numbers(spark, 1, 2), "s", 0)
    table.append(numbers(spark, 3, part="q"), "s", 1)
    pinned, version = table.rows(), table.manifest()["version"]
    assert held(pinned) == [1, 2, 3]
    table.append(numbers(spark, 4), "s", 2)
    table.rewrite(latest)
    assert held(pinned) == [1, 2, 3] and held(table.rows(version)) == [1, 2, 3]     # during and after the compaction
    assert held(table.rows()) == [1, 2, 3, 4] and table.changes().count() == 0
    newest = table.manifest()
    assert sorted(newest["retired"]) == sorted(f"changes/{f}" for f in table.manifest(newest["version"] - 1)["changes"])
    table.vacuum(keep_versions=10)
    assert held(table.rows(version)) == [1, 2, 3]
    table.vacuum(keep_versions=1)
    assert held(table.rows()) == [1, 2, 3, 4]
    assert not os.listdir(f"{table.path}/changes") and table.versions() == [newest["version"]]


def test_a_replayed_batch_is_taken_once(spark, table):
    v = table.append(numbers(spark, 1), "s", 0)
    assert table.append(numbers(spark, 1), "s", 0) == v
    table.rewrite(latest)
    table.append(numbers(spark, 1), "s", 0)          # also after its folder was absorbed
    table.append(numbers(spark, 9), "other", 0)
    assert held(table.rows()) == [1, 9]


class Crash(Exception):
    pass


@pytest.mark.parametrize("step", ["before the data", "after the data", "before the rename"])
@pytest.mark.parametrize("action", ["append", "rewrite"])
def test_a_crash_at_any_step_leaves_the_old_version(spark, table, monkeypatch, step, action):
    table.append(numbers(spark, 1), "s", 0)
    table.rewrite(latest)
    table.append(numbers(spark, 2), "s", 1)
    before = table.manifest()

    def crash(*_, **__):
        raise Crash

    if step == "before the rename":
        monkeypatch.setattr(VersionedTable, "_publish", crash)
    elif step == "after the data":
        monkeypatch.setattr(VersionedTable, "commit", crash)
    elif action == "append":
        monkeypatch.setattr(VersionedTable, "schema", crash)
    merge = crash if (step, action) == ("before the data", "rewrite") else latest
    with pytest.raises(Crash):
        if action == "append":
            table.append(numbers(spark, 3), "s", 2)
        else:
            table.rewrite(merge)
    monkeypatch.undo()
    assert table.manifest() == before and held(table.rows()) == [1, 2]
    if action == "append":
        table.append(numbers(spark, 3), "s", 2)      # the replay
    table.rewrite(latest)
    assert held(table.rows()) == ([1, 2, 3] if action == "append" else [1, 2])
    stray = table.vacuum(keep_versions=1, grace_seconds=0)
    assert held(table.rows()) == ([1, 2, 3] if action == "append" else [1, 2])
    assert step == "before the data" or stray
    named = {f.split("/")[0] for fs in table.manifest()["base"].values() for f in fs}
    assert {g for g in os.listdir(f"{table.path}/base") if os.listdir(f"{table.path}/base/{g}")} - {"_SUCCESS"} >= named


def test_of_two_writers_one_wins_and_the_other_builds_on_it(spark, table):
    mine, theirs = VersionedTable(spark, table.path), VersionedTable(spark, table.path)
    raced = []

    def build(current):
        if not raced:                                # the other writer commits between our read and our rename
            raced.append(theirs.append(numbers(spark, 7), "theirs", 0))
        return {"operation": "note", "applied": {**current["applied"], "mine": 5}}

    mine.commit(build)
    now = table.manifest()
    assert now["applied"] == {"theirs": 0, "mine": 5} and held(table.rows()) == [7]


def test_changes_appended_during_a_compaction_stay_pending(spark, table):
    table.append(numbers(spark, 1), "s", 0)

    def slow(rows_):
        VersionedTable(spark, table.path).append(numbers(spark, 2), "s", 1)
        return latest(rows_)

    table.rewrite(slow)
    assert held(table.rows()) == [1, 2] and held(table.changes()) == [2]


def test_two_compactions_of_one_partition_conflict(spark, table):
    table.append(numbers(spark, 1), "s", 0)

    def other_first(rows_):
        VersionedTable(spark, table.path).rewrite(latest)
        return latest(rows_)

    with pytest.raises(CommitConflict):
        table.rewrite(other_first)
    assert held(table.rows()) == [1]


def test_only_touched_partitions_are_rewritten(spark, table):
    table.append(numbers(spark, 1, part="a").unionByName(numbers(spark, 2, part=None)), "s", 0)
    table.rewrite(latest)
    before = table.manifest()["base"]
    table.append(numbers(spark, 3, part="a=/b c"), "s", 1)
    table.append(numbers(spark, 4, part="a"), "s", 2)
    table.rewrite(latest)
    after = table.manifest()["base"]
    untouched = "part=__HIVE_DEFAULT_PARTITION__"
    assert after[untouched] == before[untouched] and after["part=a"] != before["part=a"] and len(after) == 3
    assert sorted(rows(table.rows(), "n", "part"), key=str) == [(1, "a"), (2, None), (3, "a=/b c"), (4, "a")]


# -- the stream's tables -------------------------------------------------------------

@pytest.fixture(scope="module")
def literacy(spark):
    b = bronze(spark, SF_SMALL)
    s = silver.build_silver(b, keep_lineage=True)
    from letrado.sources import mapping
    events = prepare_events(mapping.stream_messages(spark.read.parquet(f"{SF_SMALL}/events.parquet"))).where("is_valid")
    return b, s["municipios"].cache(), s["indicador_alfabetizacao"].cache(), events.cache()


def test_merge_table_equals_the_batch_form_at_every_version(spark, tmp_root, literacy):
    b, municipios, ind, events = literacy
    cols = silver.INDICADOR_COLS
    t = IndicadorTable(spark, f"{tmp_root}/ind")
    assert t.create(ind) and not t.create(ind)
    want = silver.transform_indicador(b["indicador_alfabetizacao"], municipios, stream=events).select(*cols)
    for i, part in enumerate(in_batches(events, 3)):
        t.upsert(part, "s", i)
        if i == 1:
            t.compact()
    final = t.table.manifest()["version"]
    assert sorted(rows(t.current(municipios).select(*cols))) == sorted(rows(want))
    t.compact()
    assert sorted(rows(t.current(municipios).select(*cols))) == sorted(rows(want)) == sorted(rows(t.current(municipios, final).select(*cols)))
    assert t.table.changes().count() == 0
    base = t.table.base()
    assert base.count() == base.select("id_municipio", "ano").distinct().count()


def test_a_late_older_event_loses_after_a_compaction(spark, tmp_root, literacy):
    _, municipios, ind, _ = literacy
    t = IndicadorTable(spark, f"{tmp_root}/ind")
    t.create(ind)
    t.upsert(events_of(spark, [msg("n", "1", 1996, 90.0, ts="2024-01-05T00:00:00")]), "s", 0)
    t.compact()
    t.upsert(events_of(spark, [msg("o", "1", 1996, 10.0, ts="2024-01-03T00:00:00")]), "s", 1)
    got = t.current(municipios).where("id_municipio = '1' AND ano = 1996").collect()
    assert [r["indicador_alfabetizacao"] for r in got] == [90.0]


def test_event_log_is_compacted_to_few_files_of_the_target_size(spark, tmp_root, literacy):
    events = literacy[3].withColumn("_received_at", F.col("event_timestamp").cast("timestamp"))
    log = EventLog(spark, f"{tmp_root}/log")
    batches = 12
    for i, part in enumerate(in_batches(events, batches)):
        log.append(part.repartition(3), "s", i)
    want = sorted(rows(log.deliveries(), "event_id"), key=str)
    days = log.deliveries().select("_day").distinct().count()
    files, size = log.table.sizes("changes")
    assert files == 3 * batches
    log.compact()
    log.table.vacuum(keep_versions=1)
    now_files, now_size = log.table.sizes("base")
    assert log.table.sizes("changes") == (0, 0) and days <= now_files <= days + file_slots(size, log.target_bytes) < files
    assert now_size < size                                        # the same rows in fewer, larger files
    assert sorted(rows(log.deliveries(), "event_id"), key=str) == want

    # a full day is added to, a day with room is rewritten
    small = EventLog(spark, f"{tmp_root}/log", target_bytes=1)
    day = log.deliveries().select(F.min("_day")).first()[0]
    before = small.table.manifest()["base"]
    small.append(events.where(F.to_date("_received_at") == F.lit(day)).limit(5), "s", batches)
    small.compact()
    after = small.table.manifest()["base"]
    assert len(after[f"_day={day}"]) == 2 and after[f"_day={day}"][0] == before[f"_day={day}"][0]
    assert {k: v for k, v in after.items() if k != f"_day={day}"} == {k: v for k, v in before.items() if k != f"_day={day}"}
    again = EventLog(spark, f"{tmp_root}/log")
    again.append(events.where(F.to_date("_received_at") == F.lit(day)).limit(5), "s", batches + 1)
    again.compact()
    assert len(again.table.manifest()["base"][f"_day={day}"]) == 1


def test_stream_into_versioned_tables_survives_a_crash_between_them(spark, tmp_root, literacy, monkeypatch):
    _, municipios, ind, _ = literacy
    t = IndicadorTable(spark, f"{tmp_root}/ind")
    t.create(ind)
    src = f"{tmp_root}/src"
    _write_lines(f"{src}/1.json", [msg("n", "1", 1996, 90.0), "{broken", msg("m", "2", 1996, 30.0)])

    def run():
        q = start_versioned_stream(spark, src, f"{tmp_root}/ind", f"{tmp_root}/quarantine", f"{tmp_root}/events",
                                   checkpoint=f"{tmp_root}/ckpt", available_now=True, max_files_per_trigger=1, compact_every=1)
        q.awaitTermination(600)
        return q.exception()

    real = IndicadorTable.upsert
    monkeypatch.setattr(IndicadorTable, "upsert", lambda *_: (_ for _ in ()).throw(OSError("disk gone")))
    with pytest.raises(Exception):
        q = start_versioned_stream(spark, src, f"{tmp_root}/ind", f"{tmp_root}/quarantine", f"{tmp_root}/events",
                                   checkpoint=f"{tmp_root}/ckpt", available_now=True)
        q.awaitTermination(600)
    monkeypatch.setattr(IndicadorTable, "upsert", real)
    assert run() is None                              # the batch is replayed: the first two tables had it already
    _write_lines(f"{src}/2.json", [msg("r", "1", 1996, 20.0, ts="2024-01-01T00:00:00"), "{broken"])
    assert run() is None
    assert EventLog(spark, f"{tmp_root}/events").deliveries().count() == 3
    assert EventLog(spark, f"{tmp_root}/quarantine").deliveries().count() == 2
    got = t.current(municipios).where("id_municipio = '1' AND ano = 1996").first()
    assert got["indicador_alfabetizacao"] == 90.0
    assert t.table.manifest()["changes"] == []        # compacted after every batch
