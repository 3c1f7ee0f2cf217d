"""The pull queue: acknowledged on commit, delivered again until then, dead letters after five failed deliveries."""

import time

from letrado.sources.queue_source import FileQueue, queue_messages
from letrado.streaming.events import prepare_events
from test_streaming import msg


def run(spark, root, sink, until, **options):
    """Run the stream until ``until()`` holds or the query fails; whether it failed."""
    q = (queue_messages(spark, f"{root}/queue", **options).writeStream.foreachBatch(sink)
         .option("checkpointLocation", f"{root}/ckpt").trigger(processingTime="0 seconds").start())
    end = time.time() + 60
    try:
        while q.isActive and time.time() < end and not until():
            time.sleep(0.2)
        return q.exception() is not None
    finally:
        q.stop()


def test_messages_are_acknowledged_when_their_batch_is_committed(spark, tmp_root):
    queue, got = FileQueue(f"{tmp_root}/queue"), []
    queue.publish([msg("a", "1", 2020, 5.0), "{broken"])
    queue.publish([msg("b", "1", 2020, 6.0)])

    def sink(df, n):
        df.count()                                   # a second look at the batch is no second delivery
        events = prepare_events(df)
        got.extend((r["event_id"], r["_message_id"], r["_attempt"], r["is_valid"]) for r in events.collect())

    assert not run(spark, tmp_root, sink, lambda: len(got) == 3 and queue.segments() == [2], segments_per_batch=1)
    assert sorted(got, key=str) == [("a", "1/0", 1, True), ("b", "2/0", 1, True), (None, "1/1", 1, False)]
    assert queue.dead_letters() == []
    queue.publish([msg("c", "1", 2020, 7.0)])        # a later run goes on where this one ended
    assert not run(spark, tmp_root, sink, lambda: len(got) > 3 and queue.segments() == [3])
    assert [g[0] for g in got[3:]] == ["c"] and queue.segments() == [3]       # 2 was acknowledged when 3 was taken


def test_an_uncommitted_batch_comes_again_and_dies_after_five_deliveries(spark, tmp_root):
    queue, seen, got = FileQueue(f"{tmp_root}/queue"), [], []
    queue.publish(["poison", "beside it"])

    def sink(df, n):
        batch = [(r["value"], r["_attempt"]) for r in df.collect()]
        seen.extend(batch)
        if any(v == "poison" for v, _ in batch):
            raise ValueError("cannot process")
        got.extend(v for v, _ in batch)

    for attempt in range(1, 6):
        assert run(spark, tmp_root, sink, lambda: False)
        assert seen[-1][1] == attempt and queue.segments() == [1] and queue.attempts(1) == attempt
    queue.publish(["after"])
    assert not run(spark, tmp_root, sink, lambda: "after" in got)
    assert got == ["after"] and queue.dead_letters() == ["poison", "beside it"]
    assert [a for v, a in seen if v == "poison"] == [1, 2, 3, 4, 5]
