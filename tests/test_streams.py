"""Structured Streaming: multi-batch totals equal the batch answer; replays do not double-count."""

import os

from pyspark.sql import functions as F

from adlens.operators import counters
from adlens.sources import testdata as td
from adlens.sources.streams import open_log_stream
from adlens.streaming import deal_stream

SF = "/root/testdata/sf0.01"


def split_events(spark, out, parts=4):
    ev = td.table(spark, SF, "events")
    for i in range(parts):
        ev.filter(F.col("event_id") % parts == i).coalesce(1).write.parquet(os.path.join(out, f"part{i}"))
    return ev.schema


def stream_from(spark, src_root, schema, files_per_trigger=1):
    ev = open_log_stream(spark, "parquet", os.path.join(src_root, "*"), schema=schema,
                         options={"maxFilesPerTrigger": str(files_per_trigger)})
    return td.to_raw_stream(ev)


def batch_answer(spark):
    raw = td.raw_stream(spark, SF)
    return counters.day_counts(counters.keep_topic(raw), F.to_date("ts").cast("string"))


def test_multi_batch_totals_equal_batch(spark, tmp_out):
    schema = split_events(spark, os.path.join(tmp_out, "src"))
    q, out = deal_stream.run_deal_totals(spark, stream_from(spark, os.path.join(tmp_out, "src"), schema),
                                         out_path=os.path.join(tmp_out, "out"),
                                         checkpoint=os.path.join(tmp_out, "ckpt"))
    q.awaitTermination()
    (own,) = [d for d in os.listdir(out) if d.startswith("query=")]
    assert len([d for d in os.listdir(os.path.join(out, own)) if d.startswith("batch_id=")]) == 4
    got = deal_stream.latest_totals(spark, out)
    want = batch_answer(spark)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_restart_continues_from_checkpoint(spark, tmp_out):
    src = os.path.join(tmp_out, "src")
    ev = td.table(spark, SF, "events")
    ev.filter("event_id % 2 = 0").coalesce(1).write.parquet(os.path.join(src, "a"))
    kw = dict(out_path=os.path.join(tmp_out, "out"), checkpoint=os.path.join(tmp_out, "ckpt"))
    q, out = deal_stream.run_deal_totals(spark, stream_from(spark, src, ev.schema), **kw)
    q.awaitTermination()
    ev.filter("event_id % 2 = 1").coalesce(1).write.parquet(os.path.join(src, "b"))
    q, out = deal_stream.run_deal_totals(spark, stream_from(spark, src, ev.schema), **kw)
    q.awaitTermination()
    got, want = deal_stream.latest_totals(spark, out), batch_answer(spark)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_replayed_batch_is_idempotent(spark, tmp_out):
    sink = deal_stream.BatchLedgerSink(os.path.join(tmp_out, "out"))
    rows = spark.createDataFrame([("a", "d", 3)], "dealid string, now_time string, total long")
    sink(rows, 0)
    sink(rows, 0)
    sink(spark.createDataFrame([], rows.schema), 1)
    got = deal_stream.latest_totals(spark, os.path.join(tmp_out, "out")).collect()
    assert [(r["dealid"], r["total"]) for r in got] == [("a", 3)]


def test_read_add_write_sink_skips_replays_and_flags(spark, tmp_out):
    rec = '{"dealid":"7","sltcustomtopic":"sltadxlog-adx-bg"}'
    batch = spark.createDataFrame([(rec,)] * 5, "value string")
    caps = spark.createDataFrame([("7", "2024-01-01", 32, 0)], "dealid string, now_time string, dealidnum int, stop int")
    sink = deal_stream.ReadAddWriteSink(os.path.join(tmp_out, "state"), caps, os.path.join(tmp_out, "flags"),
                                        day="2024-01-01")
    sink(batch, 0)
    sink(batch, 0)  # replay: skipped
    assert sink.current(spark).collect()[0]["total"] == 5
    assert spark.read.parquet(os.path.join(tmp_out, "flags")).count() == 1  # 5 > 32 - 30
    sink(batch, 1)
    assert sink.current(spark).collect()[0]["total"] == 10


def test_parse_stream_keeps_malformed_as_null(spark, tmp_out):
    schema = split_events(spark, os.path.join(tmp_out, "src"), parts=2)
    q, out = deal_stream.run_parse_stream(spark, stream_from(spark, os.path.join(tmp_out, "src"), schema, 2),
                                          out_path=os.path.join(tmp_out, "out"),
                                          checkpoint=os.path.join(tmp_out, "ckpt"))
    q.awaitTermination()
    got = spark.read.parquet(out)
    assert got.count() == 10000
    bad = got.filter("event_id % 23 = 0").filter(F.col("dealid").isNotNull()).count()
    assert bad == 0


def test_processing_time_loop_and_graceful_stop(spark, tmp_out):
    schema = split_events(spark, os.path.join(tmp_out, "src"), parts=2)
    q, out = deal_stream.run_deal_totals(spark, stream_from(spark, os.path.join(tmp_out, "src"), schema, 1),
                                         out_path=os.path.join(tmp_out, "out"),
                                         checkpoint=os.path.join(tmp_out, "ckpt"),
                                         trigger={"processingTime": "1 second"}, day_mode="processing")
    q.processAllAvailable()
    deal_stream.stop_gracefully(q)
    assert not q.isActive
    got = deal_stream.latest_totals(spark, out)
    assert got.select("now_time").distinct().count() in (1, 2)  # processing date (2 if run across midnight)
    assert got.agg(F.sum("total")).first()[0] == counters.keep_topic(td.raw_stream(spark, SF)).count()


def test_compaction_keeps_totals_and_later_batches(spark, tmp_out):
    path = os.path.join(tmp_out, "out")
    sink = deal_stream.BatchLedgerSink(path)
    schema = "dealid string, now_time string, total long"
    sink(spark.createDataFrame([("a", "d", 3), ("b", "d", 1)], schema), 0)
    sink(spark.createDataFrame([("a", "d", 5)], schema), 1)
    assert deal_stream.compact_totals(spark, path) == 1
    sink(spark.createDataFrame([("b", "d", 4)], schema), 2)
    got = {r["dealid"]: r["total"] for r in deal_stream.latest_totals(spark, path).collect()}
    assert got == {"a": 5, "b": 4}


def test_event_day_watermark_counts_equal_batch(spark, tmp_out):
    schema = split_events(spark, os.path.join(tmp_out, "src"), parts=2)
    q, out = deal_stream.run_deal_totals(spark, stream_from(spark, os.path.join(tmp_out, "src"), schema, 2),
                                         out_path=os.path.join(tmp_out, "out"),
                                         checkpoint=os.path.join(tmp_out, "ckpt"), watermark="400 days")
    q.awaitTermination()
    got, want = deal_stream.latest_totals(spark, out), batch_answer(spark)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_read_add_write_redoes_a_batch_that_died_before_its_ledger_row(spark, tmp_out):
    rec = '{"dealid":"7","sltcustomtopic":"sltadxlog-adx-bg"}'
    batch = spark.createDataFrame([(rec,)] * 2, "value string")
    state = os.path.join(tmp_out, "state")
    sink = deal_stream.ReadAddWriteSink(state, day="2024-01-01")
    sink(batch, 0)
    # batch 1 wrote a (wrong) version but died before committing it in the ledger
    spark.createDataFrame([("7", "2024-01-01", 999)], "dealid string, now_time string, total long") \
        .write.parquet(os.path.join(state, "v=1"))
    sink(batch, 1)
    assert sink.current(spark).collect()[0]["total"] == 4
    assert sink.last_applied(spark) == 1


def test_watermarked_days_follow_the_session_time_zone(spark, tmp_out):
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        schema = split_events(spark, os.path.join(tmp_out, "src"), parts=2)
        q, out = deal_stream.run_deal_totals(spark, stream_from(spark, os.path.join(tmp_out, "src"), schema, 2),
                                             out_path=os.path.join(tmp_out, "out"),
                                             checkpoint=os.path.join(tmp_out, "ckpt"), watermark="400 days")
        q.awaitTermination()
        got = deal_stream.latest_totals(spark, out)
        raw = td.raw_stream(spark, SF)
        want = counters.day_counts(counters.keep_topic(raw), F.to_date(F.col("ts").cast("timestamp")).cast("string"))
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_read_add_write_adds_kv_counters(spark, tmp_out):
    root = tmp_out

    class FileKV:  # KV-client stand-in: records increments in a file per partition
        def __init__(self):
            self.ops = []

        def incrby(self, key, n):
            self.ops.append([key, n])

        def close(self):
            import json
            import uuid
            with open(os.path.join(root, f"kv-{uuid.uuid4().hex}.json"), "w") as f:
                json.dump(self.ops, f)

    rec = '{"dealid":"7","sltcustomtopic":"sltadxlog-adx-bg"}'
    sink = deal_stream.ReadAddWriteSink(os.path.join(tmp_out, "state"), day="2024-01-01", kv_connect=FileKV)
    sink(spark.createDataFrame([(rec,)] * 3, "value string"), 0)
    import glob
    import json
    ops = [op for p in glob.glob(os.path.join(root, "kv-*.json")) for op in json.load(open(p))]
    assert ops == [["adxhappen:7", 3]]


def test_totals_of_a_new_checkpoint_add_to_the_old_ones(spark, tmp_out):
    src, out = os.path.join(tmp_out, "src"), os.path.join(tmp_out, "out")
    ev = td.table(spark, SF, "events")
    for i in range(2):
        part = os.path.join(src, f"p{i}")
        ev.filter(F.col("event_id") % 2 == i).repartition(2).write.parquet(part)
        raw = td.to_raw_stream(open_log_stream(spark, "parquet", part, schema=ev.schema, options={"maxFilesPerTrigger": "1"}))
        q, _ = deal_stream.run_deal_totals(spark, raw, out_path=out, checkpoint=os.path.join(tmp_out, f"ckpt{i}"), compact_every=2 if i else None)
        q.awaitTermination()
    got, want = deal_stream.latest_totals(spark, out), batch_answer(spark)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert len([d for d in os.listdir(os.path.join(out, "_snapshot")) if d.startswith("snap=")]) == 1


def test_read_add_write_applies_batches_of_a_new_checkpoint_on_old_state(spark, tmp_out):
    schema = split_events(spark, os.path.join(tmp_out, "src"), parts=3)
    state = os.path.join(tmp_out, "state")
    day = F.to_date(F.col("ts").cast("timestamp")).cast("string")
    sink = deal_stream.ReadAddWriteSink(state, day=day)
    for i in range(2):
        q = deal_stream.run_read_add_write(spark, stream_from(spark, os.path.join(tmp_out, "src"), schema), sink,
                                           os.path.join(tmp_out, f"ckpt{i}"), {"availableNow": True})
        q.awaitTermination()
    want = batch_answer(spark).filter("dealid is not null").select("dealid", "now_time", (2 * F.col("total")).alias("total"))
    got = sink.current(spark)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    nulls = spark.read.parquet(os.path.join(state, "_null_deals"))
    assert nulls.agg(F.sum("total")).first()[0] == 2 * batch_answer(spark).filter("dealid is null").agg(F.sum("total")).first()[0]
    assert nulls.select("query").distinct().count() == 2


def test_emptied_state_raises(spark, tmp_out):
    import pytest
    os.makedirs(os.path.join(tmp_out, "out"))
    with pytest.raises(Exception, match="UNABLE_TO_INFER_SCHEMA"):
        deal_stream.latest_totals(spark, os.path.join(tmp_out, "out"))
