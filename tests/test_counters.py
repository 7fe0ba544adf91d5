"""Counters, totals, caps and merges on hand-made frames."""

import pytest

from adlens.operators import counters
from adlens.sinks import merge

# The reference's load-generator record (one exposure of one deal).
RECORD = ('{"dealid":"1161124569789370368","dsp_id":"10001","sltcustomtopic":"sltadxlog-adx-bg",'
          '"local-month":"201912","local-day":"25"}')


def test_971_copies_count_971(spark):
    raw = spark.createDataFrame([(RECORD,)] * 971 + [("{bad",), ('{"dealid":"1"}',)], "value string")
    got = {r["dealid"]: r["total"] for r in counters.deal_counts(counters.keep_topic(raw)).collect()}
    assert got == {"1161124569789370368": 971}


def test_cap_check_is_strict(spark):
    totals = spark.createDataFrame([("a", "2024-01-01", 70), ("b", "2024-01-01", 71)],
                                   "dealid string, now_time string, total long")
    caps = spark.createDataFrame([("a", "2024-01-01", 100, 0), ("b", "2024-01-01", 100, 0)],
                                 "dealid string, now_time string, dealidnum int, stop int")
    flags = counters.near_cap(totals, caps)
    assert [r["doc_id"] for r in flags.collect()] == ["b2024-01-01"]
    stops = {r["dealid"]: r["stop"] for r in counters.apply_stop_flags(caps, flags).collect()}
    assert stops == {"a": 0, "b": 1}


def test_running_total_adds_stored(spark):
    batch = spark.createDataFrame([("a", "d", 3), ("b", "d", 2)], "dealid string, now_time string, total long")
    stored = spark.createDataFrame([("a", "d", 10)], "dealid string, now_time string, total int")
    got = {r["dealid"]: r["total"] for r in counters.add_to_totals(batch, stored).collect()}
    assert got == {"a": 13, "b": 2}


def test_upsert_replaces_measures_and_raises_on_duplicates(spark):
    target = spark.createDataFrame([("a", "x", 1), ("b", "y", 2)], "k string, attr string, m long")
    upd = spark.createDataFrame([("a", "new", 5), ("c", "z", 7)], "k string, attr string, m long")
    got = sorted(tuple(r) for r in merge.upsert(target, upd, ["k"], ["m"]).collect())
    assert got == [("a", "x", 5), ("b", "y", 2), ("c", "z", 7)]
    dup = spark.createDataFrame([("a", "n", 1), ("a", "n", 2)], "k string, attr string, m long")
    with pytest.raises(merge.DuplicateKeyError):
        merge.upsert(target, dup, ["k"], ["m"])


def test_counter_add(spark):
    cur = spark.createDataFrame([("adxhappen:1", 5)], "key string, value long")
    delta = spark.createDataFrame([("adxhappen:1", 2), ("adxhappen:2", 3), ("adxhappen:2", 1)],
                                  "key string, value long")
    got = dict((r["key"], r["value"]) for r in merge.counter_add(cur, delta).collect())
    assert got == {"adxhappen:1": 7, "adxhappen:2": 4}


def test_null_deal_is_its_own_group_and_kept_out_of_upserts(spark):
    from pyspark.sql import functions as F
    recs = spark.createDataFrame([('{"sltcustomtopic":"sltadxlog-adx-bg"}',)] * 3 +
                                 [('{"dealid":"9","sltcustomtopic":"sltadxlog-adx-bg"}',)], "value string")
    counts = {r["dealid"]: r["total"] for r in counters.deal_counts(counters.keep_topic(recs)).collect()}
    assert counts == {None: 3, "9": 1}
    day = counters.day_counts(counters.keep_topic(recs), "2024-01-01")
    target = spark.createDataFrame([], "dealid string, now_time string, total long")
    merged = merge.upsert(target, day.filter(F.col("dealid").isNotNull()), ["dealid", "now_time"], ["total"])
    assert [(r["dealid"], r["total"]) for r in merged.collect()] == [("9", 1)]


def test_malformed_record_dropped_by_topic_filter_but_null_in_parse(spark):
    from adlens.streaming.deal_stream import parsed_deals
    raw = spark.createDataFrame([(1, "{bad view"), (2, '{"dealid":"5","dsp_id":10001}')], "event_id long, value string")
    assert counters.keep_topic(raw).count() == 0
    got = {r["event_id"]: r["dealid"] for r in parsed_deals(raw).collect()}
    assert got == {1: None, 2: "5"}


def test_flag_doc_id_and_missing_cap_rows_are_ignored(spark):
    caps = spark.createDataFrame([("1", "2024-01-02", 40, 0)], "dealid string, now_time string, dealidnum int, stop int")
    flagged = spark.createDataFrame([("1", "2024-01-02", "12024-01-02"), ("7", "2024-01-02", "72024-01-02")],
                                    "dealid string, now_time string, doc_id string")
    out = counters.apply_stop_flags(caps, flagged).collect()
    assert [(r["dealid"], r["stop"]) for r in out] == [("1", 1)]


def test_upsert_can_combine_duplicates(spark):
    target = spark.createDataFrame([("a", "x", 1)], "k string, attr string, m long")
    dup = spark.createDataFrame([("a", "p", 2), ("a", "q", 3), ("b", "r", 4)], "k string, attr string, m long")
    got = sorted(tuple(r) for r in merge.upsert(target, dup, ["k"], ["m"], combine="sum").collect())
    assert got == [("a", "x", 5), ("b", "r", 4)]
