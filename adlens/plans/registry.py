"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Inputs are the TESTDATA tables, shaped like the reference's inputs by
``adlens.sources.testdata``; every query reads its tables whole.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlens.fixed import MISSING_MEDIA
from adlens.functions import scalar as fx
from adlens.operators import changes, counters
from adlens.operators import reports
from adlens.operators import segments as vs
from adlens.operators.lookup import left_lookup
from adlens.plans import oracle
from adlens.plans.incremental import IncrementalExposure
from adlens.schemas import STREAM_RECORD
from adlens.session import scratch_path
from adlens.sinks import merge, writers
from adlens.sinks.counters import EpochCounters, EpochCounterSink
from adlens.sources import index_table, log_stream
from adlens.sources import testdata as td
from adlens.sources.streams import open_log_stream
from adlens.streaming import day_state, deal_stream

# The report day used by the daily keys (the data covers January 2024).
RUN_DAY = reports.RunDay("20240115")
RUN_DATE = f"{RUN_DAY.month[:4]}-{RUN_DAY.month[4:]}-{RUN_DAY.day}"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


@register("bg_report_all", oracle.bg_report_all())
def bg_report_all(spark, sf):
    return reports.exposure_report_all(td.exposure_log(spark, sf), td.ssp_tag(spark, sf))


@register("bg_report_incremental", oracle.bg_report_all())
def bg_report_incremental(spark, sf):
    """R-2 in two runs over a growing log folder; the second reads only the new files."""
    root = scratch_path(spark, "exposure-log")
    log = td.exposure_log(spark, sf)
    state = IncrementalExposure(scratch_path(spark, "exposure-state"), "parquet")
    for half in (F.col("local-day") <= "15", F.col("local-day") > "15"):  # the first half of each month, then the rest
        # one file per day, its records in order: the first record of a day is that of the log
        days = log.filter(half).repartitionByRange(8, "local-month", "local-day").sortWithinPartitions("event_id")
        days.drop("event_id").write.mode("append").parquet(root)
        state.update(spark, root)
    return state.report(spark, td.ssp_tag(spark, sf))


@register("bg_report_daily", oracle.bg_report_daily(RUN_DAY.month, RUN_DAY.day))
def bg_report_daily(spark, sf):
    return reports.exposure_report_daily(td.exposure_log(spark, sf), td.ssp_tag(spark, sf), RUN_DAY)


@register("pv_success_daily", oracle.pv_success_daily(RUN_DAY.month, RUN_DAY.day))
def pv_success_daily(spark, sf):
    return reports.success_report_daily(td.request_log(spark, sf), td.ssp_tag(spark, sf), RUN_DAY)


@register("pv_success_all", oracle.pv_success_all())
def pv_success_all(spark, sf):
    return reports.success_report_all(td.request_log(spark, sf), td.ssp_tag(spark, sf),
                                      td.adx_order_dealid(spark, sf))


@register("pv_fail_daily", oracle.pv_fail_daily(RUN_DAY.month, RUN_DAY.day))
def pv_fail_daily(spark, sf):
    return reports.failure_report_daily(td.request_log(spark, sf), td.ssp_tag(spark, sf), RUN_DAY)


@register("pv_fail_all", oracle.pv_fail_all())
def pv_fail_all(spark, sf):
    return reports.failure_report_all(td.request_log(spark, sf), td.ssp_tag(spark, sf))


@register("report_run_all", oracle.report_run_all())
def report_run_all(spark, sf):
    """R-7: the three reports of the full run (the two request reports from one scan)."""
    success, fail = reports.request_reports_all(td.request_log(spark, sf), td.ssp_tag(spark, sf),
                                                td.adx_order_dealid(spark, sf))
    return reports.report_summary({"bg": bg_report_all(spark, sf), "success": success, "fail": fail})


# ------------------------------------------------------------------ counters, caps, sinks




@register("topic_filter", oracle.topic_filter())
def topic_filter(spark, sf):
    return counters.with_dealid(counters.keep_topic(td.raw_stream(spark, sf))).select("event_id", "dealid")


@register("deal_counts", oracle.deal_counts())
def deal_counts(spark, sf):
    """R-10: counts per deal over every record (no topic filter)."""
    return counters.deal_counts(td.raw_stream(spark, sf))


def _running_totals(spark, sf):
    batch = counters.day_counts(counters.keep_topic(td.raw_stream(spark, sf)),
                                F.to_date("ts").cast("string"))
    return counters.add_to_totals(batch, td.stored_totals(spark, sf))


@register("deal_running_total", oracle.deal_running_total())
def deal_running_total(spark, sf):
    return _running_totals(spark, sf)


@register("pacing_flags", oracle.pacing_flags())
def pacing_flags(spark, sf):
    return counters.near_cap(_running_totals(spark, sf), td.deal_caps(spark, sf))


@register("pacing_apply_flag", oracle.pacing_apply_flag())
def pacing_apply_flag(spark, sf):
    caps = td.deal_caps(spark, sf)
    return counters.apply_stop_flags(caps, counters.near_cap(_running_totals(spark, sf), caps))


@register("upsert_merge", oracle.upsert_merge())
def upsert_merge(spark, sf):
    updates = _running_totals(spark, sf).filter(F.col("dealid").isNotNull())
    target = td.stored_totals(spark, sf).withColumn("total", F.col("total").cast("bigint"))
    return merge.upsert(target, updates, ["dealid", "now_time"], ["total"])


@register("upsert_rerun", oracle.upsert_merge())
def upsert_rerun(spark, sf):
    """K-1 as a stored table, run three times with the same updates: the table of one run."""
    path = scratch_path(spark, "upsert")
    stored = td.stored_totals(spark, sf).withColumn("total", F.col("total").cast("bigint"))
    updates = _running_totals(spark, sf).filter(F.col("dealid").isNotNull())
    for rows in (stored, updates, updates, updates):
        merge.merge_partitions(spark, path, rows, ["dealid", "now_time"], ["total"], "now_time", scratch_path(spark, "upsert-stage"))
    return spark.read.schema(updates.schema).parquet(path)


@register("upsert_keeps_columns", oracle.upsert_keeps_columns())
def upsert_keeps_columns(spark, sf):
    """K-1 on a stored table with a column that the update does not have."""
    path = scratch_path(spark, "upsert")
    stored = td.stored_totals(spark, sf).withColumn("total", F.col("total").cast("bigint"))
    updates = _running_totals(spark, sf).filter(F.col("dealid").isNotNull())
    for rows in (stored.withColumn("note", F.concat(F.lit("deal "), "dealid")), updates):
        merge.merge_partitions(spark, path, rows, ["dealid", "now_time"], ["total"], "now_time", scratch_path(spark, "upsert-stage"))
    return spark.read.schema("dealid string, total bigint, note string, now_time string").parquet(path)


@register("null_deal_report", oracle.null_deal_report())
def null_deal_report(spark, sf):
    """D15: exposures without a deal, per day: what upserts and totals leave out."""
    from adlens.plans.jobs import split_null_keys
    counts = counters.day_counts(counters.keep_topic(td.raw_stream(spark, sf)), F.to_date("ts").cast("string"))
    return split_null_keys(counts, ["dealid"])[1].select("now_time", "total")


@register("counter_add", oracle.counter_add())
def counter_add(spark, sf):
    stored = td.stored_totals(spark, sf)
    current = stored.groupBy(fx.counter_key("dealid").alias("key")).agg(F.sum("total").alias("value"))
    # Counted straight by counter key, so counter_add's own grouping needs no new shuffle.
    recs = counters.with_dealid(counters.keep_topic(td.raw_stream(spark, sf)))
    delta = recs.groupBy(fx.counter_key("dealid").alias("key")).agg(F.count(F.lit(1)).alias("value"))
    return merge.counter_add(current, delta)


# ------------------------------------------------------------------ the index table

@register("index_scan_pushdown", oracle.index_scan())
def index_scan_pushdown(spark, sf):
    """SRC-2: exposures in an index table, read by SQL; filters and columns reach the source."""
    path = scratch_path(spark, "index")
    log = td.exposure_log(spark, sf).select("event_id", "dealid", "tag_id", "adx_material_id", "dsp_id", "advertiser_id")
    index_table.write_index(log, path, "overwrite", order=["dsp_id", "dealid"], block_rows=512)
    read = index_table.read_index(spark, path, ["event_id", "dealid", "tag_id", "dsp_id", "advertiser_id"])
    return read.filter("""dsp_id = '10002' AND dealid >= '3' AND dealid < '8' AND advertiser_id IN ('adv1', 'adv4', 'adv7')
                          AND tag_id IS NOT NULL AND event_id % 3 <> 1""").select("event_id", "dealid", "tag_id")


@register("pacing_flags_index", oracle.pacing_flags_index(RUN_DATE))
def pacing_flags_index(spark, sf):
    """J-4 against caps kept in an index table, as the reference does; the day's filter is pushed."""
    path = scratch_path(spark, "caps-index")
    index_table.write_index(td.deal_caps(spark, sf), path, "overwrite", order=["now_time", "dealid"], block_rows=512)
    caps = index_table.read_index(spark, path, ["dealid", "now_time", "dealidnum"]).filter(F.col("now_time") == RUN_DATE)
    return counters.near_cap(_running_totals(spark, sf), caps)


# ------------------------------------------------------------------ scalar functions, lookups

@register("scalar_functions", oracle.scalar_functions())
def scalar_functions(spark, sf):
    r = td.request_log(spark, sf)
    parsed = F.from_json("RedisadInfo", STREAM_RECORD)
    return r.select(
        "event_id",
        fx.dashed_day("local-month", "local-day").alias("daytime_dashed"),
        fx.compact_day("local-month", "local-day").alias("daytime_compact"),
        fx.last_part("DSPName").alias("dsp_id"),
        fx.differs_flag("isReturn", "isTimeOut").alias("return_vs_timeout"),
        fx.with_default("isReturn", MISSING_MEDIA).alias("is_return_text"),
        fx.json_field("RedisadInfo", "dsp_id").alias("json_dsp_id"),
        parsed.getField("tag_id").alias("parsed_tag_id"),
        F.col("FinalAdobj.dealid").alias("final_dealid"),
        fx.first_element("options.body.imp").getField("tagid").alias("first_tagid"),
        F.col("isHaveAd").cast("string").alias("is_have_ad_text"),
        (F.col("isReturn") + F.col("isTimeOut")).alias("return_plus_timeout"),
        F.date_format("ts", "yyyy-MM-dd").alias("run_date_dashed"),
        F.date_format("ts", "yyyyMMdd").alias("run_date_compact"),
        fx.clamp_low(F.col("event_id") * 1000 - 5000).alias("padded_start"),
        F.to_json(F.struct("event_id", "DSPName")).alias("row_json"),
        F.when(F.col("isHaveAd") == 1, "success").otherwise("fail").alias("outcome"),
        fx.span_text("event_id", F.col("event_id") + 1000).alias("span_text"),
    )


@register("nested_tag_extract", oracle.nested_tag_extract())
def nested_tag_extract(spark, sf):
    r = td.request_log(spark, sf)
    tag = fx.first_element("options.body.imp").getField("tagid")
    return r.select("event_id", F.col("FinalAdobj.dealid").alias("dealid"), tag.alias("tag_id"),
                    fx.last_part(tag).alias("tag_id_channel"))


@register("dim_lookup_default", oracle.dim_lookup_default())
def dim_lookup_default(spark, sf):
    log = td.exposure_log(spark, sf).select("event_id", "dealid", "media_channel_id")
    return left_lookup(log, td.ssp_tag(spark, sf), "media_channel_id", "channel_id",
                       {"media_id": "media_id"}, {"media_id": MISSING_MEDIA})


# ------------------------------------------------------------------ video segmentation



def _video_intervals(spark, sf):
    return vs.join_usable(td.ad_seat(spark, sf), td.usable_media(spark, sf))


def _video_segments(spark, sf, **how):
    return vs.segment_videos(td.ad_seat(spark, sf), td.usable_media(spark, sf), **how)


@register("video_join_usable", oracle.video_join_usable())
def video_join_usable(spark, sf):
    return _video_intervals(spark, sf).select(*vs.SEAT_COLUMNS)


@register("video_collect", oracle.video_collect())
def video_collect(spark, sf):
    return vs.bounded_collect(_video_intervals(spark, sf))


@register("video_collect_chunked", oracle.video_collect(chunk=7))
def video_collect_chunked(spark, sf):
    """A-6 with a small chunk and the range-partitioned numbering of hot videos."""
    return vs.bounded_collect(_video_intervals(spark, sf), chunk=7, hot=True)


@register("video_rejected", oracle.video_rejected())
def video_rejected(spark, sf):
    """Intervals the sweep cannot use, with the reason (never dropped without a word)."""
    return vs.rejected(vs.pad(_video_intervals(spark, sf))).select(
        "video_id", "class_type_id", "class3_name", "ad_seat_b_time", "ad_seat_e_time", "status")


@register("video_pad", oracle.video_pad())
def video_pad(spark, sf):
    return vs.pad(_video_intervals(spark, sf)).select(
        "video_id", "class_type_id", "class3_name", "ad_seat_b_time", "ad_seat_e_time", "b", "e", "status")


def _prepared(spark, sf):
    return vs.prepare_intervals(td.ad_seat(spark, sf), td.usable_media(spark, sf))


@register("video_interval_rank", oracle.video_interval_rank())
def video_interval_rank(spark, sf):
    iv = _prepared(spark, sf)
    return vs.interval_rank(iv).select("video_id", "rn", "b", "e", "class3_name")


@register("video_points", oracle.video_points())
def video_points(spark, sf):
    iv = _prepared(spark, sf)
    return vs.points(iv).select("video_id", "p", "t", "is_end", "t_prev")


@register("video_segments", oracle.video_segments())
def video_segments(spark, sf, hot=None):
    heads = vs.segment_heads_of(td.ad_seat(spark, sf), td.usable_media(spark, sf), hot=hot)
    return heads.select("string_vid", "seg_no", *[o for _, o in vs.ATTRS[1:]], "string_time", "string_time_long", "n_active")


@register("video_tag_lists", oracle.video_tag_lists())
def video_tag_lists(spark, sf, **how):
    segs = _video_segments(spark, sf, **how)
    part = ["part"] if "part" in segs.columns else []
    return segs.select("string_vid", "seg_no", *part, *[F.array_join(c, ",").alias(c) for c in vs.LIST_COLUMNS])


@register("video_change_lists", oracle.video_tag_lists())
def video_change_lists(spark, sf):
    """V-4 kept as change lists (rows bounded by the points, whatever overlaps) and read back."""
    lists = changes.expand(changes.change_lists_of(td.ad_seat(spark, sf), td.usable_media(spark, sf), every=16))
    return lists.select(F.col("video_id").alias("string_vid"), F.col("p").alias("seg_no"),
                        *[F.array_join(c, ",").alias(c) for c in vs.LIST_COLUMNS])


# The plans for videos too large for one task, forced: what runs at 100x is what is checked.

@register("video_rank_ranged", oracle.video_interval_rank())
def video_rank_ranged(spark, sf):
    return vs.interval_rank(_prepared(spark, sf), hot=True).select("video_id", "rn", "b", "e", "class3_name")


@register("video_points_ranged", oracle.video_points())
def video_points_ranged(spark, sf):
    return vs.points(_prepared(spark, sf), hot=True).select("video_id", "p", "t", "is_end", "t_prev")


@register("video_segments_ranged", oracle.video_segments())
def video_segments_ranged(spark, sf):
    return video_segments(spark, sf, hot=True)


@register("video_lists_ranged", oracle.video_tag_lists(max_items=3))
def video_lists_ranged(spark, sf):
    """Tag lists in parts of at most three active intervals."""
    return video_tag_lists(spark, sf, hot=True, max_items=3)


@register("video_merge_ranged", oracle.video_merge_overlaps())
def video_merge_ranged(spark, sf):
    return vs.merge_overlaps(_prepared(spark, sf), hot=True).select("video_id", "class3_name", "b", "e", "n_merged")


@register("video_segments_json", oracle.video_segments_json())
def video_segments_json(spark, sf):
    return vs.to_documents(_video_segments(spark, sf))


@register("video_documents_index", oracle.video_segments_json())
def video_documents_index(spark, sf):
    """K-4: the segment documents committed to an index table, read back from it."""
    path = scratch_path(spark, "documents")
    docs = vs.to_documents(_video_segments(spark, sf))
    writers.write_documents(docs, path, "append", index_table.FORMAT)
    return index_table.read_index(spark, path)


# ------------------------------------------------------------------ streams



def _raw_log_stream(spark, sf):
    """The raw-record stream: ``events`` read as a file stream, shaped into S7 records."""
    events = open_log_stream(spark, "parquet", sf, schema=td.table(spark, sf, "events").schema,
                             options={"pathGlobFilter": "events.parquet"})
    return td.to_raw_stream(events)


@register("stream_parse_dealid", oracle.stream_parse_dealid())
def stream_parse_dealid(spark, sf):
    q, out = deal_stream.run_parse_stream(spark, _raw_log_stream(spark, sf))
    q.awaitTermination()
    return spark.read.parquet(out)


@register("stream_deal_totals", oracle.stream_deal_totals())
def stream_deal_totals(spark, sf):
    q, out = deal_stream.run_deal_totals(spark, _raw_log_stream(spark, sf))
    q.awaitTermination()
    return deal_stream.latest_totals(spark, out)


def _offset_log(spark, sf, batches=6):
    """``events`` appended to a partitioned log, and the log as a stream of about ``batches`` micro-batches."""
    path = scratch_path(spark, "log")
    records = td.to_log_records(td.table(spark, sf, "events"))
    ends = log_stream.append_log(records, path, ["event_id"], partitions=4, segment_rows=1 << 16)
    return log_stream.stream_log(spark, path, "adlens", max(1, -(-sum(ends) // batches)))


@register("stream_log_offsets", oracle.stream_deal_totals())
def stream_log_offsets(spark, sf):
    """SRC-5 from a log source with offsets of its own: the day totals over several rate-limited micro-batches."""
    raw = _offset_log(spark, sf).withColumnRenamed("timestamp", "ts")
    q, out = deal_stream.run_deal_totals(spark, raw, trigger={"processingTime": "0 seconds"})
    log_stream.drain(q)
    return deal_stream.latest_totals(spark, out)


@register("stream_seeded_totals", oracle.deal_running_total())
def stream_seeded_totals(spark, sf):
    """ST-3 b with state of its own: seeded from the stored totals, cleared at day ends."""
    raw = _offset_log(spark, sf, batches=4).withColumnRenamed("timestamp", "ts")
    q, out = day_state.run_seeded_totals(spark, raw, td.stored_totals(spark, sf), trigger={"processingTime": "0 seconds"}, delay="400 days", buckets=8)
    log_stream.drain(q)
    return deal_stream.latest_totals(spark, out)


def _counter_deltas(batch):
    recs = counters.with_dealid(counters.keep_topic(batch))
    return recs.groupBy(fx.counter_key("dealid").alias("key")).agg(F.count(F.lit(1)).alias("value"))


@register("counter_epochs", oracle.counter_add())
def counter_epochs(spark, sf):
    """K-2 exactly once: stored counters, then micro-batches as fenced epochs, folded on the way;
    afterwards every epoch is offered a second time and changes nothing."""
    store = EpochCounters(scratch_path(spark, "counters"))
    stored = td.stored_totals(spark, sf).select(fx.counter_key("dealid").alias("key"), F.col("total").alias("value"))
    store.apply(stored, "stored", 0)
    q = (_offset_log(spark, sf).writeStream.foreachBatch(EpochCounterSink(store, _counter_deltas, fold_every=2))
         .option("checkpointLocation", scratch_path(spark, "counters_ckpt")).trigger(processingTime="0 seconds").start())
    log_stream.drain(q)
    fence = store.fold(spark)
    for query, upto in fence.items():
        for batch_id in range(upto + 1):
            store.apply(stored, query, batch_id)
    return store.values(spark)


@register("video_merge_overlaps", oracle.video_merge_overlaps())
def video_merge_overlaps(spark, sf):
    iv = _prepared(spark, sf)
    return vs.merge_overlaps(iv).select("video_id", "class3_name", "b", "e", "n_merged")


@register("stream_pacing_flags", oracle.pacing_flags())
def stream_pacing_flags(spark, sf):
    """ST-3 a + ST-4 on the stream: read-add-write totals seeded with the stored table,
    cap flags per micro-batch; the union of flagged keys over all batches."""
    sink = deal_stream.ReadAddWriteSink(scratch_path(spark, "rw_state"), td.deal_caps(spark, sf),
                                        scratch_path(spark, "rw_flags"),
                                        day=F.to_date(F.col("ts").cast("timestamp")).cast("string"),
                                        initial=td.stored_totals(spark, sf))
    q = deal_stream.run_read_add_write(spark, _raw_log_stream(spark, sf), sink, trigger={"availableNow": True})
    q.awaitTermination()
    return spark.read.parquet(sink.flags_path).select("dealid", "now_time", "doc_id").distinct()


@register("stream_stop_flags", oracle.pacing_apply_flag())
def stream_stop_flags(spark, sf):
    """R-8 whole on the stream, two files per micro-batch: totals, cap check and ``stop = 1`` on
    the stored cap table."""
    from adlens.plans import jobs
    events = scratch_path(spark, "events")
    td.table(spark, sf, "events").repartition(6, "event_id").write.parquet(events)
    raw = td.to_raw_stream(open_log_stream(spark, "parquet", events, schema=td.table(spark, sf, "events").schema,
                                           options={"maxFilesPerTrigger": "2"}))
    q, sink = jobs.start_exposure_control(spark, raw, scratch_path(spark, "control"), td.deal_caps(spark, sf),
                                          scratch_path(spark, "control_ckpt"), {"availableNow": True},
                                          day=F.to_date(F.col("ts").cast("timestamp")).cast("string"),
                                          initial=td.stored_totals(spark, sf))
    q.awaitTermination()
    return sink.current_caps(spark)
