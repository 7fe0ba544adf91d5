"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

The TESTDATA adapters are written once as CTEs; each query text starts with
the CTEs it needs. Notes: ``||`` (not DuckDB ``concat``) keeps Spark's
null-propagating concatenation; ``first(x ORDER BY ord)`` keeps nulls like
Spark ``min_by``; sums are cast to BIGINT.
"""

from __future__ import annotations

ADAPTERS = {
    "exposure_log": """
SELECT event_id, CAST(user_id AS VARCHAR) AS dealid,
  CAST(year(ts)*100 + month(ts) AS VARCHAR) AS local_month, lpad(CAST(day(ts) AS VARCHAR), 2, '0') AS local_day,
  'o' || CAST(user_id % 50 AS VARCHAR) AS order_id,
  CASE WHEN user_id % 7 = 0 THEN NULL WHEN user_id % 3 = 0 THEN 'o' || CAST(user_id % 50 AS VARCHAR)
       ELSE 'm' || CAST(user_id % 50 AS VARCHAR) END AS main_order_id,
  CAST(user_id % 30 AS VARCHAR) AS media_channel_id,
  CASE WHEN event_id % 11 = 0 THEN NULL ELSE CAST(user_id % 30 AS VARCHAR) || '_scene_' || event_type END AS tag_id,
  'mat' || CAST(event_id % 40 AS VARCHAR) AS adx_material_id, CAST(10001 + user_id % 4 AS VARCHAR) AS dsp_id,
  'adv' || CAST(user_id % 9 AS VARCHAR) AS advertiser_id
FROM events WHERE event_type = 'view'""",
    "request_log": """
SELECT event_id, CAST(year(ts)*100 + month(ts) AS VARCHAR) AS local_month, lpad(CAST(day(ts) AS VARCHAR), 2, '0') AS local_day,
  CASE WHEN event_type IN ('click','purchase') THEN 1 ELSE 0 END AS isHaveAd,
  CASE WHEN event_type = 'error' THEN 1 WHEN event_type = 'signup' THEN 0 END AS isReturn,
  CASE WHEN event_type = 'signup' AND value < 10 THEN 1 WHEN event_type = 'signup' THEN 0 END AS isTimeOut,
  CAST(user_id % 30 AS VARCHAR) AS media_channel_id, 'DSP_' || CAST(10001 + user_id % 4 AS VARCHAR) AS DSPName,
  CAST(user_id AS VARCHAR) AS final_dealid,
  '{"tag_id":"Scene_' || CAST(user_id % 30 AS VARCHAR) || '_' || event_type || '","adx_material_id":"mat' ||
    CAST(event_id % 40 AS VARCHAR) || '","dsp_id":' || CAST(10001 + user_id % 4 AS VARCHAR) ||
    ',"advertiser_id":"adv' || CAST(user_id % 9 AS VARCHAR) || '"}' AS RedisadInfo,
  CASE WHEN event_id % 17 = 0 THEN '{"body":{"imp":[]}}'
       ELSE '{"body":{"imp":[{"tagid":"' || CAST(user_id % 30 AS VARCHAR) || '_scene_' || event_type || '"}]}}' END AS options_json,
  ts
FROM events""",
    "ssp_tag": """
SELECT CAST(n_nationkey + 8 AS VARCHAR) AS channel_id, n_name AS media_id FROM nation""",
    "adx_order_dealid": """
SELECT CAST(CASE WHEN c_custkey % 4 = 0 THEN -c_custkey ELSE c_custkey END AS VARCHAR) AS dealid, 'o' || CAST(c_custkey % 50 AS VARCHAR) AS order_id,
  'm' || CAST(c_custkey % 20 AS VARCHAR) AS main_order_id, CAST(c_custkey % 2 AS INTEGER) AS is_compensate
FROM customer""",
    "deal_caps": """
SELECT DISTINCT CAST(user_id AS VARCHAR) AS dealid, CAST(CAST(ts AS DATE) AS VARCHAR) AS now_time,
  CAST(31 + user_id % 4 AS INTEGER) AS dealidnum, 0 AS stop FROM events""",
    "stored_totals": """
SELECT CAST(CASE WHEN user_id % 2 = 0 THEN -user_id ELSE user_id END AS VARCHAR) AS dealid,
  CAST(CAST(ts AS DATE) AS VARCHAR) AS now_time, CAST(count(*) AS INTEGER) AS total
FROM events WHERE event_type = 'click' GROUP BY user_id, CAST(ts AS DATE)""",
    "raw_stream": """
SELECT event_id, ts, CASE WHEN event_id % 23 = 0 THEN '{bad ' || event_type
    WHEN event_id % 29 = 0 THEN '{"dealid":"' || CAST(user_id AS VARCHAR) || '"}'
    WHEN event_id % 31 = 0 THEN '{"sltcustomtopic":"sltadxlog-adx-bg"}'
    ELSE '{"dealid":"' || CAST(user_id AS VARCHAR) || '","dsp_id":10001,"sltcustomtopic":"' ||
         CASE WHEN event_type IN ('view','click') THEN 'sltadxlog-adx-bg' ELSE 'other' END || '"}' END AS value
FROM events""",
    "usable_media": """
SELECT CAST(p_partkey AS VARCHAR) AS video_id FROM part WHERE p_size > 25""",
    "ad_seat": """
SELECT CAST(l_partkey AS VARCHAR) AS video_id, p_name AS media_name,
  CASE WHEN l_orderkey % 97 = 0 THEN 'n/a'
       ELSE CAST(((year(l_shipdate)-1992)*372 + month(l_shipdate)*31 + day(l_shipdate))*1000 AS VARCHAR) END AS ad_seat_b_time,
  CASE WHEN l_orderkey % 101 = 0 THEN ''
       ELSE CAST(((year(l_shipdate)-1992)*372 + month(l_shipdate)*31 + day(l_shipdate))*1000
                 + CASE WHEN l_orderkey % 89 = 0 THEN -20 ELSE CAST(l_quantity AS BIGINT) END*1000 AS VARCHAR) END AS ad_seat_e_time,
  p_brand AS drama_name, p_type AS drama_type_name, 'area' AS media_area_name, CAST(year(l_shipdate) AS VARCHAR) AS media_release_date,
  l_returnflag AS class2_name, CAST(l_linenumber AS VARCHAR) AS class_type_id, l_returnflag || l_linestatus AS class3_name,
  'img' || CAST(l_suppkey AS VARCHAR) AS ad_seat_img,
  row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_suppkey, l_quantity, l_extendedprice,
    l_discount, l_tax, l_returnflag, l_linestatus) AS sid
FROM lineitem JOIN part ON l_partkey = p_partkey""",
}


def with_adapters(body: str, *names: str, extra: dict[str, str] | None = None) -> str:
    ctes = [f"{n} AS ({ADAPTERS[n]}\n)" for n in names]
    ctes += [f"{n} AS ({sql}\n)" for n, sql in (extra or {}).items()]
    return "WITH " + ",\n".join(ctes) + "\n" + body


def _first(cols, ord_col="event_id"):
    return ",\n  ".join(f"first({c} ORDER BY {ord_col}) AS {c}" for c in cols)


_EXPOSURE_ATTRS = ("order_id", "main_order_id", "media_channel_id", "tag_id", "adx_material_id",
                   "dsp_id", "advertiser_id")

_EXPOSURE_SELECT = """
SELECT a.dealid, {daytime} AS daytime, a.order_id, a.main_order_id,
  CAST(CASE WHEN a.order_id = a.main_order_id THEN 0 ELSE 1 END AS INTEGER) AS is_compensate,
  coalesce(CAST(b.media_id AS VARCHAR), '000') AS media_id, a.media_channel_id, a.tag_id,
  string_split(a.tag_id, '_')[-1] AS tag_id_channel, a.adx_material_id, a.dsp_id, a.advertiser_id,
  CAST(a.total AS BIGINT) AS total
FROM agg a LEFT JOIN ssp_tag b ON a.media_channel_id = b.channel_id"""

DASHED = "left(a.m, 4) || '-' || right(a.m, 2) || '-' || a.d"
COMPACT = "a.m || a.d"


def bg_report_all() -> str:
    agg = f"""SELECT dealid, local_month AS m, local_day AS d, {_first(_EXPOSURE_ATTRS)}, count(*) AS total
FROM exposure_log GROUP BY dealid, local_month, local_day"""
    return with_adapters(_EXPOSURE_SELECT.format(daytime=DASHED), "exposure_log", "ssp_tag",
                         extra={"agg": agg})


def bg_report_daily(month: str, day: str) -> str:
    agg = f"""SELECT dealid, first(local_month ORDER BY event_id) AS m, first(local_day ORDER BY event_id) AS d,
  {_first(_EXPOSURE_ATTRS)}, count(*) AS total
FROM exposure_log WHERE local_month = '{month}' AND local_day = '{day}' GROUP BY dealid"""
    return with_adapters(_EXPOSURE_SELECT.format(daytime=DASHED), "exposure_log", "ssp_tag",
                         extra={"agg": agg})


def _json(field):
    return f"json_extract_string(a.info, '$.{field}')"


def pv_success_daily(month: str, day: str) -> str:
    agg = f"""SELECT final_dealid AS dealid, first(local_month ORDER BY event_id) AS m,
  first(local_day ORDER BY event_id) AS d, first(media_channel_id ORDER BY event_id) AS media_channel_id,
  first(RedisadInfo ORDER BY event_id) AS info, count(*) AS total
FROM request_log WHERE local_month = '{month}' AND local_day = '{day}' AND isHaveAd = 1 GROUP BY final_dealid"""
    body = f"""
SELECT a.dealid, {COMPACT} AS daytime, coalesce(CAST(b.media_id AS VARCHAR), '000') AS media_id,
  a.media_channel_id, string_split({_json('tag_id')}, '_')[-1] AS tag_id_channel,
  {_json('adx_material_id')} AS adx_material_id, {_json('dsp_id')} AS dsp_id,
  {_json('advertiser_id')} AS advertiser_id, CAST(a.total AS BIGINT) AS total
FROM agg a LEFT JOIN ssp_tag b ON a.media_channel_id = b.channel_id"""
    return with_adapters(body, "request_log", "ssp_tag", extra={"agg": agg})


def pv_success_all() -> str:
    agg = """SELECT final_dealid AS dealid, local_month AS m, local_day AS d,
  first(media_channel_id ORDER BY event_id) AS media_channel_id,
  first(RedisadInfo ORDER BY event_id) AS info, count(*) AS total
FROM request_log WHERE isHaveAd = 1 GROUP BY final_dealid, local_month, local_day"""
    body = f"""
SELECT a.dealid, {DASHED} AS daytime, c.order_id, c.main_order_id, c.is_compensate,
  coalesce(CAST(b.media_id AS VARCHAR), '000') AS media_id, a.media_channel_id,
  {_json('tag_id')} AS tag_id, string_split({_json('tag_id')}, '_')[-1] AS tag_id_channel,
  {_json('adx_material_id')} AS adx_material_id, {_json('dsp_id')} AS dsp_id,
  {_json('advertiser_id')} AS advertiser_id, CAST(a.total AS BIGINT) AS total
FROM agg a LEFT JOIN ssp_tag b ON a.media_channel_id = b.channel_id
LEFT JOIN adx_order_dealid c ON a.dealid = c.dealid"""
    return with_adapters(body, "request_log", "ssp_tag", "adx_order_dealid", extra={"agg": agg})


_FAIL_SELECT = """
SELECT a.dsp_id, {daytime} AS daytime, coalesce(CAST(b.media_id AS VARCHAR), '000') AS media_id,
  a.media_channel_id, a.tag_id, string_split(a.tag_id, '_')[-1] AS tag_id_channel,
  a."return", a."timeout", a.total - a."return" - a."timeout" AS else_error, a.total
FROM agg a LEFT JOIN ssp_tag b ON a.media_channel_id = b.channel_id"""

_FAIL_MEASURES = """first(media_channel_id ORDER BY event_id) AS media_channel_id,
  first(json_extract_string(options_json, '$.body.imp[0].tagid') ORDER BY event_id) AS tag_id,
  CAST(coalesce(sum(isReturn), 0) AS BIGINT) AS "return",
  CAST(coalesce(sum(isTimeOut), 0) AS BIGINT) AS "timeout",
  CAST(count(*) AS BIGINT) AS total"""


def pv_fail_daily(month: str, day: str) -> str:
    agg = f"""SELECT string_split(DSPName, '_')[-1] AS dsp_id, first(local_month ORDER BY event_id) AS m,
  first(local_day ORDER BY event_id) AS d, {_FAIL_MEASURES}
FROM request_log WHERE local_month = '{month}' AND local_day = '{day}' AND isHaveAd = 0
GROUP BY string_split(DSPName, '_')[-1]"""
    return with_adapters(_FAIL_SELECT.format(daytime=COMPACT), "request_log", "ssp_tag", extra={"agg": agg})


def pv_fail_all() -> str:
    agg = f"""SELECT string_split(DSPName, '_')[-1] AS dsp_id, local_month AS m, local_day AS d, {_FAIL_MEASURES}
FROM request_log WHERE isHaveAd = 0 GROUP BY string_split(DSPName, '_')[-1], local_month, local_day"""
    return with_adapters(_FAIL_SELECT.format(daytime=DASHED), "request_log", "ssp_tag", extra={"agg": agg})


def report_run_all() -> str:
    parts = {"bg": bg_report_all(), "success": pv_success_all(), "fail": pv_fail_all()}
    selects = [f"SELECT '{name}' AS report, CAST(count(*) AS BIGINT) AS n_rows, CAST(sum(total) AS BIGINT) AS sum_total "
               f"FROM ({sql}) t_{name}" for name, sql in parts.items()]
    return "\nUNION ALL\n".join(selects)


# ------------------------------------------------------------------ counters, caps, sinks

def _jfield(col, field):
    # DuckDB raises on malformed JSON where Spark gives null.
    return f"CASE WHEN json_valid({col}) THEN json_extract_string({col}, '$.{field}') END"


_TOPIC = f"{_jfield('value', 'sltcustomtopic')} = 'sltadxlog-adx-bg'"


def topic_filter() -> str:
    return with_adapters(f"SELECT event_id, {_jfield('value', 'dealid')} AS dealid FROM raw_stream WHERE {_TOPIC}",
                         "raw_stream")


def deal_counts() -> str:
    return with_adapters(f"""SELECT {_jfield('value', 'dealid')} AS dealid, CAST(count(*) AS BIGINT) AS total
FROM raw_stream GROUP BY 1""", "raw_stream")


_BATCH_COUNTS = f"""SELECT {_jfield('value', 'dealid')} AS dealid, CAST(CAST(ts AS DATE) AS VARCHAR) AS now_time,
  count(*) AS total FROM raw_stream WHERE {_TOPIC} GROUP BY 1, 2"""

_RUNNING = """SELECT a.dealid, a.now_time, CAST(a.total + coalesce(b.total, 0) AS BIGINT) AS total
FROM batch_counts a LEFT JOIN stored_totals b ON a.dealid = b.dealid AND a.now_time = b.now_time"""


def deal_running_total() -> str:
    return with_adapters(_RUNNING, "raw_stream", "stored_totals", extra={"batch_counts": _BATCH_COUNTS})


_FLAGS = """SELECT a.dealid, a.now_time, a.dealid || a.now_time AS doc_id
FROM running a JOIN deal_caps b ON a.dealid = b.dealid AND a.now_time = b.now_time
WHERE a.total > b.dealidnum - 30"""


def pacing_flags() -> str:
    return with_adapters(_FLAGS, "raw_stream", "stored_totals", "deal_caps",
                         extra={"batch_counts": _BATCH_COUNTS, "running": _RUNNING})


def pacing_flags_index(day: str) -> str:
    return f"SELECT * FROM ({pacing_flags()}) f WHERE now_time = '{day}'"


def index_scan() -> str:
    body = """SELECT event_id, dealid, tag_id FROM exposure_log
WHERE dsp_id = '10002' AND dealid >= '3' AND dealid < '8' AND advertiser_id IN ('adv1', 'adv4', 'adv7') AND tag_id IS NOT NULL
  AND event_id % 3 <> 1"""
    return with_adapters(body, "exposure_log")


def pacing_apply_flag() -> str:
    body = """SELECT c.dealid, c.now_time, c.dealidnum,
  CAST(CASE WHEN f.doc_id IS NOT NULL THEN 1 ELSE c.stop END AS INTEGER) AS stop
FROM deal_caps c LEFT JOIN (SELECT DISTINCT doc_id FROM flags) f ON c.dealid || c.now_time = f.doc_id"""
    return with_adapters(body, "raw_stream", "stored_totals", "deal_caps",
                         extra={"batch_counts": _BATCH_COUNTS, "running": _RUNNING, "flags": _FLAGS})


def upsert_merge() -> str:
    body = """SELECT coalesce(t.dealid, u.dealid) AS dealid, coalesce(t.now_time, u.now_time) AS now_time,
  CAST(CASE WHEN u.dealid IS NOT NULL THEN u.total ELSE t.total END AS BIGINT) AS total
FROM stored_totals t FULL OUTER JOIN (SELECT * FROM running WHERE dealid IS NOT NULL) u
  ON t.dealid = u.dealid AND t.now_time = u.now_time"""
    return with_adapters(body, "raw_stream", "stored_totals",
                         extra={"batch_counts": _BATCH_COUNTS, "running": _RUNNING})


def upsert_keeps_columns() -> str:
    """Stored rows keep ``note``; rows that only the update has get none."""
    return f"""SELECT m.*, CASE WHEN s.dealid IS NOT NULL THEN 'deal ' || s.dealid END AS note FROM ({upsert_merge()}) m
LEFT JOIN ({ADAPTERS["stored_totals"]}) s ON m.dealid = s.dealid AND m.now_time = s.now_time"""


def null_deal_report() -> str:
    return with_adapters("SELECT now_time, CAST(total AS BIGINT) AS total FROM batch_counts WHERE dealid IS NULL", "raw_stream",
                         extra={"batch_counts": _BATCH_COUNTS})


def counter_add() -> str:
    body = """SELECT coalesce(c.key, d.key) AS key, CAST(coalesce(c.value, 0) + coalesce(d.value, 0) AS BIGINT) AS value
FROM (SELECT 'adxhappen:' || dealid AS key, sum(total) AS value FROM stored_totals GROUP BY 1) c
FULL OUTER JOIN (SELECT 'adxhappen:' || coalesce(dealid, 'null') AS key, count(*) AS value FROM topic_rows GROUP BY 1) d
  ON c.key = d.key"""
    topic_rows = f"SELECT {_jfield('value', 'dealid')} AS dealid FROM raw_stream WHERE {_TOPIC}"
    return with_adapters(body, "raw_stream", "stored_totals", extra={"topic_rows": topic_rows})


# ------------------------------------------------------------------ scalar functions, lookups

def scalar_functions() -> str:
    body = """SELECT event_id,
  left(local_month, 4) || '-' || right(local_month, 2) || '-' || local_day AS daytime_dashed,
  local_month || local_day AS daytime_compact,
  string_split(DSPName, '_')[-1] AS dsp_id,
  CAST(CASE WHEN isReturn = isTimeOut THEN 0 ELSE 1 END AS INTEGER) AS return_vs_timeout,
  coalesce(CAST(isReturn AS VARCHAR), '000') AS is_return_text,
  json_extract_string(RedisadInfo, '$.dsp_id') AS json_dsp_id,
  json_extract_string(RedisadInfo, '$.tag_id') AS parsed_tag_id,
  final_dealid AS final_dealid,
  json_extract_string(options_json, '$.body.imp[0].tagid') AS first_tagid,
  CAST(isHaveAd AS VARCHAR) AS is_have_ad_text,
  CAST(isReturn + isTimeOut AS INTEGER) AS return_plus_timeout,
  strftime(ts, '%Y-%m-%d') AS run_date_dashed,
  strftime(ts, '%Y%m%d') AS run_date_compact,
  greatest(event_id * 1000 - 5000, 0) AS padded_start,
  '{"event_id":' || CAST(event_id AS VARCHAR) || ',"DSPName":"' || DSPName || '"}' AS row_json,
  CASE WHEN isHaveAd = 1 THEN 'success' ELSE 'fail' END AS outcome,
  CAST(event_id AS VARCHAR) || '_' || CAST(event_id + 1000 AS VARCHAR) AS span_text
FROM request_log"""
    return with_adapters(body, "request_log")


def nested_tag_extract() -> str:
    body = """SELECT event_id, final_dealid AS dealid,
  json_extract_string(options_json, '$.body.imp[0].tagid') AS tag_id,
  string_split(json_extract_string(options_json, '$.body.imp[0].tagid'), '_')[-1] AS tag_id_channel
FROM request_log"""
    return with_adapters(body, "request_log")


def dim_lookup_default() -> str:
    body = """SELECT a.event_id, a.dealid, a.media_channel_id, coalesce(CAST(b.media_id AS VARCHAR), '000') AS media_id
FROM exposure_log a LEFT JOIN ssp_tag b ON a.media_channel_id = b.channel_id"""
    return with_adapters(body, "exposure_log", "ssp_tag")


# ------------------------------------------------------------------ video segmentation

_SEAT_COLS = ("video_id", "media_name", "ad_seat_b_time", "ad_seat_e_time", "drama_name", "drama_type_name",
              "media_area_name", "media_release_date", "class2_name", "class_type_id", "class3_name", "ad_seat_img")

_VIDEO_CTES = {
    "joined": "SELECT a.* FROM ad_seat a JOIN usable_media u ON a.video_id = u.video_id",
    "padded": """SELECT *, greatest(TRY_CAST(ad_seat_b_time AS BIGINT) - 5000, 0) AS b,
  TRY_CAST(ad_seat_e_time AS BIGINT) + 5000 AS e FROM joined WHERE class_type_id IN ('1', '2', '3', '4')""",
    "ivk": "SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY b, sid) AS rn FROM padded "
           "WHERE TRY_CAST(ad_seat_b_time AS BIGINT) IS NOT NULL AND e >= b",
    "pts": "SELECT video_id, rn, b AS t, 0 AS is_end FROM ivk UNION ALL SELECT video_id, rn, e AS t, 1 AS is_end FROM ivk",
    "pn": """SELECT video_id, rn, t, is_end, row_number() OVER w AS p, lag(t) OVER w AS t_prev
FROM pts WINDOW w AS (PARTITION BY video_id ORDER BY t, rn, is_end)""",
    "span": "SELECT video_id, rn, min(p) AS pb, max(p) AS pe FROM pn GROUP BY video_id, rn",
    "mem": "SELECT video_id, rn, unnest(generate_series(pb + 1, pe)) AS p FROM span",
    "seg": """SELECT m.video_id, m.p, m.rn, q.t_prev, q.t, i.media_name, i.drama_name, i.drama_type_name,
  i.media_area_name, i.media_release_date, i.class_type_id, i.class3_name, i.class2_name, i.ad_seat_img
FROM mem m JOIN pn q ON m.video_id = q.video_id AND m.p = q.p
JOIN ivk i ON i.video_id = m.video_id AND i.rn = m.rn""",
}


def _video(body: str, upto: str) -> str:
    names = list(_VIDEO_CTES)
    extra = {n: _VIDEO_CTES[n] for n in names[: names.index(upto) + 1]}
    return with_adapters(body, "ad_seat", "usable_media", extra=extra)


def video_join_usable() -> str:
    return _video(f"SELECT {', '.join(_SEAT_COLS)} FROM joined", "joined")


def video_pad() -> str:
    body = """SELECT video_id, class_type_id, class3_name, ad_seat_b_time, ad_seat_e_time, b, e,
  CASE WHEN TRY_CAST(ad_seat_b_time AS BIGINT) IS NULL OR TRY_CAST(ad_seat_e_time AS BIGINT) IS NULL THEN 'bad_time'
       WHEN e < b THEN 'inverted' ELSE 'ok' END AS status FROM padded"""
    return _video(body, "padded")


def video_interval_rank() -> str:
    return _video("SELECT video_id, rn, b, e, class3_name FROM ivk", "ivk")


def video_points() -> str:
    return _video("SELECT video_id, p, t, is_end, t_prev FROM pn", "pn")


_SEG_ATTRS = ("media_name AS media_name", "drama_name AS string_drama_name",
              "drama_type_name AS string_drama_type_name", "media_area_name AS string_media_area_name",
              "media_release_date AS string_media_release_date")


def _seg_head():
    attrs = ",\n  ".join(f"first({a.split(' AS ')[0]} ORDER BY rn) AS {a.split(' AS ')[1]}" for a in _SEG_ATTRS)
    return f"""video_id AS string_vid, p AS seg_no, {attrs},
  CAST(min(t_prev) AS VARCHAR) || '_' || CAST(min(t) AS VARCHAR) AS string_time,
  CAST(min(t) - min(t_prev) AS VARCHAR) AS string_time_long"""


def video_segments() -> str:
    return _video(f"SELECT {_seg_head()}, count(*) AS n_active FROM seg GROUP BY video_id, p", "seg")


_CLASS_LISTS = (("4", "man"), ("1", "object"), ("3", "action"), ("2", "sence"))
_LIST_FIELDS = (("_list", "class3_name"), ("2_list", "class2_name"), ("_img_list", "ad_seat_img"))


def video_tag_lists(max_items: int | None = None) -> str:
    lists = ",\n  ".join(
        f"coalesce(string_agg({col}, ',' ORDER BY rn) FILTER (WHERE class_type_id = '{cls}'), '') AS string_{name}{suffix}"
        for cls, name in _CLASS_LISTS for suffix, col in _LIST_FIELDS)
    if not max_items:
        return _video(f"SELECT video_id AS string_vid, p AS seg_no, {lists} FROM seg GROUP BY video_id, p", "seg")
    nth = "row_number() OVER (PARTITION BY video_id, p ORDER BY rn)"
    return _video(f"""SELECT video_id AS string_vid, p AS seg_no, part, {lists}
FROM (SELECT *, CAST(({nth} - 1) // {max_items} AS BIGINT) AS part FROM seg) s GROUP BY video_id, p, part""", "seg")


def video_segments_json() -> str:
    lists = ",\n  ".join(
        f"string_{name}{suffix} := coalesce(list({col} ORDER BY rn) FILTER (WHERE class_type_id = '{cls}'), []::VARCHAR[])"
        for cls, name in _CLASS_LISTS for suffix, col in _LIST_FIELDS)
    attrs = ",\n  ".join(f"{a.split(' AS ')[1]} := first({a.split(' AS ')[0]} ORDER BY rn)" for a in _SEG_ATTRS)
    body = f"""SELECT video_id AS string_vid, p AS seg_no,
  sha256(video_id || '|' || CAST(p AS VARCHAR)) AS doc_id,
  CAST(to_json(struct_pack(string_vid := video_id, {attrs},
  string_time := CAST(min(t_prev) AS VARCHAR) || '_' || CAST(min(t) AS VARCHAR),
  string_time_long := CAST(min(t) - min(t_prev) AS VARCHAR),
  {lists})) AS VARCHAR) AS doc
FROM seg GROUP BY video_id, p"""
    return _video(body, "seg")


def video_rejected() -> str:
    body = """SELECT video_id, class_type_id, class3_name, ad_seat_b_time, ad_seat_e_time,
  CASE WHEN TRY_CAST(ad_seat_b_time AS BIGINT) IS NULL OR TRY_CAST(ad_seat_e_time AS BIGINT) IS NULL THEN 'bad_time'
       ELSE 'inverted' END AS status FROM padded
WHERE TRY_CAST(ad_seat_b_time AS BIGINT) IS NULL OR TRY_CAST(ad_seat_e_time AS BIGINT) IS NULL OR e < b"""
    return _video(body, "padded")


def video_collect(chunk: int = 1000) -> str:
    doc = "to_json(struct_pack(" + ", ".join(f"{c} := {c}" for c in _SEAT_COLS) + "))"
    body = f"""SELECT video_id, CAST(floor((rn - 1) / {chunk}) AS BIGINT) AS chunk, count(*) AS n,
  '[' || string_agg(CAST(doc AS VARCHAR), ',' ORDER BY rn) || ']' AS rows_json
FROM (SELECT video_id, {doc} AS doc,
        row_number() OVER (PARTITION BY video_id ORDER BY TRY_CAST(ad_seat_b_time AS BIGINT) NULLS FIRST, sid) AS rn
      FROM joined WHERE class_type_id IN ('1', '2', '3', '4')) r
GROUP BY video_id, CAST(floor((rn - 1) / {chunk}) AS BIGINT)"""
    return _video(body, "joined")


# ------------------------------------------------------------------ streams

def stream_parse_dealid() -> str:
    return with_adapters(f"SELECT event_id, {_jfield('value', 'dealid')} AS dealid FROM raw_stream", "raw_stream")


def stream_deal_totals() -> str:
    return with_adapters("SELECT dealid, now_time, CAST(total AS BIGINT) AS total FROM batch_counts", "raw_stream",
                         extra={"batch_counts": _BATCH_COUNTS})


def video_merge_overlaps() -> str:
    body = """SELECT video_id, class3_name, min(b) AS b, max(e) AS e, count(*) AS n_merged FROM (
  SELECT *, sum(CASE WHEN prev_e IS NULL OR b >= prev_e THEN 1 ELSE 0 END)
      OVER (PARTITION BY video_id, class3_name ORDER BY b, sid ROWS UNBOUNDED PRECEDING) AS island
  FROM (SELECT *, max(e) OVER (PARTITION BY video_id, class3_name ORDER BY b, sid
                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_e
        FROM padded WHERE TRY_CAST(ad_seat_b_time AS BIGINT) IS NOT NULL AND e >= b) pm) st
GROUP BY video_id, class3_name, island"""
    return _video(body, "padded")
