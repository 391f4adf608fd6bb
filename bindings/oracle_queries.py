"""One SQL text per registered query, see :mod:`bindings.oracle`."""

from __future__ import annotations

from bindings.oracle import (
    AMOUNTS,
    COMMON,
    ORDER_KEYS,
    ORDER_SOURCE,
    REGISTRY,
    RUN_DAY,
    RUN_TS_TEXT,
    UPLOADER_INTS,
    UPLOADER_PLAIN,
    UPLOADER_TOTALS,
    VIDEO_METRICS,
    cols,
    count_of,
    day_text,
    interactions,
    ints,
    net,
    pick,
    seconds_text,
    vip_label,
    when,
)
from bindings.topics import ROUND, ROUNDS

ORACLE: dict[str, str] = {}


def sql(name: str, text: str, common: bool = True) -> None:
    ORACLE[name] = (COMMON if common else "") + text


sql("json_flatten", """SELECT event_id, user_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
  json_extract_string(props, '$.k') AS k_text, CAST(json_extract(props, '$.k') AS DOUBLE) AS k_double,
  CAST(NULL AS BOOLEAN) AS k_flag, CAST(NULL AS BIGINT) AS absent FROM events""", common=False)

sql("quality_flags", """SELECT 't' || i AS trace_id, dt,
  event_id IS NOT NULL AND mid IS NOT NULL AND server_ts IS NOT NULL AS is_valid,
  CASE WHEN event_id IS NULL THEN 'missing_event_id' WHEN mid IS NULL THEN 'missing_mid'
       WHEN server_ts IS NULL THEN 'missing_server_ts' END AS invalid_reason FROM ve""")

sql("code_labels", f"""SELECT o_orderkey,
  CASE o_orderstatus WHEN 'O' THEN 'open' WHEN 'F' THEN 'filled' ELSE 'other' END AS status_label,
  {vip_label('o_orderkey % 5')} AS vip_label,
  CASE WHEN o_orderpriority <> '1-URGENT' THEN o_orderpriority ELSE 'unknown' END AS priority,
  CAST(CASE WHEN o_totalprice > 1000 THEN floor(o_totalprice) ELSE -1 END AS BIGINT) AS price FROM orders""", common=False)

_LINE_EVENTS = ("vip_create_order", "vip_pay_start", "vip_pay_fail", "vip_pay_cancel", "vip_pay_success", "vip_page_view", "x")
sql("order_accumulate", f"""WITH l AS (
  SELECT *, {pick(_LINE_EVENTS, 'l_linenumber')} AS event_id, epoch_ms(l_shipdate) AS ship_ms FROM lineitem)
SELECT l_orderkey, max(l_suppkey) AS mid, max(l_returnflag) AS plan_id,
  CAST(max(floor(l_extendedprice)) AS BIGINT) AS final_price,
  CASE WHEN bool_or(event_id = 'vip_pay_success') THEN 'success' WHEN bool_or(event_id = 'vip_pay_fail') THEN 'fail'
    WHEN bool_or(event_id = 'vip_pay_cancel') THEN 'cancel' WHEN bool_or(event_id = 'vip_pay_start') THEN 'paying'
    ELSE 'created' END AS order_status,
  min(CASE WHEN event_id = 'vip_create_order' THEN ship_ms END) AS create_ts,
  min(CASE WHEN event_id = 'vip_pay_start' THEN ship_ms END) AS pay_start_ts,
  max(CASE WHEN {when('event_id', ('vip_pay_success', 'vip_pay_fail', 'vip_pay_cancel'))} THEN ship_ms END) AS pay_end_ts,
  min(l_linestatus) AS platform FROM l GROUP BY l_orderkey""", common=False)

_ORDER_COLUMNS = """o_orderkey, o_custkey, o_orderstatus, o_totalprice,
  strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, o_orderpriority"""
sql("latest_order_per_customer", f"""SELECT {_ORDER_COLUMNS} FROM (SELECT *, row_number() OVER
  (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1""", common=False)
sql("merge_latest_orders", f"""SELECT {_ORDER_COLUMNS} FROM (SELECT *, row_number() OVER
  (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1""", common=False)


def _pairs(edges: str, change: str) -> str:
    return f"""SELECT p.lo, p.hi, coalesce(f.follows, false) AS follow_fwd,
  CASE WHEN p.lo = p.hi THEN false ELSE coalesce(r.follows, false) END AS follow_bwd,
  coalesce(f.blocks, false) AS block_fwd, CASE WHEN p.lo = p.hi THEN false ELSE coalesce(r.blocks, false) END AS block_bwd,
  CAST(coalesce(f.{change}, 0) AS BIGINT) AS chg_fwd,
  CAST(CASE WHEN p.lo = p.hi THEN 0 ELSE coalesce(r.{change}, 0) END AS BIGINT) AS chg_bwd
FROM (SELECT DISTINCT least(a, b) AS lo, greatest(a, b) AS hi FROM {edges}) p
LEFT JOIN {edges} f ON f.a = p.lo AND f.b = p.hi LEFT JOIN {edges} r ON r.a = p.hi AND r.b = p.lo
WHERE coalesce(f.follows, false) OR coalesce(r.follows, false) OR coalesce(f.blocks, false) OR coalesce(r.blocks, false)"""


sql("relation_pairs", _pairs("state", "chg"))
_COUNTS = "following_cnt follower_cnt mutual_follow_cnt blocking_cnt blocked_by_cnt following_chg follower_chg"
# Pairs that had lost every relation by the day before and were not touched on the run day are gone.
_LIVE = """live AS (SELECT DISTINCT least(a, b) AS lo, greatest(a, b) AS hi FROM (
  SELECT a, b FROM edges WHERE (pf AND NOT pu) OR (pb AND NOT pn)
  UNION ALL SELECT mid, target_mid FROM sv WHERE dt = '{day}'))""".format(day=RUN_DAY)
sql("relation_counts", f""", {_LIVE}
SELECT mid, {ints(_COUNTS)} FROM rel WHERE mid IN (SELECT lo FROM live UNION SELECT hi FROM live)""")
sql("relation_members", """
SELECT me AS mid, 'following' AS relation, other FROM both_ways WHERE following
UNION ALL SELECT me, 'follower', other FROM both_ways WHERE follower
UNION ALL SELECT me, 'mutual_follow', other FROM both_ways WHERE following AND follower
UNION ALL SELECT me, 'blocking', other FROM both_ways WHERE blocking
UNION ALL SELECT me, 'blocked_by', other FROM both_ways WHERE blocked_by""")
sql("relation_lists", """SELECT mid, following_list, follower_list, mutual_follow_list, blocking_list, blocked_by_list
  FROM rel WHERE following_cnt + follower_cnt + blocking_cnt + blocked_by_cnt > 0""")
ORACLE["relation_chunks"] = ORACLE["dim_account_members"] = ORACLE["relation_members"]
sql("relation_pairs_ordered", f""", lastev AS (
  SELECT mid AS a, target_mid AS b,
    arg_max(event_id, ms * 2 + CASE WHEN event_id = 'social_unfollow' THEN 1 ELSE 0 END)
      FILTER (WHERE {when('event_id', ('social_follow', 'social_unfollow'))} AND server_ts IS NOT NULL) AS f1,
    arg_max(event_id, ms * 2 + CASE WHEN event_id = 'social_unblock' THEN 1 ELSE 0 END)
      FILTER (WHERE {when('event_id', ('social_block', 'social_unblock'))} AND server_ts IS NOT NULL) AS b1,
    max(CASE WHEN server_ts IS NULL AND event_id = 'social_unfollow' THEN 2 WHEN server_ts IS NULL AND event_id = 'social_follow' THEN 1 END) AS f0,
    max(CASE WHEN server_ts IS NULL AND event_id = 'social_unblock' THEN 2 WHEN server_ts IS NULL AND event_id = 'social_block' THEN 1 END) AS b0
  FROM sv GROUP BY 1, 2),
lastst AS (
  SELECT a, b, coalesce(f1 = 'social_follow', f0 = 1, false) AS follows, coalesce(b1 = 'social_block', b0 = 1, false) AS blocks,
    CASE WHEN f1 = 'social_follow' OR (f1 IS NULL AND f0 = 1) THEN 1 WHEN f1 = 'social_unfollow' OR (f1 IS NULL AND f0 = 2) THEN -1 ELSE 0 END AS chg
  FROM lastev)
""" + _pairs("lastst", "chg"))

sql("cumulative_snapshot", f"""SELECT bvid, {ints('views likes')} FROM (
  SELECT bvid, sum(view_count) AS views, sum(net_like_delta) AS likes FROM vstats GROUP BY bvid)""")
sql("customers_without_orders", """SELECT c_custkey, c_mktsegment FROM customer
  WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)""", common=False)
sql("key_spine_assembly", """SELECT CAST(n AS BIGINT) AS nation, c.customers, s.suppliers FROM (
  SELECT n_nationkey AS n FROM nation UNION SELECT c_nationkey FROM customer UNION SELECT s_nationkey FROM supplier)
  LEFT JOIN (SELECT c_nationkey AS n, count(*) AS customers FROM customer GROUP BY 1) c USING (n)
  LEFT JOIN (SELECT s_nationkey AS n, count(*) AS suppliers FROM supplier GROUP BY 1) s USING (n)""", common=False)
sql("line_detail", """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, p_partkey, l_suppkey AS s_suppkey,
  l_quantity, p_name, p_brand, s_name, CAST(s_nationkey AS BIGINT) AS s_nationkey
  FROM lineitem JOIN part ON p_partkey = l_partkey LEFT JOIN supplier ON s_suppkey = l_suppkey""", common=False)
sql("customer_summary", """WITH t AS (
  SELECT o_custkey AS c_custkey, count(DISTINCT o_orderkey) AS orders, count(*) AS lines,
    CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1)
SELECT c_custkey, orders, lines, quantity, quantity // nullif(lines, 0) AS avg_quantity, c_name, c_mktsegment
FROM t LEFT JOIN customer USING (c_custkey)""", common=False)
sql("order_cube", """SELECT o_orderstatus, o_orderpriority, CAST(year(o_orderdate) AS BIGINT) AS year, c_mktsegment,
  n_name, CAST(n_regionkey AS BIGINT) AS n_regionkey, count(*) AS order_cnt, count(o_custkey) AS user_cnt,
  CAST(max(coalesce(floor(o_totalprice), 0)) AS BIGINT) AS price
  FROM orders LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey
  GROUP BY ALL""", common=False)

_CLOSING = "epoch_ms(TIMESTAMP '2024-01-15 23:59:59')"
sql("vip_state_rules", f""", r AS (
  SELECT i, k, CASE WHEN i % 2 = 0 THEN ms + k * 86400000 END AS new, CASE WHEN i % 5 <> 0 THEN (ms // 1000 + uid * 3600) * 1000 END AS old FROM e)
SELECT i, coalesce({seconds_text('new')}, {seconds_text('old')}) AS expire_ms, coalesce({seconds_text('new')}, {seconds_text('old')}) AS expire_s,
  CAST(CASE WHEN new IS NOT NULL THEN CASE WHEN new > {_CLOSING} THEN CASE WHEN k <= 31 THEN 1 ELSE 2 END ELSE 0 END
    WHEN old > {_CLOSING} THEN 2 ELSE 0 END AS BIGINT) AS kind_ms,
  CAST(CASE WHEN new IS NOT NULL THEN CASE WHEN new // 1000 > {_CLOSING} // 1000 THEN CASE WHEN k <= 31 THEN 1 ELSE 2 END ELSE 0 END
    WHEN old > {_CLOSING} THEN 2 ELSE 0 END AS BIGINT) AS kind_s FROM r""")
sql("calendar_age", f"""SELECT c_custkey, CAST(date_sub('year', TRY_CAST((1960 + c_nationkey) || '-0' || (c_custkey % 9 + 1) || '-30' AS DATE),
  DATE '{RUN_DAY}') AS BIGINT) AS age FROM customer""", common=False)

_STAMP = "strftime({0}, '%Y-%m-%d %H:%M:%S')"
sql("cumulate_hourly", f""", s AS (
  SELECT event_type, time_bucket(INTERVAL 1 DAY, ts) AS w, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS x,
    count(*) AS n, sum(amount) AS amount, max(k) AS top_k FROM e GROUP BY 1, 2, 3),
f AS (SELECT event_type, time_bucket(INTERVAL 1 DAY, ts) AS w, arg_min(i, ms) AS first_i FROM e GROUP BY 1, 2)
SELECT event_type, {_STAMP.format('w')} AS window_start, {_STAMP.format('x')} AS window_end,
  CAST(sum(n) OVER o AS BIGINT) AS n, CAST(sum(amount) OVER o AS BIGINT) AS amount, max(top_k) OVER o AS top_k, first_i
FROM s JOIN f USING (event_type, w) WINDOW o AS (PARTITION BY event_type, w ORDER BY x)""")
sql("cumulate_dense", f""", g AS (
  SELECT event_type, time_bucket(INTERVAL 1 HOUR, ts) AS w, ts FROM e),
d AS (SELECT DISTINCT event_type, w FROM g),
steps AS (SELECT event_type, w, w + INTERVAL 15 MINUTE * q AS x FROM d, range(1, 5) t(q))
SELECT s.event_type, {_STAMP.format('s.w')} AS window_start, {_STAMP.format('s.x')} AS window_end, count(*) AS n
FROM steps s JOIN g ON g.event_type = s.event_type AND g.w = s.w AND g.ts < s.x GROUP BY s.event_type, s.w, s.x""")
sql("cumulate_distinct", f""", g AS (
  SELECT event_type, time_bucket(INTERVAL 1 DAY, ts) AS w, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS x, uid, k FROM e),
s AS (SELECT event_type, w, x, count(*) AS n FROM g GROUP BY 1, 2, 3),
u AS (SELECT event_type, w, x, count(*) AS c FROM (SELECT event_type, w, uid, min(x) AS x FROM g GROUP BY 1, 2, 3) GROUP BY 1, 2, 3),
v AS (SELECT event_type, w, x, count(*) AS c FROM (SELECT event_type, w, k, min(x) AS x FROM g GROUP BY 1, 2, 3) GROUP BY 1, 2, 3)
SELECT s.event_type, {_STAMP.format('s.w')} AS window_start, {_STAMP.format('s.x')} AS window_end,
  CAST(sum(s.n) OVER o AS BIGINT) AS n, CAST(sum(coalesce(u.c, 0)) OVER o AS BIGINT) AS users,
  CAST(sum(coalesce(v.c, 0)) OVER o AS BIGINT) AS keys
FROM s LEFT JOIN u USING (event_type, w, x) LEFT JOIN v USING (event_type, w, x)
WINDOW o AS (PARTITION BY event_type, w ORDER BY x)""")
sql("cumulate_registrations", f""", s AS (
  SELECT time_bucket(INTERVAL 1 DAY, ts) AS w, time_bucket(INTERVAL 1 MINUTE, ts) + INTERVAL 1 MINUTE AS x, count(*) AS n
  FROM ae WHERE event_id = 'account_register' AND mid IS NOT NULL GROUP BY 1, 2)
SELECT {_STAMP.format('w')} AS window_start, {_STAMP.format('x')} AS window_end,
  CAST(sum(n) OVER (PARTITION BY w ORDER BY x) AS BIGINT) AS new_account_cnt FROM s""")
sql("local_day_totals", f"""SELECT event_type, count(*) AS n, {_STAMP.format('w')} AS window_start,
  {_STAMP.format('w + INTERVAL 1 DAY')} AS window_end
  FROM (SELECT event_type, time_bucket(INTERVAL 1 DAY, ts + INTERVAL 8 HOUR) - INTERVAL 8 HOUR AS w FROM e) GROUP BY event_type, w""")

sql("latest_versions", """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, user_id, event_type, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""", common=False)
sql("unify_layers", f""", d AS (SELECT uid, dt, sum(amount) AS amount, count(*) AS n, max(ms) AS last_ms FROM e GROUP BY 1, 2)
SELECT uid, dt, CAST(CASE WHEN dt < '{RUN_DAY}' THEN -amount END AS BIGINT) AS amount, n,
  CASE WHEN dt < '{RUN_DAY}' THEN epoch_ms(CAST(dt AS TIMESTAMP)) + 93600000 ELSE last_ms END AS dw_create_time FROM d""")
sql("protected_keys", """SELECT c_custkey, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment ELSE 'unknown' END AS segment,
  CAST(CASE WHEN c_nationkey > 5 THEN c_nationkey ELSE -1 END AS BIGINT) AS nation,
  CAST(CASE WHEN c_acctbal > 0 THEN floor(c_acctbal) END AS BIGINT) AS balance FROM customer""", common=False)
sql("wide_rows", """SELECT reverse(CAST(c_custkey AS VARCHAR)) AS rowkey, c_custkey AS id, c_name AS name,
  CAST(c_nationkey AS BIGINT) AS nation, c_mktsegment AS segment FROM customer""", common=False)

# ---- nightly jobs
_HEAD = "dt, event_id, 't' || i AS trace_id, 's' || uid AS session_id, mid, ms - 300 AS client_ts"
_PAGE = "'/p' AS url_path, event_type AS referer, '10.0.0.' || (uid % 250) AS ip"
_DEVICE = "device_id, brand, 'm1' AS model, os, '17.1' AS os_version, network"
_SCREEN = "CAST(1080 AS BIGINT) AS screen_width, k + 2000 AS screen_height, 'cmcc' AS carrier"
_APP = "app_version, channel, platform"


def _clock(at: str) -> str:
    return f"""{at} AS server_ts, {seconds_text(at)} AS event_time, {day_text(at)} AS event_date,
  strftime(make_timestamp((({at}) // 1000) * 1000000), '%H') AS event_hour"""


def _nulls(names: str, kind: str) -> str:
    return ", ".join(f"CAST(NULL AS {kind}) AS {n}" for n in names.split())


sql("dwd_account_actions", f"""SELECT {_HEAD}, server_ts, {seconds_text('server_ts')} AS event_time, {_PAGE}, {_DEVICE}, {_APP},
  target_mid, event_type AS action_from, k % 7 AS target_level, k * 10 AS target_follower_cnt,
  CASE k % 3 WHEN 0 THEN true WHEN 1 THEN false END AS is_mutual,
  {_nulls('special_group unfollow_reason block_reason msg_type report_reason report_evidence', 'VARCHAR')},
  {_nulls('follow_duration_days msg_length', 'BIGINT')}, {_nulls('is_following is_first_msg', 'BOOLEAN')} FROM sv""")
sql("dwd_comment_actions", f"""SELECT {_HEAD}, oid, rpid, CAST(1 AS BIGINT) AS otype, {_clock('ms')}, {_PAGE}, 'ua' AS ua, {_DEVICE},
  {_SCREEN}, {_APP}, 'c' || i AS content, k + 1 AS content_length, k % 2 = 0 AS has_emoji, root_rpid, parent_rpid,
  {_nulls('has_at is_root_comment', 'BOOLEAN')}, {_nulls('reply_to_mid comment_owner_mid comment_age_hours', 'BIGINT')},
  {_nulls('from_page old_content new_content edit_reason delete_reason report_reason report_content_preview', 'VARCHAR')},
  'c' || i AS properties, os AS device_info, platform AS app_context FROM ce""")
sql("dwd_video_actions", f"""SELECT {_HEAD}, bvid, {_clock('server_ts')}, {_PAGE}, 'ua' AS ua, {_DEVICE}, {_SCREEN}, {_APP},
  event_id IS NOT NULL AND mid IS NOT NULL AND server_ts IS NOT NULL AS is_valid,
  CASE WHEN event_id IS NULL THEN 'missing_event_id' WHEN mid IS NULL THEN 'missing_mid'
       WHEN server_ts IS NULL THEN 'missing_server_ts' END AS invalid_reason,
  event_type AS view_from, event_type AS action_from, k % 2 = 0 AS is_auto_play, k AS progress_sec, k AS danmaku_progress_sec,
  CAST(1.5 AS DOUBLE) AS play_speed, coin_count, '[' || k || ',' || uid || ']' AS fav_folder_ids, 'c' || k AS danmaku_content,
  {_nulls('spm_id quality upload_id resolution upload_type title category error_code error_msg updated_fields delete_reason share_channel share_result danmaku_type danmaku_color', 'VARCHAR')},
  {_nulls('total_sec file_size_mb duration_sec progress_percent uploaded_mb speed_kbps upload_duration_sec retry_count video_age_days remain_coins', 'BIGINT')},
  {_nulls('is_full_screen is_liked_before with_like create_new_folder', 'BOOLEAN')},
  event_type AS properties, os AS device_info, platform AS app_context FROM ve""")
_ORDER_COLUMNS = f"""dt, order_no, mid, {ints('current_vip_type plan_duration_days original_price final_price discount_amount pay_duration_sec retry_count')},
  CAST(NULL AS BIGINT) AS current_vip_expire_ts, plan_id, plan_name, coupon_id, pay_method, new_expire AS new_vip_expire_ts,
  order_status, create_ts, pay_start_ts, pay_end_ts, error_code, error_msg, cancel_stage, device_id, platform, app_version,
  channel, ip, from_page, trace_id, session_id"""
sql("dwd_vip_orders", f"SELECT {_ORDER_COLUMNS} FROM ords")
_NEWEST = (
    "mid current_vip_type plan_id plan_name plan_duration_days original_price final_price discount_amount coupon_id "
    "pay_method pay_duration_sec new_expire error_code error_msg retry_count cancel_stage"
)
_NEWEST_COLUMNS = ", ".join(f"arg_max({n}, ms) FILTER (WHERE {n} IS NOT NULL) AS {n}" for n in _NEWEST.split())
sql("dwd_vip_orders_newest", f""", fresh AS (
  SELECT dt, order_no, {_NEWEST_COLUMNS} FROM oe WHERE order_no IS NOT NULL AND order_no <> '' GROUP BY dt, order_no),
o2 AS (SELECT f.*, o.* EXCLUDE ({', '.join(['dt', 'order_no', *_NEWEST.split()])}) FROM fresh f JOIN ords o USING (dt, order_no))
SELECT {_ORDER_COLUMNS} FROM o2""")
_STATS = f"{VIDEO_METRICS} view_user_count avg_play_duration_sec"
sql("dwd_video_stats", f"SELECT dt, bvid, {ints(_STATS)} FROM vstats")
sql("dwd_video_stats_triple", f""", t AS (SELECT dt, bvid, {interactions(True)},
  count(DISTINCT CASE WHEN event_id = 'video_view' THEN mid END) AS view_user_count FROM ve WHERE bvid IS NOT NULL GROUP BY dt, bvid)
SELECT dt, bvid, {ints(VIDEO_METRICS + ' view_user_count')},
  CAST(trunc(total_play_duration_sec / nullif(view_user_count, 0)) AS BIGINT) AS avg_play_duration_sec FROM t""")
_CSTATS = (
    "like_count_delta unlike_count_delta dislike_count_delta undislike_count_delta reply_count_delta report_count "
    "net_like_delta net_dislike_delta"
)
sql("dwd_comment_stats", f"SELECT dt, rpid, oid, {ints(_CSTATS)} FROM cstats")
sql("dwd_comment_stats_parent", f""", p AS (
  SELECT dt, oid, event_id, CASE WHEN event_id = 'comment_reply' THEN parent_rpid ELSE rpid END AS rpid FROM ce)
SELECT dt, rpid, oid, {', '.join(f"CAST({count_of(ev)} AS BIGINT) AS {n}" for n, ev in (
    ('like_count_delta', 'comment_like'), ('unlike_count_delta', 'comment_unlike'), ('dislike_count_delta', 'comment_dislike'),
    ('undislike_count_delta', 'comment_undislike'), ('reply_count_delta', 'comment_reply'), ('report_count', 'comment_report')))},
  CAST({net(('comment_like',), ('comment_unlike',))} AS BIGINT) AS net_like_delta,
  CAST({net(('comment_dislike',), ('comment_undislike',))} AS BIGINT) AS net_dislike_delta
FROM p WHERE rpid IS NOT NULL GROUP BY dt, rpid, oid""")
sql("video_reply_counts", "SELECT dt, bvid, reply_delta FROM replies")

_ACCOUNT_INTS = (
    "level age birth_year vip_type status official_type tag_cnt account_age_days following_cnt follower_cnt "
    "mutual_follow_cnt blocking_cnt blocked_by_cnt following_chg follower_chg"
)
_ACCOUNT_PLAIN = (
    "nick_name sex face_url sign birthday vip_type_name status_name official_desc is_official privacy_show_fav "
    "privacy_show_history push_comment push_like push_at theme tags primary_tag following_list follower_list "
    "mutual_follow_list blocking_list blocked_by_list"
)
sql("dim_account", f"""SELECT mid, {ints(_ACCOUNT_INTS)}, {_ACCOUNT_PLAIN.replace(' ', ', ')}, coins,
  {seconds_text('expire_ms')} AS vip_expire, {seconds_text('created_ms')} AS created_at, {seconds_text('updated_ms')} AS updated_at
  FROM account""")
_COUNTERS = "view_count danmaku_count reply_count favorite_count coin_count share_count like_count"
sql("dim_video", f"""SELECT bvid, title, CAST(NULL AS VARCHAR) AS cover, desc_text, {ints('duration pubdate mid category_id')}, category_name,
  CASE WHEN title IS NOT NULL THEN CAST(0 AS BIGINT) END AS state, CASE WHEN title IS NOT NULL THEN CAST(0 AS BIGINT) END AS attribute,
  is_private, CASE WHEN title IS NOT NULL THEN '1.2.3.4' END AS upload_ip, {_nulls('camera software resolution audit_info', 'VARCHAR')},
  CAST(mid AS BIGINT) AS fps, {ints(_COUNTERS)}, pubdate AS created_at, CAST(updated_at AS BIGINT) AS updated_at,
  pub_date AS created_date, updated_date, pub_date,
  CASE WHEN title IS NOT NULL THEN '{{"upload_ip":"1.2.3.4","fps":' || mid || '}}' END AS meta_info,
  CASE WHEN title IS NOT NULL THEN '{{"view":' || substr(bvid, 3) || '}}' END AS stats FROM video""")
sql("dim_comment", f"""SELECT rpid, oid, CASE WHEN content IS NOT NULL THEN CAST(1 AS BIGINT) END AS otype, mid, root, root AS parent, content,
  {ints('like_count dislike_count reply_count')}, CASE WHEN content IS NOT NULL THEN CAST(0 AS BIGINT) END AS state,
  root = 0 AS is_root, created_at, CAST(updated_at AS BIGINT) AS updated_at, {day_text('created_at')} AS created_date, updated_date FROM comment""")

_FRESH = f"SELECT a.* FROM account a WHERE a.mid NOT IN (SELECT mid FROM acc0)"
_REG_INTS = "level age birth_year vip_type status official_type"
_REG_PLAIN = "sex vip_type_name status_name is_official theme primary_tag"
_REG = f"SELECT {cols(REGISTRY)}, count(*) AS new_account_cnt FROM ({_FRESH}) GROUP BY ALL"
sql("dws_account_registry", f"""SELECT {ints(_REG_INTS)}, {_REG_PLAIN.replace(' ', ', ')}, new_account_cnt, '{RUN_DAY}' AS dt FROM ({_REG})""")
sql("serve_registry", f"""SELECT coalesce(sex, 'unknown') AS sex, CAST(coalesce(level, -1) AS BIGINT) AS level,
  CAST(coalesce(age, -1) AS BIGINT) AS age, CAST(coalesce(birth_year, 0) AS BIGINT) AS birth_year,
  CAST(coalesce(vip_type, 0) AS BIGINT) AS vip_type, vip_type_name, CAST(coalesce(status, 0) AS BIGINT) AS status, status_name,
  CAST(coalesce(official_type, -1) AS BIGINT) AS official_type, is_official, coalesce(theme, '') AS theme,
  coalesce(primary_tag, '') AS primary_tag, new_account_cnt, '{RUN_DAY}' AS dt FROM ({_REG})""")
_UPLOADER = f"""SELECT u.dt, {{mid}} AS mid, {ints(UPLOADER_INTS, 'a.')}, {cols(UPLOADER_PLAIN, 'a.')}, {ints(UPLOADER_TOTALS, 'u.')}
  FROM uploader u LEFT JOIN account a ON a.mid = u.mid"""
sql("dws_uploader_summary", _UPLOADER.format(mid="a.mid"))
sql("serve_uploaders", _UPLOADER.format(mid="coalesce(a.mid, 0)"))
_VIDEO_ROWS = f"""SELECT s.dt, s.bvid, v.title, {ints('duration pubdate category_id', 'v.')}, v.pub_date, v.category_name, CAST({{mid}} AS BIGINT) AS mid,
  {ints(UPLOADER_INTS, 'a.')}, {cols(UPLOADER_PLAIN, 'a.')},
  {ints('view_count view_user_count total_play_duration_sec avg_play_duration_sec net_like_delta coin_count_delta coin_total_delta net_favorite_delta share_count danmaku_count triple_count', 's.')},
  CAST(s.like_count_delta AS BIGINT) AS like_delta, CAST(s.unlike_count_delta AS BIGINT) AS unlike_delta,
  CAST(s.favorite_count_delta AS BIGINT) AS favorite_delta, CAST(s.unfavorite_count_delta AS BIGINT) AS unfavorite_delta
  FROM vstats s JOIN video v ON v.bvid = s.bvid LEFT JOIN account a ON a.mid = v.mid"""
sql("dws_video_summary", _VIDEO_ROWS.format(mid="v.mid"))
sql("serve_videos", _VIDEO_ROWS.format(mid="coalesce(v.mid, 0)"))
_OS_INTS = (
    "plan_duration_days current_vip_type age birth_year level official_type account_age_days follower_cnt order_cnt "
    "order_user_cnt original_price final_price discount_amount pay_duration_sec"
)
_OS_PLAIN = (
    "dt order_status plan_id plan_name pay_method platform channel from_page coupon_id error_code cancel_stage sex "
    "is_official primary_tag"
)
sql("dws_order_source", f"SELECT {ints(_OS_INTS)}, {_OS_PLAIN.replace(' ', ', ')} FROM ({ORDER_SOURCE})")
_OS_KEPT_INTS = " ".join(n for n in _OS_INTS.split() if n not in ("level", "official_type"))
_OS_KEPT = " ".join(n for n in _OS_PLAIN.split() if n not in ("order_status", "plan_id", "pay_method", "platform", "channel", "sex"))
sql("serve_orders", f"""SELECT {ints(_OS_KEPT_INTS)}, {_OS_KEPT.replace(' ', ', ')}, CAST(coalesce(level, -1) AS BIGINT) AS level,
  CAST(coalesce(official_type, -1) AS BIGINT) AS official_type, coalesce(sex, 'unknown') AS sex,
  {', '.join(f"coalesce({n}, '') AS {n}" for n in ('order_status', 'plan_id', 'pay_method', 'platform', 'channel'))} FROM ({ORDER_SOURCE})""")
sql("exact_uploader_viewers", """SELECT v.dt, CAST(o.mid AS BIGINT) AS mid, count(DISTINCT v.mid) AS view_user_count
  FROM ve v JOIN video o ON o.bvid = v.bvid WHERE event_id = 'video_view' GROUP BY v.dt, o.mid""")


def _packed(family: str, names: dict[str, str]) -> str:
    return ", ".join(f"CAST({value} AS VARCHAR) AS {family}__{name}" for name, value in names.items())


def _same(names: str) -> dict[str, str]:
    return {n: n for n in names.split()}


_LISTS = "following_list follower_list mutual_follow_list blocking_list blocked_by_list"
sql("serve_account_rows", f"""SELECT reverse(CAST(mid AS VARCHAR)) AS rowkey,
  {_packed('basic', _same('mid nick_name sex face_url sign level birthday age birth_year'))},
  {_packed('status', {'coins': "printf('%.2f', coins)", 'vip_type': 'vip_type', 'vip_type_name': 'vip_type_name', 'vip_expire': seconds_text('expire_ms'), 'status': 'status', 'status_name': 'status_name'})},
  {_packed('official', _same('official_type official_desc is_official'))},
  {_packed('setting', _same('privacy_show_fav privacy_show_history push_comment push_like push_at theme'))},
  {_packed('tag', _same('tags tag_cnt primary_tag'))},
  {_packed('relation', _same('following_list following_cnt follower_list follower_cnt mutual_follow_list mutual_follow_cnt blocking_list blocking_cnt blocked_by_list blocked_by_cnt following_chg follower_chg'))},
  {_packed('etl', {'created_at': seconds_text('created_ms'), 'updated_at': seconds_text('updated_ms'), 'account_age_days': 'account_age_days', 'dw_create_time': f"'{RUN_TS_TEXT}'"})}
  FROM account WHERE {day_text('updated_ms')} <= '{RUN_DAY}'""")
sql("serve_video_rows", f"""SELECT reverse(bvid) AS rowkey,
  {_packed('basic', {'bvid': 'bvid', 'mid': 'mid', 'pubdate': 'pubdate', 'state': 'CASE WHEN title IS NOT NULL THEN 0 END', 'attribute': 'CASE WHEN title IS NOT NULL THEN 0 END', 'is_private': 'is_private'})},
  {_packed('content', {'title': 'title', 'cover': 'NULL', 'desc_text': 'desc_text', 'duration': 'duration', 'category_id': 'category_id', 'category_name': 'category_name'})},
  {_packed('stats', _same(_COUNTERS))},
  {_packed('meta', {'created_at': 'pubdate', 'updated_at': 'updated_at', 'created_date': 'pub_date', 'updated_date': 'updated_date', 'pub_date': 'pub_date', 'upload_ip': "CASE WHEN title IS NOT NULL THEN '1.2.3.4' END", 'camera': 'NULL', 'software': 'NULL', 'resolution': 'NULL', 'fps': 'mid', 'audit_info': 'NULL', 'meta_info': "CASE WHEN title IS NOT NULL THEN '{{" + '"upload_ip":"1.2.3.4","fps":' + "' || mid || '}}' END".replace('}}', '}'), 'stats_json': "CASE WHEN title IS NOT NULL THEN '" + '{"view":' + "' || substr(bvid, 3) || '}' END"}).replace('{{', '{')}
  FROM video WHERE updated_date <= '{RUN_DAY}'""")
sql("serve_comment_rows", f"""SELECT reverse(CAST(rpid AS VARCHAR)) || '_' || oid AS rowkey,
  {_packed('info', {'rpid': 'rpid', 'oid': 'oid', 'otype': 'CASE WHEN content IS NOT NULL THEN 1 END', 'mid': 'mid', 'root': 'root', 'parent': 'root', 'state': 'CASE WHEN content IS NOT NULL THEN 0 END'})},
  content AS content__content, {_packed('stats', _same('like_count dislike_count reply_count'))},
  {_packed('meta', {'created_at': 'created_at', 'updated_at': 'updated_at', 'created_date': day_text('created_at'), 'updated_date': 'updated_date'})}
  FROM comment WHERE updated_date <= '{RUN_DAY}'""")

# ---- live summaries
COUNTED = (
    "video_view", "video_play_heartbeat", "video_like", "video_unlike", "video_coin", "video_favorite", "video_unfavorite",
    "video_share", "video_danmaku", "video_triple",
)
# A message without server_ts has no event time and falls into no window.
_COUNTED = f"FROM ve WHERE mid IS NOT NULL AND bvid IS NOT NULL AND server_ts IS NOT NULL AND {when('event_id', COUNTED)}"
_LIVE_UPLOADER = f"""SELECT dt, mid, CAST(video_cnt AS BIGINT) AS video_cnt, {', '.join(f'CAST({m} AS BIGINT) AS {t}' for t, m in {
    'total_view_count': 'view_count', 'total_play_duration_sec': 'total_play_duration_sec', 'total_like_delta': 'like_count_delta',
    'total_unlike_delta': 'unlike_count_delta', 'total_net_like_delta': 'net_like_delta', 'total_coin_count_delta': 'coin_count_delta',
    'total_coin_total_delta': 'coin_total_delta', 'total_favorite_delta': 'favorite_count_delta',
    'total_unfavorite_delta': 'unfavorite_count_delta', 'total_net_favorite_delta': 'net_favorite_delta',
    'total_share_count': 'share_count', 'total_danmaku_count': 'danmaku_count', 'total_triple_count': 'triple_count'}.items())},
  {_nulls('level vip_type official_type follower_cnt following_cnt total_view_user_count avg_play_duration_sec', 'BIGINT')},
  {_nulls('nick_name sex vip_type_name official_desc', 'VARCHAR')}, CAST(NULL AS BOOLEAN) AS is_official
  FROM (SELECT dt, mid, count(DISTINCT bvid) AS video_cnt, {interactions(True)} {_COUNTED} GROUP BY dt, mid)"""
sql("speed_uploader", _LIVE_UPLOADER)
sql("stream_uploader", _LIVE_UPLOADER)
sql("speed_video", f"""SELECT t.dt, t.bvid, t.mid, v.title, {ints('duration pubdate category_id', 'v.')}, v.pub_date, v.category_name,
  {ints(UPLOADER_INTS, 'a.')}, {cols(UPLOADER_PLAIN, 'a.')},
  {ints('view_count total_play_duration_sec net_like_delta coin_count_delta coin_total_delta net_favorite_delta share_count danmaku_count triple_count', 't.')},
  CAST(t.like_count_delta AS BIGINT) AS like_delta, CAST(t.unlike_count_delta AS BIGINT) AS unlike_delta,
  CAST(t.favorite_count_delta AS BIGINT) AS favorite_delta, CAST(t.unfavorite_count_delta AS BIGINT) AS unfavorite_delta,
  {_nulls('view_user_count avg_play_duration_sec', 'BIGINT')}
  FROM (SELECT dt, bvid, mid, {interactions(True)} {_COUNTED} GROUP BY dt, bvid, mid) t
  LEFT JOIN video v ON v.bvid = t.bvid LEFT JOIN account a ON a.mid = t.mid""")
sql("stream_video_lookup", f"""SELECT t.dt || ' 00:00:00' AS window_start, t.bvid, t.mid,
  CASE WHEN v.bvid IS NOT NULL THEN p_name || (CASE WHEN again THEN ' v1' ELSE ' v0' END) END AS title, {ints('duration pubdate', 'v.')},
  CAST(v.mid AS BIGINT) AS category_id, {day_text('v.pubdate')} AS pub_date, v.category_name,
  {ints(UPLOADER_INTS, 'a.')}, {cols(UPLOADER_PLAIN, 'a.')}, {ints(VIDEO_METRICS, 't.')}
  FROM (SELECT dt, bvid, mid, {interactions(True)} {_COUNTED} GROUP BY dt, bvid, mid) t
  LEFT JOIN parts v ON v.bvid = t.bvid LEFT JOIN account a ON a.mid = t.mid AND a.updated_ms IS NOT NULL""")
_LIVE_ORDERS = f"""SELECT dt, {ORDER_KEYS.replace(' ', ', ')}, current_vip_type, count(*) AS order_cnt, count(DISTINCT mid) AS order_user_cnt,
  {', '.join(f'CAST(sum({n}) AS DOUBLE) AS {n}' for n in AMOUNTS.split())}, CAST(max(pay_duration_sec) AS BIGINT) AS pay_duration_sec,
  {', '.join(f'CAST({v} AS BIGINT) AS {n}' for n, v in {'plan_duration_days': 0, 'age': -1, 'birth_year': -1, 'level': -1, 'official_type': -1, 'account_age_days': -1, 'follower_cnt': -1}.items())},
  'unknown' AS from_page, 'unknown' AS sex, 'unknown' AS primary_tag, false AS is_official
  FROM (SELECT dt, mid, CASE event_id WHEN 'vip_create_order' THEN 'created' WHEN 'vip_pay_start' THEN 'paying' WHEN 'vip_pay_success' THEN 'success'
      WHEN 'vip_pay_fail' THEN 'fail' ELSE 'cancel' END AS order_status,
    coalesce(plan_id, 'unknown') AS plan_id, plan_name, coalesce(pay_method, 'unknown') AS pay_method, platform,
    coalesce(channel, 'unknown') AS channel, current_vip_type, coalesce(coupon_id, '') AS coupon_id,
    coalesce(error_code, '') AS error_code, coalesce(cancel_stage, '') AS cancel_stage, original_price, final_price,
    discount_amount, coalesce(pay_duration_sec, 0) AS pay_duration_sec
    FROM oe WHERE mid IS NOT NULL AND {when('event_id', ('vip_create_order', 'vip_pay_start', 'vip_pay_success', 'vip_pay_fail', 'vip_pay_cancel'))})
  GROUP BY ALL"""
sql("speed_vip_order", _LIVE_ORDERS)
sql("stream_vip_order", _LIVE_ORDERS)
_REGISTER = "FROM ae WHERE event_id = 'account_register' AND mid IS NOT NULL"
_LIVE_REGISTRATION = f"""SELECT dt, count(*) AS new_account_cnt,
  {', '.join(f'CAST(-1 AS BIGINT) AS {n}' for n in ('level', 'age', 'birth_year', 'vip_type', 'status', 'official_type'))},
  {', '.join(f"'unknown' AS {n}" for n in ('sex', 'vip_type_name', 'status_name', 'theme', 'primary_tag'))}, false AS is_official
  {_REGISTER} GROUP BY dt"""
sql("speed_registration", _LIVE_REGISTRATION)
sql("stream_registration", _LIVE_REGISTRATION)
_LIVE_SOURCES = f"""SELECT strftime(ts, '%Y-%m-%d %H:00:00') AS dt, platform, coalesce(own_channel, channel, 'unknown') AS channel,
  register_type, coalesce(source_page, 'unknown') AS source_page, os, brand, app_version, network, count(*) AS new_account_cnt,
  count(DISTINCT device_id) AS new_device_cnt {_REGISTER} GROUP BY ALL"""
sql("speed_registration_source", _LIVE_SOURCES)
sql("stream_registration_source", _LIVE_SOURCES)

sql("speed_account_columns", f""", p AS (SELECT *, CASE WHEN regexp_full_match(birthday, '\\d{{4}}-\\d{{2}}-\\d{{2}}') THEN TRY_CAST(birthday AS DATE) END AS born FROM profile)
SELECT reverse(CAST(mid AS VARCHAR)) AS rowkey, CAST(1704000001000 AS BIGINT) AS version,
  {_packed('basic', _same('mid nick_name sex') | {'face_url': "'f.jpg'"} | _same('sign level birthday') | {'age': f"date_sub('year', born, DATE '{RUN_DAY}')", 'birth_year': "CASE WHEN regexp_full_match(birthday, '\\d{4}-\\d{2}-\\d{2}') THEN CAST(substr(birthday, 1, 4) AS INT) END"})},
  {_packed('status', {'coins': "printf('%.2f', coins)", 'vip_type': 'NULL', 'vip_type_name': "'未知'", 'status': 'status', 'status_name': "CASE status WHEN 0 THEN '正常' WHEN 1 THEN '封禁' WHEN 2 THEN '注销' ELSE '未知' END"})},
  {_packed('official', {'official_type': 'coalesce(kind, -1)', 'official_desc': 'official_desc', 'is_official': 'coalesce(kind >= 0, false)'})},
  {_packed('setting', {'privacy_show_fav': 'privacy_show_fav', 'privacy_show_history': 'false', 'push_comment': 'true', 'push_like': 'push_like', 'push_at': 'true', 'theme': 'theme'})},
  {_packed('tag', _same('tags tag_cnt primary_tag'))},
  {_packed('etl', {'created_at': seconds_text('created_ms'), 'updated_at': seconds_text('1704000001000'), 'account_age_days': f"date_diff('day', CAST(make_timestamp(created_ms * 1000) AS DATE), DATE '{RUN_DAY}')", 'dw_create_time': f"'{RUN_TS_TEXT}'"})}
  FROM p""")
_META = """'{"upload_ip":"1.2.3.4","camera":"","software":"","resolution":"","fps":' || mid || '}'"""
_STATS_JSON = """'{"view":' || pk || ',"danmaku":0,"reply":0,"favorite":0,"coin":0,"share":0,"like":0}'"""
_AT = "CASE WHEN again THEN 1706600000000 ELSE 1704000000000 + pk END"
_ATTRIBUTES = f"""{_packed('basic', {'bvid': 'bvid', 'mid': 'mid', 'pubdate': 'pubdate', 'state': '0', 'attribute': '0', 'is_private': 'is_private'})},
  {_packed('content', {'title': "p_name || (CASE WHEN again THEN ' v1' ELSE ' v0' END)", 'cover': 'NULL', 'desc_text': 'desc_text', 'duration': 'duration', 'category_id': 'mid', 'category_name': 'category_name'})},
  {_packed('meta', {'created_at': 'pubdate', 'updated_at': _AT, 'created_date': day_text('pubdate'), 'updated_date': day_text(_AT), 'pub_date': day_text('pubdate'), 'upload_ip': "'1.2.3.4'", 'camera': 'NULL', 'software': 'NULL', 'resolution': 'NULL', 'fps': 'mid', 'audit_info': 'NULL', 'meta_info': _META, 'stats_json': _STATS_JSON})}"""
sql("speed_video_columns", f"SELECT reverse(bvid) AS rowkey, CAST({_AT} AS BIGINT) AS version, {_ATTRIBUTES} FROM parts")
sql("speed_comment_columns", f""", c AS (SELECT *, row_number() OVER (PARTITION BY rpid, oid ORDER BY updated_at DESC, content DESC) AS newest FROM centity)
SELECT reverse(CAST(rpid AS VARCHAR)) || '_' || oid AS rowkey, updated_at AS version,
  {_packed('info', {'rpid': 'rpid', 'oid': 'oid', 'otype': '1', 'mid': 'mid', 'root': 'root', 'parent': 'root', 'state': '0'})},
  content AS content__content,
  {_packed('meta', {'created_at': 'created_at', 'updated_at': 'updated_at', 'created_date': day_text('created_at'), 'updated_date': day_text('updated_at')})}
  FROM c WHERE newest = 1""")
MOVING = ("video_view", "video_like", "video_unlike", "video_coin", "video_favorite", "video_unfavorite", "video_share", "video_danmaku", "video_triple")
_LIVE_COUNTERS = f"""SELECT dt, bvid, CAST(view_count AS BIGINT) AS view_count, CAST(danmaku_count AS BIGINT) AS danmaku_count,
  CAST(net_favorite_delta AS BIGINT) AS favorite_count, CAST(coin_total_delta AS BIGINT) AS coin_count,
  CAST(share_count AS BIGINT) AS share_count, CAST(net_like_delta AS BIGINT) AS like_count, version
  FROM (SELECT dt, bvid, {interactions(True)}, max(ms) AS version FROM ve WHERE bvid IS NOT NULL AND {when('event_id', MOVING)} GROUP BY dt, bvid)"""
sql("speed_video_counters", _LIVE_COUNTERS)
sql("speed_video_counters_total", f""", today AS ({_LIVE_COUNTERS}),
old AS (SELECT bvid, sum(view_count) AS view_count, sum(danmaku_count) AS danmaku_count, sum(net_favorite_delta) AS favorite_count,
  sum(coin_total_delta) AS coin_count, sum(share_count) AS share_count, sum(net_like_delta) AS like_count
  FROM vstats WHERE dt < '{RUN_DAY}' GROUP BY bvid)
SELECT reverse(t.bvid) AS rowkey, {', '.join(f"CAST(t.{n} + CAST(coalesce(o.{n}, 0) AS BIGINT) AS VARCHAR) AS stats__{n}" for n in ('view_count', 'danmaku_count', 'favorite_count', 'coin_count', 'share_count', 'like_count'))}
FROM today t LEFT JOIN old o USING (bvid) WHERE t.dt = '{RUN_DAY}'""")
_LIVE_REPLIES = """SELECT dt, oid AS bvid, count(*) FILTER (WHERE rpid = root_rpid) AS reply_count, max(ms) AS version
  FROM ce WHERE event_id = 'comment_create' GROUP BY dt, oid"""
sql("speed_video_replies", _LIVE_REPLIES)
sql("speed_comment_counters", f"""SELECT dt, target AS rpid, oid, CAST({net(('comment_like',), ('comment_unlike',))} AS BIGINT) AS like_count,
  CAST({net(('comment_dislike',), ('comment_undislike',))} AS BIGINT) AS dislike_count, CAST({count_of('comment_reply')} AS BIGINT) AS reply_count,
  max(ms) AS version
  FROM (SELECT *, CASE WHEN event_id = 'comment_reply' THEN parent_rpid ELSE rpid END AS target FROM ce
    WHERE rpid IS NOT NULL AND {when('event_id', ('comment_like', 'comment_unlike', 'comment_dislike', 'comment_undislike', 'comment_reply'))})
  WHERE target IS NOT NULL GROUP BY dt, target, oid""")

# ---- streams
_CHANGING = ("vip_create_order", "vip_pay_success", "vip_pay_fail", "vip_pay_cancel")
_TTL = 21600000
# What is held of an order after each round: its last event, unless the watermark had passed its limit.
_ORDER_CHANGES = f""", ov AS (SELECT order_no, event_id, ms, mid, plan_id, new_expire, {ROUND} AS round FROM oe
    WHERE order_no IS NOT NULL AND order_no <> '' AND {when('event_id', _CHANGING)}),
marks AS (SELECT r, coalesce((SELECT max(ms) - 5000 FROM ov WHERE round < r), 0) AS mark FROM range(0, {ROUNDS + 1}) AS t(r)),
lasts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY order_no, round ORDER BY ms DESC, event_id DESC) AS rn FROM ov) WHERE rn = 1),
held AS (
  SELECT CAST(-1 AS BIGINT) AS r, order_no, CAST(NULL AS BIGINT) AS ts, CAST(NULL AS VARCHAR) AS ev FROM (SELECT DISTINCT order_no FROM ov)
  UNION ALL
  SELECT h.r + 1, h.order_no,
    CASE WHEN h.ts + {_TTL} >= marks.mark AND (l.ms IS NULL OR (h.ts, h.ev) > (l.ms, l.event_id)) THEN h.ts ELSE l.ms END,
    CASE WHEN h.ts + {_TTL} >= marks.mark AND (l.ms IS NULL OR (h.ts, h.ev) > (l.ms, l.event_id)) THEN h.ev ELSE l.event_id END
  FROM held h JOIN marks ON marks.r = h.r + 1 LEFT JOIN lasts l ON l.order_no = h.order_no AND l.round = h.r + 1 WHERE h.r < {ROUNDS - 1}),
before AS (
  SELECT ov.*, lag(ov.event_id) OVER o AS p_ev, lag(ov.ms) OVER o AS p_ts, h.ev AS h_ev, h.ts AS h_ts
  FROM ov JOIN marks ON marks.r = ov.round
    LEFT JOIN held h ON h.order_no = ov.order_no AND h.r = ov.round - 1 AND h.ts + {_TTL} >= marks.mark
  WINDOW o AS (PARTITION BY ov.order_no, ov.round ORDER BY ov.ms, ov.event_id)),
priors AS (SELECT *, h_ts IS NOT NULL AND (h_ts, h_ev) <= (ms, event_id) AND (p_ts IS NULL OR (h_ts, h_ev) > (p_ts, p_ev)) AS by_held FROM before),
changes AS (
  SELECT order_no, mid, plan_id, new_expire AS new_vip_expire, ms AS server_ts,
    CASE event_id WHEN 'vip_create_order' THEN 'created' WHEN 'vip_pay_success' THEN 'paid' ELSE 'ended' END AS change,
    coalesce(CASE WHEN by_held THEN h_ev ELSE p_ev END = 'vip_create_order'
      AND ms - CASE WHEN by_held THEN h_ts ELSE p_ts END <= {_TTL}, false) AS was_pending FROM priors
  UNION ALL
  SELECT order_no, NULL, NULL, NULL, ts + {_TTL}, 'expired', true
  FROM held JOIN marks ON marks.r = held.r + 1 WHERE ev = 'vip_create_order' AND ts + {_TTL} < mark)
"""


def recursive(text: str) -> str:
    return text.replace("WITH", "WITH RECURSIVE", 1)


ORACLE["stream_order_changes"] = recursive(f"""{COMMON.rstrip().rstrip(',')} {_ORDER_CHANGES}
SELECT order_no, mid, plan_id, new_vip_expire, server_ts, change, was_pending FROM changes""")
ORACLE["stream_pending_orders"] = recursive(f"""{COMMON.rstrip().rstrip(',')} {_ORDER_CHANGES}
SELECT order_no, mid, server_ts FROM (
  SELECT *, row_number() OVER (PARTITION BY order_no ORDER BY server_ts DESC, change DESC) AS rn FROM changes)
WHERE rn = 1 AND change = 'created'""")
sql("stream_vip_updates", f"""SELECT reverse(CAST(mid AS VARCHAR)) AS rowkey, ms AS version,
  CASE WHEN plan_id IN ('monthly', 'auto_monthly') THEN '1' ELSE '2' END AS status__vip_type,
  CASE WHEN plan_id IN ('monthly', 'auto_monthly') THEN '月度大会员' ELSE '年度大会员' END AS status__vip_type_name,
  {seconds_text('new_expire')} AS status__vip_expire, '{RUN_TS_TEXT}' AS etl__updated_at, '{RUN_TS_TEXT}' AS etl__dw_update_time
  FROM (SELECT *, row_number() OVER (PARTITION BY mid ORDER BY ms DESC) AS rn FROM oe
    WHERE order_no IS NOT NULL AND order_no <> '' AND event_id = 'vip_pay_success' AND mid IS NOT NULL AND new_expire IS NOT NULL) WHERE rn = 1""")
_COLUMN_NAMES = ", ".join(
    [*(f"a.basic__{n}" for n in "bvid mid pubdate state attribute is_private".split()),
     *(f"a.content__{n}" for n in "title cover desc_text duration category_id category_name".split()),
     *(f"a.meta__{n}" for n in ("created_at updated_at created_date updated_date pub_date upload_ip camera software "
                                 "resolution fps audit_info meta_info stats_json").split())]
)
sql("stream_column_upsert", f""", attrs AS (SELECT reverse(bvid) AS rowkey, CAST({_AT} AS BIGINT) AS version, {_ATTRIBUTES} FROM parts),
c0 AS ({_LIVE_COUNTERS}), c1 AS (SELECT *, row_number() OVER (PARTITION BY bvid ORDER BY version DESC) AS rn FROM c0),
counters AS (SELECT reverse(bvid) AS rowkey, * EXCLUDE (rn, dt, bvid) FROM c1 WHERE rn = 1),
r0 AS ({_LIVE_REPLIES}), r1 AS (SELECT *, row_number() OVER (PARTITION BY bvid ORDER BY version DESC) AS rn FROM r0),
reps AS (SELECT reverse(bvid) AS rowkey, reply_count, version FROM r1 WHERE rn = 1),
ids AS (SELECT rowkey FROM attrs UNION SELECT rowkey FROM counters UNION SELECT rowkey FROM reps)
SELECT i.rowkey, greatest(a.version, c.version, r.version) AS version, {_COLUMN_NAMES},
  {', '.join(f"CAST(c.{n} AS VARCHAR) AS stats__{n}" for n in ('view_count', 'danmaku_count', 'favorite_count', 'coin_count', 'share_count', 'like_count'))},
  CAST(r.reply_count AS VARCHAR) AS stats__reply_count
FROM ids i LEFT JOIN attrs a USING (rowkey) LEFT JOIN counters c USING (rowkey) LEFT JOIN reps r USING (rowkey)""")
sql("stream_landing", """SELECT dt, 'app_event_' || t AS topic, count(*) AS messages
  FROM e, (SELECT unnest(['video', 'social', 'comment', 'vip', 'account']) AS t) GROUP BY dt, t""")

__all__ = ["ORACLE"]
