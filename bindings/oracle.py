"""SQL twins of the registered queries, for DuckDB over the driver's tables.

They start from the tables themselves, never from the messages, so they also check the message
parsing. ``COMMON`` holds the shared steps as CTEs; a query uses the ones it names.
"""

from __future__ import annotations

from bindings.topics import (
    ACCOUNT_EVENTS,
    COMMENT_EVENTS,
    DAY_BEFORE,
    OLD_RUN_TS_TEXT,
    RUN_DAY,
    RUN_TS_TEXT,
    SOCIAL_EVENTS,
    VIDEO_EVENTS,
    VIP_EVENTS,
)

RUN_MS = f"epoch_ms(TIMESTAMP '{RUN_TS_TEXT}')"
OLD_RUN_MS = f"epoch_ms(TIMESTAMP '{OLD_RUN_TS_TEXT}')"


def pick(values: tuple, by: str) -> str:
    texts = ", ".join("NULL" if v is None else f"'{v}'" for v in values)
    return f"([{texts}])[CAST({by} % {len(values)} AS INT) + 1]"


def when(event: str, names: str | tuple) -> str:
    names = (names,) if isinstance(names, str) else names
    return f"{event} IN ({', '.join(repr(n) for n in names)})"


def count_of(*names: str) -> str:
    return f"coalesce(sum(CASE WHEN {when('event_id', names)} THEN 1 ELSE 0 END), 0)"


def net(plus: tuple, minus: tuple) -> str:
    return (
        f"sum(CASE WHEN {when('event_id', plus)} THEN 1 WHEN {when('event_id', minus)} THEN -1 ELSE 0 END)"
    )


def ints(names: str, prefix: str = "") -> str:
    return ", ".join(f"CAST({prefix}{n} AS BIGINT) AS {n}" for n in names.split())


def floats(names: str, prefix: str = "") -> str:
    return ", ".join(f"CAST({prefix}{n} AS DOUBLE) AS {n}" for n in names.split())


def cols(names: str, prefix: str = "") -> str:
    return ", ".join(f"{prefix}{n}" for n in names.split())


def seconds_text(ms: str) -> str:
    return f"strftime(make_timestamp((({ms}) // 1000) * 1000000), '%Y-%m-%d %H:%M:%S')"


def day_text(ms: str) -> str:
    return f"strftime(make_timestamp((({ms}) // 1000) * 1000000), '%Y-%m-%d')"


def vip_label(code: str) -> str:
    return f"CASE {code} WHEN 0 THEN '普通用户' WHEN 1 THEN '月度大会员' WHEN 2 THEN '年度大会员' ELSE '未知' END"


def status_label(code: str) -> str:
    return f"CASE {code} WHEN 0 THEN '正常' WHEN 1 THEN '封禁' WHEN 2 THEN '注销' ELSE '未知' END"


def interactions(triple: bool) -> str:
    t = ("video_triple",) if triple else ()
    coin = "WHEN event_id = 'video_triple' THEN 2 " if triple else ""
    return f"""
      {count_of('video_view')} AS view_count,
      {count_of('video_play_heartbeat')} * 15 AS total_play_duration_sec,
      {count_of('video_like', *t)} AS like_count_delta,
      {count_of('video_unlike')} AS unlike_count_delta,
      {net(('video_like', *t), ('video_unlike',))} AS net_like_delta,
      {count_of('video_coin', *t)} AS coin_count_delta,
      sum(CASE WHEN event_id = 'video_coin' THEN coalesce(coin_count, 1) {coin}ELSE 0 END) AS coin_total_delta,
      {count_of('video_favorite', *t)} AS favorite_count_delta,
      {count_of('video_unfavorite')} AS unfavorite_count_delta,
      {net(('video_favorite', *t), ('video_unfavorite',))} AS net_favorite_delta,
      {count_of('video_share')} AS share_count,
      {count_of('video_danmaku')} AS danmaku_count,
      {count_of('video_triple')} AS triple_count"""


VIDEO_METRICS = (
    "view_count total_play_duration_sec like_count_delta unlike_count_delta net_like_delta coin_count_delta "
    "coin_total_delta favorite_count_delta unfavorite_count_delta net_favorite_delta share_count "
    "danmaku_count triple_count"
)
ORDER_KEYS = "order_status plan_id plan_name pay_method platform channel coupon_id error_code cancel_stage"
AMOUNTS = "original_price final_price discount_amount"


def vip_chain(dt: str, new: str, days: str, old_expire: str, old_type: str) -> tuple[str, str]:
    closing = f"epoch_ms(TIMESTAMP '{dt} 23:59:59')"
    expire = f"CASE WHEN {new} IS NOT NULL THEN ({new} // 1000) * 1000 ELSE {old_expire} END"
    kind = f"""CASE WHEN {new} IS NOT NULL THEN
        CASE WHEN {new} > {closing} THEN CASE WHEN {days} <= 31 THEN 1 ELSE 2 END ELSE 0 END
      WHEN {old_expire} > {closing} THEN {old_type} ELSE 0 END"""
    return expire, kind


_OLD_EXPIRE, _OLD_TYPE = vip_chain(DAY_BEFORE, "p.new_expire", "p.days", "NULL::BIGINT", "NULL::INT")
_EXPIRE, _TYPE = vip_chain(RUN_DAY, "t.new_expire", "t.days", "o.expire_ms", "o.kind")


def relation_lists(kind: str) -> str:
    return f"'[' || coalesce(string_agg(CASE WHEN {kind} THEN CAST(other AS VARCHAR) END, ', ' ORDER BY other), '') || ']'"


COMMON = f"""WITH
e AS (
  SELECT event_id AS i, user_id AS uid, CAST(json_extract(props, '$.k') AS BIGINT) AS k, epoch_us(ts) // 1000 AS ms,
         strftime(ts, '%Y-%m-%d') AS dt, CAST(floor(value) AS BIGINT) AS amount, event_type, ts
  FROM events),
m AS (
  SELECT *, CASE WHEN i % 97 <> 0 THEN uid END AS mid,
    'd' || (uid % 40) AS device_id, {pick(('Apple', 'Xiaomi', 'Huawei'), 'uid')} AS brand,
    {pick(('iOS', 'Android'), 'uid')} AS os, {pick(('WIFI', '5G'), 'k')} AS network,
    '7.' || (k % 5) AS app_version, CASE WHEN uid % 4 <> 0 THEN {pick(('store', 'web'), 'uid')} END AS channel,
    {pick(('ios', 'android', 'web'), 'uid')} AS platform, uid * 1000 + k AS rkey
  FROM e),
ve AS (
  SELECT *, CASE WHEN i % 83 <> 0 THEN {pick(VIDEO_EVENTS, 'i')} END AS event_id,
    CASE WHEN i % 71 <> 0 THEN 'BV' || k END AS bvid, CASE WHEN i % 89 <> 0 THEN ms END AS server_ts,
    CASE WHEN k % 3 <> 0 THEN k % 3 END AS coin_count
  FROM m),
se AS (
  SELECT *, CASE WHEN i % 83 <> 0 THEN {pick(SOCIAL_EVENTS, 'i')} END AS event_id, k AS target_mid,
    CASE WHEN i % 89 <> 0 THEN ms END AS server_ts
  FROM m),
ce AS (
  SELECT *, CASE WHEN i % 83 <> 0 THEN {pick(COMMENT_EVENTS, 'i')} END AS event_id, 'BV' || k AS oid,
    CASE WHEN i % 79 <> 0 THEN rkey END AS rpid, CASE WHEN i % 2 = 0 THEN rkey END AS root_rpid,
    CASE WHEN k % 10 <> 0 THEN rkey + 1 END AS parent_rpid
  FROM m),
oe0 AS (SELECT *, {pick(VIP_EVENTS, 'i')} AS raw_event, ([31, 30, 366, 93])[CAST(k % 4 AS INT) + 1] AS days FROM m),
oe AS (
  SELECT *, CASE WHEN i % 83 <> 0 THEN raw_event END AS event_id,
    CASE WHEN raw_event = 'vip_page_view' THEN '' WHEN i % 101 <> 0
      THEN 'V' || uid || '-' || (ms // 172800000) END AS order_no,
    k % 3 AS current_vip_type, {pick(('monthly', 'auto_monthly', 'yearly', None), 'k')} AS plan_id,
    {pick(('m', 'am', 'y', 'q'), 'k')} AS plan_name, days AS plan_duration_days,
    amount * 100 AS original_price, amount * 100 - k AS final_price, k AS discount_amount,
    CASE WHEN k % 2 <> 0 THEN 'CPN' || (k % 5) END AS coupon_id,
    CASE WHEN {when('raw_event', ('vip_pay_start', 'vip_pay_success'))} THEN {pick(('alipay', 'wechat'), 'k')} END AS pay_method,
    CASE WHEN raw_event = 'vip_pay_success' THEN k END AS pay_duration_sec,
    CASE WHEN raw_event = 'vip_pay_success' AND k % 11 <> 0 THEN ms + CAST(days AS BIGINT) * 86400000 - 5184000000 END AS new_expire,
    CASE WHEN raw_event = 'vip_pay_fail' THEN 'E' || (k % 4) END AS error_code,
    CASE WHEN raw_event = 'vip_pay_fail' THEN 'failed' END AS error_msg,
    CASE WHEN raw_event = 'vip_pay_fail' THEN k % 3 END AS retry_count,
    CASE WHEN raw_event = 'vip_pay_cancel' THEN 'pay_page' END AS cancel_stage
  FROM oe0),
ae AS (
  SELECT *, CASE WHEN i % 83 <> 0 THEN {pick(ACCOUNT_EVENTS, 'i')} END AS event_id,
    {pick(('login', 'share', None), 'k')} AS source_page, {pick(('phone', 'email'), 'k')} AS register_type,
    CASE WHEN k % 3 <> 0 THEN {pick(('ads', 'friend'), 'k')} END AS own_channel
  FROM m),
vstats AS (
  SELECT *, CAST(trunc(total_play_duration_sec / nullif(view_user_count, 0)) AS BIGINT) AS avg_play_duration_sec FROM (
    SELECT dt, bvid, {interactions(False)},
      count(DISTINCT CASE WHEN event_id = 'video_view' THEN mid END) AS view_user_count
    FROM ve WHERE bvid IS NOT NULL GROUP BY dt, bvid)),
cstats AS (
  SELECT dt, rpid, oid, {count_of('comment_like')} AS like_count_delta, {count_of('comment_unlike')} AS unlike_count_delta,
    {count_of('comment_dislike')} AS dislike_count_delta, {count_of('comment_undislike')} AS undislike_count_delta,
    {count_of('comment_reply')} AS reply_count_delta, {count_of('comment_report')} AS report_count,
    {net(('comment_like',), ('comment_unlike',))} AS net_like_delta,
    {net(('comment_dislike',), ('comment_undislike',))} AS net_dislike_delta
  FROM ce WHERE rpid IS NOT NULL GROUP BY dt, rpid, oid),
replies AS (SELECT dt, oid AS bvid, count(*) AS reply_delta FROM ce WHERE event_id = 'comment_create' GROUP BY dt, oid),
ords AS (
  SELECT dt, order_no, max(mid) AS mid, max(current_vip_type) AS current_vip_type, max(plan_id) AS plan_id,
    max(plan_name) AS plan_name, max(plan_duration_days) AS plan_duration_days, max(original_price) AS original_price,
    max(final_price) AS final_price, max(discount_amount) AS discount_amount, max(coupon_id) AS coupon_id,
    max(pay_method) AS pay_method, max(pay_duration_sec) AS pay_duration_sec, max(new_expire) AS new_expire,
    max(error_code) AS error_code, max(error_msg) AS error_msg, max(retry_count) AS retry_count,
    max(cancel_stage) AS cancel_stage,
    CASE WHEN bool_or(event_id = 'vip_pay_success') THEN 'success' WHEN bool_or(event_id = 'vip_pay_fail') THEN 'fail'
      WHEN bool_or(event_id = 'vip_pay_cancel') THEN 'cancel' WHEN bool_or(event_id = 'vip_pay_start') THEN 'paying'
      ELSE 'created' END AS order_status,
    min(CASE WHEN event_id = 'vip_create_order' THEN ms END) AS create_ts,
    min(CASE WHEN event_id = 'vip_pay_start' THEN ms END) AS pay_start_ts,
    max(CASE WHEN {when('event_id', ('vip_pay_success', 'vip_pay_fail', 'vip_pay_cancel'))} THEN ms END) AS pay_end_ts,
    min(device_id) AS device_id, min(platform) AS platform, min(app_version) AS app_version, min(channel) AS channel,
    min('10.0.0.' || (uid % 250)) AS ip, min(event_type) AS from_page, min('t' || i) AS trace_id,
    min('s' || uid) AS session_id
  FROM oe WHERE order_no IS NOT NULL AND order_no <> '' GROUP BY dt, order_no),
paid AS (
  SELECT mid, dt < '{RUN_DAY}' AS past, new_expire, plan_duration_days AS days,
    row_number() OVER (PARTITION BY mid, dt < '{RUN_DAY}' ORDER BY pay_end_ts DESC, order_no DESC) AS rn
  FROM ords WHERE order_status = 'success' AND mid IS NOT NULL AND new_expire IS NOT NULL),
sv AS (SELECT * FROM se WHERE event_id IS NOT NULL AND mid IS NOT NULL),
edges AS (
  SELECT mid AS a, target_mid AS b,
    bool_or(dt < '{RUN_DAY}' AND event_id = 'social_follow') AS pf, bool_or(dt < '{RUN_DAY}' AND event_id = 'social_unfollow') AS pu,
    bool_or(dt = '{RUN_DAY}' AND event_id = 'social_follow') AS tf, bool_or(dt = '{RUN_DAY}' AND event_id = 'social_unfollow') AS tu,
    bool_or(dt < '{RUN_DAY}' AND event_id = 'social_block') AS pb, bool_or(dt < '{RUN_DAY}' AND event_id = 'social_unblock') AS pn,
    bool_or(dt = '{RUN_DAY}' AND event_id = 'social_block') AS tb, bool_or(dt = '{RUN_DAY}' AND event_id = 'social_unblock') AS tn
  FROM sv GROUP BY 1, 2),
state AS (
  SELECT a, b, ((pf AND NOT pu) OR tf) AND NOT tu AS follows, ((pb AND NOT pn) OR tb) AND NOT tn AS blocks,
    CAST(tf AS INT) - CAST(tu AS INT) AS chg
  FROM edges),
both_ways AS (
  SELECT coalesce(x.a, y.b) AS me, coalesce(x.b, y.a) AS other,
    coalesce(x.follows, false) AS following, coalesce(y.follows, false) AS follower,
    coalesce(x.blocks, false) AS blocking, coalesce(y.blocks, false) AS blocked_by,
    coalesce(x.chg, 0) AS following_chg, coalesce(y.chg, 0) AS follower_chg
  FROM state x FULL JOIN state y ON x.a = y.b AND x.b = y.a),
rel AS (
  SELECT me AS mid, {relation_lists('following')} AS following_list, count(*) FILTER (WHERE following) AS following_cnt,
    {relation_lists('follower')} AS follower_list, count(*) FILTER (WHERE follower) AS follower_cnt,
    {relation_lists('following AND follower')} AS mutual_follow_list, count(*) FILTER (WHERE following AND follower) AS mutual_follow_cnt,
    {relation_lists('blocking')} AS blocking_list, count(*) FILTER (WHERE blocking) AS blocking_cnt,
    {relation_lists('blocked_by')} AS blocked_by_list, count(*) FILTER (WHERE blocked_by) AS blocked_by_cnt,
    sum(following_chg) AS following_chg, sum(follower_chg) AS follower_chg
  FROM both_ways GROUP BY me),
profile AS (
  SELECT c_custkey AS mid, c_name || '#' || (CASE WHEN c_custkey % 5 = 0 THEN 0 ELSE 1 END) AS nick_name,
    {pick(('男', '女', '保密'), 'c_custkey')} AS sex, c_mktsegment AS sign, c_nationkey % 7 AS level,
    CASE WHEN c_custkey % 11 = 0 THEN '' WHEN c_custkey % 13 = 0 THEN '2001-02-31' WHEN c_custkey % 17 = 0 THEN '1990/01/01'
      ELSE (1970 + c_nationkey) || '-06-15' END AS birthday,
    round(c_acctbal, 2) AS coins, c_custkey % 4 AS status,
    CASE WHEN c_custkey % 5 <> 0 THEN c_custkey % 3 - 1 END AS kind,
    CASE WHEN c_custkey % 5 <> 0 THEN c_mktsegment END AS official_desc,
    CASE WHEN c_custkey % 7 <> 0 THEN c_custkey % 2 = 0 ELSE false END AS privacy_show_fav,
    CASE WHEN c_custkey % 3 <> 0 THEN c_custkey % 2 = 0 ELSE true END AS push_like,
    lower(c_mktsegment) AS theme, 1600000000000 + c_custkey * 3600000 AS created_ms,
    CASE c_custkey % 4 WHEN 2 THEN '[a, b]' WHEN 3 THEN '[x, y, ' || c_mktsegment || ']' ELSE '[]' END AS tags,
    CASE c_custkey % 4 WHEN 2 THEN 2 WHEN 3 THEN 2 ELSE 0 END AS tag_cnt,
    CASE c_custkey % 4 WHEN 2 THEN 'a' WHEN 3 THEN 'x, y' END AS primary_tag
  FROM customer),
acc0 AS (
  SELECT mid FROM sv WHERE dt < '{RUN_DAY}' UNION SELECT target_mid FROM sv WHERE dt < '{RUN_DAY}'
  UNION SELECT mid FROM paid WHERE past),
oldvip AS (
  SELECT s.mid, {_OLD_EXPIRE} AS expire_ms, {_OLD_TYPE} AS kind
  FROM acc0 s LEFT JOIN paid p ON p.mid = s.mid AND p.past AND p.rn = 1),
spine AS (
  SELECT mid FROM acc0 UNION SELECT mid FROM profile UNION SELECT mid FROM sv UNION SELECT target_mid FROM sv
  UNION SELECT mid FROM paid),
acc AS (
  SELECT s.mid, f.nick_name, f.sex, CASE WHEN f.mid IS NOT NULL THEN 'f.jpg' END AS face_url, f.sign, f.level, f.birthday,
    CASE WHEN regexp_full_match(f.birthday, '\\d{{4}}-\\d{{2}}-\\d{{2}}')
      THEN CAST(floor(date_diff('day', TRY_CAST(f.birthday AS DATE), DATE '{RUN_DAY}') / 365.25) AS INT) END AS age,
    CASE WHEN regexp_full_match(f.birthday, '\\d{{4}}-\\d{{2}}-\\d{{2}}') THEN CAST(substr(f.birthday, 1, 4) AS INT) END AS birth_year,
    f.coins, {_TYPE} AS vip_type, {_EXPIRE} AS expire_ms, f.status, {status_label('f.status')} AS status_name,
    coalesce(f.kind, -1) AS official_type, f.official_desc, coalesce(f.kind >= 0, false) AS is_official,
    coalesce(f.privacy_show_fav, false) AS privacy_show_fav, false AS privacy_show_history, true AS push_comment,
    coalesce(f.push_like, true) AS push_like, true AS push_at, f.theme, coalesce(f.tags, '[]') AS tags,
    coalesce(f.tag_cnt, 0) AS tag_cnt, f.primary_tag, f.created_ms,
    CASE WHEN f.mid IS NOT NULL THEN 1704000001000 END AS updated_ms,
    date_diff('day', CAST(make_timestamp(f.created_ms * 1000) AS DATE), DATE '{RUN_DAY}') AS account_age_days,
    coalesce(r.following_list, '[]') AS following_list, coalesce(r.following_cnt, 0) AS following_cnt,
    coalesce(r.follower_list, '[]') AS follower_list, coalesce(r.follower_cnt, 0) AS follower_cnt,
    coalesce(r.mutual_follow_list, '[]') AS mutual_follow_list, coalesce(r.mutual_follow_cnt, 0) AS mutual_follow_cnt,
    coalesce(r.blocking_list, '[]') AS blocking_list, coalesce(r.blocking_cnt, 0) AS blocking_cnt,
    coalesce(r.blocked_by_list, '[]') AS blocked_by_list, coalesce(r.blocked_by_cnt, 0) AS blocked_by_cnt,
    coalesce(r.following_chg, 0) AS following_chg, coalesce(r.follower_chg, 0) AS follower_chg
  FROM spine s LEFT JOIN profile f ON f.mid = s.mid LEFT JOIN rel r ON r.mid = s.mid
  LEFT JOIN oldvip o ON o.mid = s.mid LEFT JOIN paid t ON t.mid = s.mid AND NOT t.past AND t.rn = 1),
account AS (SELECT *, {vip_label('vip_type')} AS vip_type_name FROM acc),
parts AS (
  SELECT 'BV' || p_partkey AS bvid, p_partkey AS pk, p_name, p_type AS desc_text, p_size * 10 AS duration,
    1690000000000 + p_partkey * 1000 AS pubdate, p_size AS mid, p_brand AS category_name,
    p_partkey % 2 = 0 AS is_private, p_partkey % 3 = 0 AS again
  FROM part),
vtotals AS (
  SELECT bvid, sum(view_count) AS view_count, sum(danmaku_count) AS danmaku_count,
    sum(net_favorite_delta) AS favorite_count, sum(coin_total_delta) AS coin_count, sum(share_count) AS share_count,
    sum(net_like_delta) AS like_count, bool_or(dt = '{RUN_DAY}') AS today, bool_or(dt < '{RUN_DAY}') AS past
  FROM vstats GROUP BY bvid),
rtotals AS (
  SELECT bvid, sum(CASE WHEN dt < '{RUN_DAY}' THEN reply_delta ELSE 0 END) AS past_replies,
    sum(CASE WHEN dt = '{RUN_DAY}' THEN reply_delta ELSE 0 END) AS today_replies,
    bool_or(dt = '{RUN_DAY}') AS today, bool_or(dt < '{RUN_DAY}') AS past
  FROM replies GROUP BY bvid),
vid0 AS (
  SELECT coalesce(p.bvid, t.bvid) AS bvid, p.*  EXCLUDE (bvid), t.* EXCLUDE (bvid, today, past),
    coalesce(t.today, false) AS stats_today, coalesce(t.past, false) AS stats_past, p.bvid IS NOT NULL AS known
  FROM parts p FULL JOIN vtotals t ON p.bvid = t.bvid),
vid1 AS (
  SELECT v.*, coalesce(r.past, false) AS reply_past, coalesce(r.today, false) AS reply_today,
    coalesce(r.past_replies, 0) AS past_replies, coalesce(r.today_replies, 0) AS today_replies,
    (known AND pk % 2 = 0) OR stats_past AS in_old
  FROM vid0 v LEFT JOIN rtotals r ON r.bvid = v.bvid),
vid2 AS (
  SELECT *, in_old AND (stats_past OR reply_past) AS touched_old, stats_today OR reply_today AS touched,
    CASE WHEN known AND again THEN 1706600000000 WHEN known AND pk % 2 = 1 THEN 1704000000000 + pk END AS new_at
  FROM vid1),
vid3 AS (
  SELECT *, CASE WHEN touched_old THEN {OLD_RUN_MS} WHEN known AND pk % 2 = 0 THEN 1704000000000 + pk END AS old_at FROM vid2),
vid4 AS (
  SELECT *, new_at IS NOT NULL AND (NOT in_old OR old_at IS NULL OR new_at >= old_at) AS take_new FROM vid3),
video AS (
  SELECT bvid, CASE WHEN has_attr THEN p_name || (CASE WHEN take_new AND again THEN ' v1' ELSE ' v0' END) END AS title,
    CASE WHEN has_attr THEN desc_text END AS desc_text, CASE WHEN has_attr THEN duration END AS duration,
    CASE WHEN has_attr THEN pubdate END AS pubdate, CASE WHEN has_attr THEN mid END AS mid,
    CASE WHEN has_attr THEN mid END AS category_id, CASE WHEN has_attr THEN category_name END AS category_name,
    CASE WHEN has_attr THEN is_private END AS is_private, CASE WHEN has_attr THEN {day_text('pubdate')} END AS pub_date,
    coalesce(view_count, 0) AS view_count, coalesce(danmaku_count, 0) AS danmaku_count,
    (CASE WHEN in_old THEN past_replies ELSE 0 END) + today_replies AS reply_count,
    coalesce(favorite_count, 0) AS favorite_count, coalesce(coin_count, 0) AS coin_count,
    coalesce(share_count, 0) AS share_count, coalesce(like_count, 0) AS like_count,
    CASE WHEN touched THEN {RUN_MS} WHEN take_new THEN new_at ELSE old_at END AS updated_at,
    CASE WHEN touched THEN '{RUN_DAY}' WHEN take_new THEN {day_text('new_at')} WHEN touched_old THEN '{DAY_BEFORE}'
      ELSE {day_text('old_at')} END AS updated_date
  FROM (SELECT *, known AND (take_new OR pk % 2 = 0) AS has_attr FROM vid4)
  WHERE in_old OR new_at IS NOT NULL OR stats_today),
centity AS (
  SELECT rkey AS rpid, 'BV' || k AS oid, uid AS mid, CASE WHEN i % 2 = 0 THEN 0 ELSE rkey + 1 END AS root,
    'c' || i AS content, ms - 1000 AS created_at, ms AS updated_at, dt,
    row_number() OVER (PARTITION BY rkey, k, dt < '{RUN_DAY}' ORDER BY ms DESC, i DESC) AS rn
  FROM m WHERE {when(pick(COMMENT_EVENTS, 'i'), ('comment_create', 'comment_update'))}),
ckeys AS (SELECT rpid, oid FROM centity UNION SELECT rpid, oid FROM cstats),
ctotals AS (
  SELECT rpid, oid, sum(net_like_delta) AS like_count, sum(net_dislike_delta) AS dislike_count,
    sum(reply_count_delta) AS reply_count, bool_or(dt = '{RUN_DAY}') AS today, bool_or(dt < '{RUN_DAY}') AS past
  FROM cstats GROUP BY rpid, oid),
com1 AS (
  SELECT k.rpid, k.oid, o.mid AS o_mid, n.mid AS n_mid, o.root AS o_root, n.root AS n_root, o.content AS o_content,
    n.content AS n_content, o.created_at AS o_created, n.created_at AS n_created,
    CASE WHEN t.past THEN {OLD_RUN_MS} ELSE o.updated_at END AS old_at, n.updated_at AS new_at,
    o.rpid IS NOT NULL OR coalesce(t.past, false) AS in_old, o.updated_at AS o_updated, coalesce(t.past, false) AS past,
    coalesce(t.today, false) AS today, coalesce(t.like_count, 0) AS like_count,
    coalesce(t.dislike_count, 0) AS dislike_count, coalesce(t.reply_count, 0) AS reply_count
  FROM ckeys k LEFT JOIN ctotals t USING (rpid, oid)
  LEFT JOIN centity o ON o.rpid = k.rpid AND o.oid = k.oid AND o.dt < '{RUN_DAY}' AND o.rn = 1
  LEFT JOIN centity n ON n.rpid = k.rpid AND n.oid = k.oid AND n.dt = '{RUN_DAY}' AND n.rn = 1),
com2 AS (
  SELECT *, new_at IS NOT NULL AND (NOT in_old OR old_at IS NULL OR new_at >= old_at) AS take_new FROM com1),
comment AS (
  SELECT rpid, oid, CASE WHEN take_new THEN n_mid ELSE o_mid END AS mid,
    CASE WHEN take_new THEN n_root ELSE o_root END AS root,
    CASE WHEN take_new THEN n_content ELSE o_content END AS content,
    CASE WHEN take_new THEN n_created ELSE o_created END AS created_at, like_count, dislike_count, reply_count,
    CASE WHEN today THEN {RUN_MS} WHEN take_new THEN new_at ELSE old_at END AS updated_at,
    CASE WHEN today THEN '{RUN_DAY}' WHEN take_new THEN {day_text('new_at')} WHEN past THEN '{DAY_BEFORE}'
      ELSE {day_text('o_updated')} END AS updated_date
  FROM com2),
uploader AS (
  SELECT s.dt, v.mid, count(DISTINCT s.bvid) AS video_cnt, sum(s.view_count) AS total_view_count,
    sum(s.view_user_count) AS total_view_user_count, sum(s.total_play_duration_sec) AS total_play_duration_sec,
    CAST(trunc(sum(s.total_play_duration_sec) / nullif(sum(s.view_user_count), 0)) AS BIGINT) AS avg_play_duration_sec,
    sum(s.like_count_delta) AS total_like_delta, sum(s.unlike_count_delta) AS total_unlike_delta,
    sum(s.net_like_delta) AS total_net_like_delta, sum(s.coin_count_delta) AS total_coin_count_delta,
    sum(s.coin_total_delta) AS total_coin_total_delta, sum(s.favorite_count_delta) AS total_favorite_delta,
    sum(s.unfavorite_count_delta) AS total_unfavorite_delta, sum(s.net_favorite_delta) AS total_net_favorite_delta,
    sum(s.share_count) AS total_share_count, sum(s.danmaku_count) AS total_danmaku_count,
    sum(s.triple_count) AS total_triple_count
  FROM vstats s JOIN video v ON v.bvid = s.bvid GROUP BY s.dt, v.mid)
"""
UPLOADER_TOTALS = (
    "video_cnt total_view_count total_view_user_count total_play_duration_sec avg_play_duration_sec "
    "total_like_delta total_unlike_delta total_net_like_delta total_coin_count_delta total_coin_total_delta "
    "total_favorite_delta total_unfavorite_delta total_net_favorite_delta total_share_count "
    "total_danmaku_count total_triple_count"
)
UPLOADER_INTS = "level vip_type official_type follower_cnt following_cnt"
UPLOADER_PLAIN = "nick_name sex vip_type_name official_desc is_official"
REGISTRY = (
    "sex level age birth_year vip_type vip_type_name status status_name official_type is_official theme primary_tag"
)
BUYER = "sex age birth_year level official_type is_official primary_tag account_age_days follower_cnt"
ORDER_DIMS = (
    "order_status plan_id plan_name plan_duration_days pay_method platform channel from_page current_vip_type "
    "coupon_id error_code cancel_stage"
)
ORDER_SOURCE = f"""SELECT o.dt, {cols(ORDER_DIMS, 'o.')}, {cols(BUYER, 'a.')}, count(*) AS order_cnt,
  count(o.mid) AS order_user_cnt, max(coalesce(original_price, 0)) AS original_price,
  max(coalesce(final_price, 0)) AS final_price, max(coalesce(discount_amount, 0)) AS discount_amount,
  max(coalesce(pay_duration_sec, 0)) AS pay_duration_sec
  FROM ords o LEFT JOIN account a ON a.mid = o.mid GROUP BY ALL"""
