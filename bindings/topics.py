"""The driver's tables seen as the source topics.

Every row of ``events`` becomes one message of each event topic, ``customer`` gives the profile
messages, ``part`` the video messages and ``events`` again the comment messages. Messages are JSON
text, so the jobs parse them as they would parse landed data. Ids and times are left out or
spoiled on some rows (by remainders of the event id) to cover the reference's edge cases; no row
is left out.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import spread

RUN_DAY = "2024-01-30"
DAY_BEFORE = "2024-01-29"
RUN_TS_TEXT = "2024-01-31 02:00:00"
OLD_RUN_TS_TEXT = "2024-01-30 02:00:00"

VIDEO_EVENTS = (
    "video_view", "video_play_heartbeat", "video_like", "video_unlike", "video_coin", "video_favorite",
    "video_unfavorite", "video_share", "video_danmaku", "video_triple", "video_view", "video_publish",
)
SOCIAL_EVENTS = (
    "social_follow", "social_unfollow", "social_block", "social_unblock", "social_whisper",
    "social_follow", "social_report_user", "social_follow",
)
COMMENT_EVENTS = (
    "comment_create", "comment_reply", "comment_like", "comment_unlike", "comment_dislike",
    "comment_undislike", "comment_report", "comment_update", "comment_like",
)
VIP_EVENTS = (
    "vip_page_view", "vip_create_order", "vip_pay_start", "vip_pay_success", "vip_pay_fail",
    "vip_pay_cancel", "vip_create_order", "vip_pay_success",
)
ACCOUNT_EVENTS = ("account_register", "account_login", "account_register", "account_logout")


def run_ts() -> Column:
    return F.lit(RUN_TS_TEXT).cast("timestamp")


def old_run_ts() -> Column:
    return F.lit(OLD_RUN_TS_TEXT).cast("timestamp")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(values: tuple, by: str) -> str:
    texts = ", ".join("NULL" if v is None else f"'{v}'" for v in values)
    return f"get(array({texts}), CAST({by} % {len(values)} AS INT))"


def unless(broken: str, value: str) -> str:
    return f"CASE WHEN NOT ({broken}) THEN {value} END"


def struct(**columns: str) -> str:
    return "named_struct(" + ", ".join(f"'{name}', {value}" for name, value in columns.items()) + ")"


def shape_events(events: DataFrame) -> DataFrame:
    """Columns the messages are made of: i, uid, k, ms, dt, amount, event_type."""
    return events.selectExpr(
        "event_id AS i",
        "user_id AS uid",
        "CAST(get_json_object(props, '$.k') AS BIGINT) AS k",
        "unix_millis(CAST(ts AS TIMESTAMP)) AS ms",
        "date_format(ts, 'yyyy-MM-dd') AS dt",
        "CAST(floor(value) AS BIGINT) AS amount",
        "event_type",
    )


def events_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape_events(table(spark, sf_dir, "events"))


ROUNDS = 4
# Rounds of ten days; rows that are late come a round later.
ROUND = (
    "least(3, CASE WHEN dt < '2024-01-11' THEN 0 WHEN dt < '2024-01-21' THEN 1 ELSE 2 END"
    " + CASE WHEN i % 13 = 0 THEN 1 ELSE 0 END)"
)


def in_rounds(events: DataFrame) -> DataFrame:
    """Events with the ``round`` in which they are fed to a stream."""
    return events.selectExpr("*", f"{ROUND} AS round")


DEVICE = struct(
    device_id="concat('d', uid % 40)",
    brand=pick(("Apple", "Xiaomi", "Huawei"), "uid"),
    model="'m1'",
    os=pick(("iOS", "Android"), "uid"),
    os_version="'17.1'",
    screen_width="1080",
    screen_height="k + 2000",
    carrier="'cmcc'",
    network=pick(("WIFI", "5G"), "k"),
)
APP = struct(
    app_version="concat('7.', k % 5)",
    channel=unless("uid % 4 = 0", pick(("store", "web"), "uid")),
    platform=pick(("ios", "android", "web"), "uid"),
)
BVID = "concat('BV', k)"
RPID = "(uid * 1000 + k)"
# An order per account and two days, so that orders also run over midnight.
ORDER_NO = "concat('V', uid, '-', ms div 172800000)"


def _message(names: tuple, server_ts: str, properties: str, **extra: str) -> str:
    body = struct(
        event_id=unless("i % 83 = 0", pick(names, "i")),
        trace_id="concat('t', i)",
        session_id="concat('s', uid)",
        mid=unless("i % 97 = 0", "uid"),
        client_ts="ms - 300",
        server_ts=server_ts,
        url_path="'/p'",
        referer="event_type",
        ua="'ua'",
        ip="concat('10.0.0.', uid % 250)",
        device_info=DEVICE,
        app_context=APP,
        **extra,
        properties=properties,
    )
    return f"to_json({body}) AS json_str"


def _landed(
    rows: DataFrame, message: str, topic: str, dt: str = "dt", ms: str = "ms", carry: tuple[str, ...] = ()
) -> DataFrame:
    return rows.selectExpr(message, f"{dt} AS dt", f"'{topic}' AS topic", f"{ms} AS ms", *carry)


def video_messages(events: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    properties = struct(**{
        "from": "event_type",
        "coin_count": unless("k % 3 = 0", "k % 3"),
        "progress_sec": "k",
        "play_speed": "CAST(1.5 AS DOUBLE)",
        "is_auto_play": "k % 2 = 0",
        "fav_folder_ids": "array(k, uid)",
        "content": "concat('c', k)",
    })
    message = _message(
        VIDEO_EVENTS, unless("i % 89 = 0", "ms"), properties, bvid=unless("i % 71 = 0", BVID)
    )
    return _landed(events, message, "app_event_video", carry=carry)


def social_messages(events: DataFrame) -> DataFrame:
    properties = struct(**{
        "from": "event_type",
        "target_level": "k % 7",
        "is_mutual": pick(("TRUE", "False", "maybe"), "k"),
        "target_follower_count": "k * 10",
    })
    server_ts = "CASE WHEN i % 89 = 0 THEN 'bad-ts' ELSE CAST(ms AS STRING) END"
    return _landed(events, _message(SOCIAL_EVENTS, server_ts, properties, target_mid="k"), "app_event_social")


def comment_messages(events: DataFrame) -> DataFrame:
    properties = struct(
        otype="1",
        content="concat('c', i)",
        content_length="k + 1",
        has_emoji="k % 2 = 0",
        root_rpid=unless("i % 2 = 1", RPID),
        parent_rpid=unless("k % 10 = 0", f"{RPID} + 1"),
    )
    message = _message(COMMENT_EVENTS, "ms", properties, oid=BVID, rpid=unless("i % 79 = 0", RPID))
    return _landed(events, message, "app_event_comment")


def vip_messages(events: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    events = events.selectExpr(
        "*", f"{pick(VIP_EVENTS, 'i')} AS step", "get(array(31, 30, 366, 93), CAST(k % 4 AS INT)) AS days"
    )
    properties = struct(**{
        "current_vip_type": "k % 3",
        "plan_id": pick(("monthly", "auto_monthly", "yearly", None), "k"),
        "plan_name": pick(("m", "am", "y", "q"), "k"),
        "plan_duration_days": "days",
        "original_price": "amount * 100",
        "final_price": "amount * 100 - k",
        "discount_amount": "k",
        "coupon_id": unless("k % 2 = 0", "concat('CPN', k % 5)"),
        "pay_method": f"CASE WHEN step IN ('vip_pay_start', 'vip_pay_success') THEN {pick(('alipay', 'wechat'), 'k')} END",
        "pay_duration_sec": "CASE WHEN step = 'vip_pay_success' THEN k END",
        "new_vip_expire": (
            "CASE WHEN step = 'vip_pay_success' AND k % 11 <> 0 "
            "THEN ms + CAST(days AS BIGINT) * 86400000 - 60 * CAST(86400000 AS BIGINT) END"
        ),
        "error_code": "CASE WHEN step = 'vip_pay_fail' THEN concat('E', k % 4) END",
        "error_msg": "CASE WHEN step = 'vip_pay_fail' THEN 'failed' END",
        "retry_count": "CASE WHEN step = 'vip_pay_fail' THEN k % 3 END",
        "cancel_stage": "CASE WHEN step = 'vip_pay_cancel' THEN 'pay_page' END",
        "from": "event_type",
    })
    number = f"CASE WHEN step = 'vip_page_view' THEN '' WHEN i % 101 <> 0 THEN {ORDER_NO} END"
    return _landed(events, _message(VIP_EVENTS, "ms", properties, order_no=number), "app_event_vip", carry=carry)


def account_messages(events: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    properties = struct(
        source_page=pick(("login", "share", None), "k"),
        register_type=pick(("phone", "email"), "k"),
        channel=unless("k % 3 = 0", pick(("ads", "friend"), "k")),
    )
    return _landed(events, _message(ACCOUNT_EVENTS, "ms", properties), "app_event_account", carry=carry)


def profile_messages(customer: DataFrame) -> DataFrame:
    """Two messages per account on the run day; for every fifth account the first one is newer."""
    rows = customer.selectExpr("*", "explode(array(0, 1)) AS rev")
    body = struct(
        mid="c_custkey",
        nick_name="concat(c_name, '#', rev)",
        sex=pick(("男", "女", "保密"), "c_custkey"),
        face_url="'f.jpg'",
        sign="c_mktsegment",
        level="c_nationkey % 7",
        birthday=(
            "CASE WHEN c_custkey % 11 = 0 THEN '' WHEN c_custkey % 13 = 0 THEN '2001-02-31' "
            "WHEN c_custkey % 17 = 0 THEN '1990/01/01' ELSE concat(1970 + c_nationkey, '-06-15') END"
        ),
        coins="c_acctbal",
        status="c_custkey % 4",
        official_verify=unless("c_custkey % 5 = 0", struct(type="c_custkey % 3 - 1", desc="c_mktsegment")),
        settings=struct(
            privacy=struct(show_fav=unless("c_custkey % 7 = 0", "c_custkey % 2 = 0")),
            push=struct(like=unless("c_custkey % 3 = 0", "c_custkey % 2 = 0")),
            theme="lower(c_mktsegment)",
        ),
        tags=(
            "CASE c_custkey % 4 WHEN 1 THEN CAST(array() AS ARRAY<STRING>) WHEN 2 THEN array('a', 'b') "
            "WHEN 3 THEN array('x, y', c_mktsegment) END"
        ),
        created_at="1600000000000 + c_custkey * 3600000",
        updated_at="1704000000000 + 1000 * CASE WHEN c_custkey % 5 = 0 THEN 1 - rev ELSE rev END",
    )
    return _landed(rows, f"to_json({body}) AS json_str", "app_user_profile", f"'{RUN_DAY}'", "1706580000000")


def content_messages(part: DataFrame) -> DataFrame:
    """A message per video the day before (even keys) or on the run day (odd keys), and a second
    version on the run day for every third."""
    rows = part.selectExpr("*", "explode(CASE WHEN p_partkey % 3 = 0 THEN array(0, 1) ELSE array(0) END) AS rev")
    body = struct(
        bvid="concat('BV', p_partkey)",
        title="concat(p_name, ' v', rev)",
        desc_text="p_type",
        duration="p_size * 10",
        pubdate="1690000000000 + p_partkey * 1000",
        mid="p_size",
        category_id="p_size",
        category_name="p_brand",
        state="0",
        attribute="0",
        is_private="p_partkey % 2 = 0",
        meta_info=struct(upload_ip="'1.2.3.4'", fps="p_size"),
        stats=struct(view="p_partkey"),
        created_at="1690000000000 + p_partkey * 1000",
        updated_at="CASE WHEN rev = 1 THEN 1706600000000 ELSE 1704000000000 + p_partkey END",
    )
    day = f"CASE WHEN rev = 1 OR p_partkey % 2 = 1 THEN '{RUN_DAY}' ELSE '{DAY_BEFORE}' END"
    return _landed(rows, f"to_json({body}) AS json_str", "app_video_content", day, "1706580000000")


def comment_entity_messages(events: DataFrame) -> DataFrame:
    """A message per event of creating or updating a comment."""
    rows = events.where(f"{pick(COMMENT_EVENTS, 'i')} IN ('comment_create', 'comment_update')")
    above = f"CASE WHEN i % 2 = 0 THEN 0 ELSE {RPID} + 1 END"
    body = struct(
        rpid=RPID,
        oid=BVID,
        otype="1",
        mid="uid",
        root=above,
        parent=above,
        content="concat('c', i)",
        state="0",
        created_at="ms - 1000",
        updated_at="ms",
    )
    return _landed(rows, f"to_json({body}) AS json_str", "app_comment")


MAKERS = {
    "app_user_profile": ("customer", profile_messages),
    "app_video_content": ("part", content_messages),
    "app_comment": ("events", comment_entity_messages),
    "app_event_account": ("events", account_messages),
    "app_event_video": ("events", video_messages),
    "app_event_social": ("events", social_messages),
    "app_event_comment": ("events", comment_messages),
    "app_event_vip": ("events", vip_messages),
}


def raw_messages(spark: SparkSession, sf_dir: str, *names: str) -> DataFrame:
    """The named topics (all by default) as landed rows: json_str, dt, topic, ms."""
    branches = []
    for name in names or MAKERS:
        source, maker = MAKERS[name]
        rows = spread(table(spark, sf_dir, source))
        branches.append(maker(shape_events(rows) if source == "events" else rows))
    return reduce(DataFrame.unionByName, branches)
