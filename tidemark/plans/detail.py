"""Detail tables: typed event rows per day, and the day's orders.

Every job takes raw rows of one day or of many and carries ``dt``, so a backfill of a month is
one job, not thirty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.casts import as_whole, digits_ms_to_timestamp, ms_to_text, ms_to_timestamp
from tidemark.functions.json_paths import JsonField, extract_json, json_fields
from tidemark.operators.orders import accumulate_order
from tidemark.operators.rows import quality_flags, require
from tidemark.sources.raw import scan_raw
from tidemark.sources.tables import days_back

# Message fields and their types (name, type, path when it differs).
HEAD_FIELDS = """
event_id string
trace_id string
session_id string
mid bigint
"""
PAGE_FIELDS = """
url_path string
referer string
ua string
ip string
"""
DEVICE_FIELDS = """
device_id string device_info.device_id
brand string device_info.brand
model string device_info.model
os string device_info.os
os_version string device_info.os_version
network string device_info.network
"""
SCREEN_FIELDS = """
screen_width int device_info.screen_width
screen_height int device_info.screen_height
carrier string device_info.carrier
"""
APP_FIELDS = """
app_version string app_context.app_version
channel string app_context.channel
platform string app_context.platform
"""
RAW_FIELDS = """
properties string
device_info string
app_context string
"""
SOCIAL_FIELDS = """
target_mid bigint
action_from string properties.from
target_level int properties.target_level
target_follower_cnt bigint properties.target_follower_count
is_mutual flag properties.is_mutual
special_group string properties.special_group
follow_duration_days int properties.follow_duration_days
unfollow_reason string properties.unfollow_reason
block_reason string properties.block_reason
is_following flag properties.is_following
msg_type string properties.msg_type
msg_length int properties.msg_length
is_first_msg flag properties.is_first_msg
report_reason string properties.report_reason
report_evidence string properties.report_evidence
"""
VIDEO_FIELDS = """
bvid string
view_from string properties.from
spm_id string properties.spm_id
is_auto_play boolean properties.is_auto_play
quality string properties.quality
progress_sec int properties.progress_sec
total_sec int properties.total_sec
play_speed double properties.play_speed
is_full_screen boolean properties.is_full_screen
upload_id string properties.upload_id
file_size_mb int properties.file_size_mb
duration_sec int properties.duration_sec
resolution string properties.resolution
upload_type string properties.upload_type
progress_percent int properties.progress_percent
uploaded_mb int properties.uploaded_mb
speed_kbps int properties.speed_kbps
upload_duration_sec int properties.upload_duration_sec
title string properties.title
category string properties.category
error_code string properties.error_code
error_msg string properties.error_msg
retry_count int properties.retry_count
updated_fields string properties.updated_fields
delete_reason string properties.delete_reason
video_age_days int properties.video_age_days
action_from string properties.from
is_liked_before boolean properties.is_liked_before
coin_count int properties.coin_count
with_like boolean properties.with_like
remain_coins int properties.remain_coins
fav_folder_ids string properties.fav_folder_ids
create_new_folder boolean properties.create_new_folder
share_channel string properties.share_channel
share_result string properties.share_result
danmaku_content string properties.content
danmaku_progress_sec int properties.progress_sec
danmaku_type string properties.danmaku_type
danmaku_color string properties.color
"""
COMMENT_FIELDS = """
oid string
rpid bigint
otype int properties.otype
content string properties.content
content_length int properties.content_length
has_emoji boolean properties.has_emoji
has_at boolean properties.has_at
from_page string properties.from
root_rpid bigint properties.root_rpid
parent_rpid bigint properties.parent_rpid
reply_to_mid bigint properties.reply_to_mid
is_root_comment boolean properties.is_root_comment
comment_owner_mid bigint properties.comment_owner_mid
old_content string properties.old_content
new_content string properties.new_content
edit_reason string properties.edit_reason
delete_reason string properties.delete_reason
comment_age_hours int properties.comment_age_hours
report_reason string properties.report_reason
report_content_preview string properties.report_content_preview
"""
VIP_FIELDS = """
order_no string
current_vip_type int properties.current_vip_type
current_vip_expire_ts bigint properties.current_vip_expire
plan_id string properties.plan_id
plan_name string properties.plan_name
plan_duration_days int properties.plan_duration_days
original_price bigint properties.original_price
final_price bigint properties.final_price
discount_amount bigint properties.discount_amount
coupon_id string properties.coupon_id
pay_method string properties.pay_method
pay_duration_sec int properties.pay_duration_sec
new_vip_expire_ts bigint properties.new_vip_expire
error_code string properties.error_code
error_msg string properties.error_msg
retry_count int properties.retry_count
cancel_stage string properties.cancel_stage
device_id string device_info.device_id
ip string
from_page string properties.from
"""
CLOCK_FIELDS = """
client_ts bigint
server_ts_text string server_ts
"""
REQUIRED_EVENT_FIELDS = ("event_id", "mid", "server_ts")


def _wanted(text: str, columns: list[str] | None, always: tuple[str, ...] = ()) -> list[JsonField]:
    fields = json_fields(text)
    if columns is None:
        return fields
    return [field for field in fields if field.name in columns or field.name in always]


def _event_clock(df: DataFrame) -> DataFrame:
    """server_ts as a number, and its time, day and hour in the session time zone."""
    return df.withColumn("server_ts", as_whole("server_ts_text")).withColumns(
        {
            "event_time": ms_to_timestamp("server_ts"),
            "event_date": ms_to_text("server_ts", "yyyy-MM-dd"),
            "event_hour": ms_to_text("server_ts", "HH"),
        }
    )


def account_actions(
    raw: DataFrame, dt: str | list[str] | None = None, columns: list[str] | None = None
) -> DataFrame:
    """Social events, one row each; rows without event or account id are dropped. ``columns`` narrows what is
    parsed, beside the event and its time."""
    text = HEAD_FIELDS + CLOCK_FIELDS + PAGE_FIELDS + DEVICE_FIELDS + APP_FIELDS + SOCIAL_FIELDS
    # The id test is on the field's presence, so an account id that is no number stays, as null.
    wanted = _wanted(text, columns, ("event_id", "server_ts_text"))
    fields = [*wanted, JsonField("mid_present", "string", ("mid",))]
    rows = extract_json(scan_raw(raw, "app_event_social", dt), fields, carry=("dt",))
    timed = require(rows, not_null=("event_id", "mid_present")).withColumns(
        {
            "server_ts": as_whole("server_ts_text"),
            "event_time": digits_ms_to_timestamp("server_ts_text"),
        }
    )
    return timed.drop("server_ts_text", "mid_present", "ua")


def comment_actions(
    raw: DataFrame, dt: str | list[str] | None = None, columns: list[str] | None = None
) -> DataFrame:
    """Comment events, one row each. ``columns`` narrows what is parsed."""
    text = (
        HEAD_FIELDS + CLOCK_FIELDS + PAGE_FIELDS + DEVICE_FIELDS + SCREEN_FIELDS + APP_FIELDS
        + COMMENT_FIELDS + RAW_FIELDS
    )
    fields = _wanted(text, columns)
    rows = extract_json(scan_raw(raw, "app_event_comment", dt), fields, carry=("dt",))
    return rows if columns is not None else _event_clock(rows).drop("server_ts_text")


def video_actions(
    raw: DataFrame, dt: str | list[str] | None = None, columns: list[str] | None = None
) -> DataFrame:
    """Video events, one row each, with quality flags; no row is dropped. ``columns`` narrows
    what is parsed and leaves the flags out."""
    text = (
        HEAD_FIELDS + CLOCK_FIELDS + PAGE_FIELDS + DEVICE_FIELDS + SCREEN_FIELDS + APP_FIELDS
        + VIDEO_FIELDS + RAW_FIELDS
    )
    if columns is not None:
        fields = _wanted(text, columns)
        return extract_json(scan_raw(raw, "app_event_video", dt), fields, carry=("dt",))
    # The flags look at presence, not at whether the value is a number.
    presence = [JsonField(f"{name}_present", "string", (name,)) for name in ("mid", "server_ts")]
    fields = json_fields(text) + presence
    rows = extract_json(scan_raw(raw, "app_event_video", dt), fields, carry=("dt",))
    seen = rows.withColumnsRenamed({"mid": "_mid", "mid_present": "mid", "server_ts_present": "server_ts"})
    flagged = quality_flags(seen, REQUIRED_EVENT_FIELDS)
    return _event_clock(flagged.drop("mid", "server_ts").withColumnRenamed("_mid", "mid")).drop("server_ts_text")


def vip_orders(
    raw: DataFrame,
    dt: str | list[str] | None = None,
    lookback_days: int = 0,
    newest: bool = False,
    columns: list[str] | None = None,
) -> DataFrame:
    """One row per order and day, out of that day's order events. ``columns`` narrows what is parsed of the
    events, beside order, account, event and time.

    With ``lookback_days`` (for one ``dt``) an order that has an event on the day is completed by
    its events of the days before, so a payment after midnight finds its order.
    """
    days = dt
    if lookback_days:
        if not isinstance(dt, str):
            raise ValueError("lookback_days needs a single dt")
        days = days_back(dt, lookback_days)
    text = HEAD_FIELDS + CLOCK_FIELDS + APP_FIELDS + VIP_FIELDS
    fields = _wanted(text, columns, ("event_id", "mid", "order_no", "server_ts_text"))
    rows = extract_json(scan_raw(raw, "app_event_vip", days), fields, carry=("dt",))
    events = require(rows, not_blank=("order_no",)).withColumn("server_ts", as_whole("server_ts_text"))
    if not lookback_days:
        return accumulate_order(events, ["dt", "order_no"], newest)
    # Orders without an event on the day are dropped after the fold, which combines map-side;
    # a semi join on the order would bring all events of a hot order into one task first.
    seen = F.bool_or(F.col("dt") == dt).alias("seen_today")
    folded = accumulate_order(events, ["order_no"], newest, (seen,))
    return folded.where("seen_today").drop("seen_today").withColumn("dt", F.lit(dt))
