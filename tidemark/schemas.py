"""Schemas of the warehouse tables, as Spark DDL; every table is partitioned by ``dt`` besides."""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Table columns and types, in table order.
_EVENT_HEAD = "event_id string, trace_id string, session_id string, mid bigint"
_EVENT_CLOCK = (
    "client_ts bigint, server_ts bigint, event_time timestamp, event_date string, event_hour string, "
    "url_path string, referer string, ua string, ip string"
)
_EVENT_DEVICE = (
    "device_id string, brand string, model string, os string, os_version string, screen_width int, "
    "screen_height int, carrier string, network string"
)
_EVENT_APP = "app_version string, platform string, channel string"
_EVENT_RAW = "properties string, device_info string, app_context string"
_UPLOADER = (
    "nick_name string, sex string, level int, vip_type int, vip_type_name string, official_type int, "
    "official_desc string, is_official boolean, follower_cnt int, following_cnt int"
)

DDL = {
    "dwd_action_account_di": (
        f"{_EVENT_HEAD}, target_mid bigint, client_ts bigint, server_ts bigint, event_time timestamp, "
        "url_path string, referer string, device_id string, brand string, model string, os string, "
        "os_version string, network string, ip string, app_version string, channel string, "
        "platform string, action_from string, target_level int, target_follower_cnt bigint, "
        "is_mutual boolean, special_group string, follow_duration_days int, unfollow_reason string, "
        "block_reason string, is_following boolean, msg_type string, msg_length int, "
        "is_first_msg boolean, report_reason string, report_evidence string"
    ),
    "dwd_action_video_di": (
        f"is_valid boolean, invalid_reason string, {_EVENT_HEAD}, bvid string, {_EVENT_CLOCK}, "
        f"{_EVENT_DEVICE}, {_EVENT_APP}, view_from string, spm_id string, is_auto_play boolean, "
        "quality string, progress_sec int, total_sec int, play_speed double, is_full_screen boolean, "
        "upload_id string, file_size_mb int, duration_sec int, resolution string, upload_type string, "
        "progress_percent int, uploaded_mb int, speed_kbps int, upload_duration_sec int, title string, "
        "category string, error_code string, error_msg string, retry_count int, updated_fields string, "
        "delete_reason string, video_age_days int, action_from string, is_liked_before boolean, "
        "coin_count int, with_like boolean, remain_coins int, fav_folder_ids string, "
        "create_new_folder boolean, share_channel string, share_result string, danmaku_content string, "
        f"danmaku_progress_sec int, danmaku_type string, danmaku_color string, {_EVENT_RAW}"
    ),
    "dwd_action_comment_di": (
        f"{_EVENT_HEAD}, oid string, rpid bigint, otype int, {_EVENT_CLOCK}, {_EVENT_DEVICE}, "
        f"{_EVENT_APP}, content string, content_length int, has_emoji boolean, has_at boolean, "
        "from_page string, root_rpid bigint, parent_rpid bigint, reply_to_mid bigint, "
        "is_root_comment boolean, comment_owner_mid bigint, old_content string, new_content string, "
        "edit_reason string, delete_reason string, comment_age_hours int, report_reason string, "
        f"report_content_preview string, {_EVENT_RAW}"
    ),
    "dwd_order_vip_di": (
        "order_no string, mid bigint, current_vip_type int, current_vip_expire_ts bigint, "
        "plan_id string, plan_name string, plan_duration_days int, original_price bigint, "
        "final_price bigint, discount_amount bigint, coupon_id string, pay_method string, "
        "pay_duration_sec int, new_vip_expire_ts bigint, order_status string, create_ts bigint, "
        "pay_start_ts bigint, pay_end_ts bigint, error_code string, error_msg string, "
        "retry_count int, cancel_stage string, device_id string, platform string, "
        "app_version string, channel string, ip string, from_page string, trace_id string, "
        "session_id string"
    ),
    "dwd_stats_video_di": (
        "bvid string, view_count int, view_user_count int, total_play_duration_sec bigint, "
        "avg_play_duration_sec int, like_count_delta int, unlike_count_delta int, "
        "net_like_delta int, coin_count_delta int, coin_total_delta int, favorite_count_delta int, "
        "unfavorite_count_delta int, net_favorite_delta int, share_count int, danmaku_count int, "
        "triple_count int"
    ),
    "dwd_stats_comment_di": (
        "rpid bigint, oid string, like_count_delta int, unlike_count_delta int, "
        "dislike_count_delta int, undislike_count_delta int, reply_count_delta int, "
        "report_count int, net_like_delta int, net_dislike_delta int"
    ),
    "dim_account_df": (
        "mid bigint, nick_name string, sex string, face_url string, sign string, level int, "
        "birthday string, age int, birth_year int, coins decimal(12,2), vip_type int, "
        "vip_type_name string, vip_expire timestamp, status int, status_name string, "
        "official_type int, official_desc string, is_official boolean, privacy_show_fav boolean, "
        "privacy_show_history boolean, push_comment boolean, push_like boolean, push_at boolean, "
        "theme string, tags array<string>, tag_cnt int, primary_tag string, created_at timestamp, "
        "updated_at timestamp, account_age_days int, following_list array<bigint>, "
        "following_cnt int, follower_list array<bigint>, follower_cnt int, "
        "mutual_follow_list array<bigint>, mutual_follow_cnt int, blocking_list array<bigint>, "
        "blocking_cnt int, blocked_by_list array<bigint>, blocked_by_cnt int, following_chg int, "
        "follower_chg int, dw_create_time timestamp"
    ),
    "dim_video_df": (
        "bvid string, title string, cover string, desc_text string, duration int, pubdate bigint, "
        "mid bigint, category_id int, category_name string, state int, attribute int, "
        "is_private boolean, upload_ip string, camera string, software string, resolution string, "
        "fps int, view_count bigint, danmaku_count int, reply_count int, favorite_count int, "
        "coin_count int, share_count int, like_count int, created_at bigint, updated_at bigint, "
        "created_date string, updated_date string, pub_date string, audit_info string, "
        "meta_info string, stats string"
    ),
    "dim_comment_df": (
        "rpid bigint, oid string, otype int, mid bigint, root bigint, parent bigint, content string, "
        "like_count int, dislike_count int, reply_count int, state int, is_root boolean, "
        "created_at bigint, updated_at bigint, created_date string, updated_date string"
    ),
    "dws_account_registry_source_di": (
        "sex string, level int, age int, birth_year int, vip_type int, vip_type_name string, "
        "status int, status_name string, official_type int, is_official boolean, theme string, "
        "primary_tag string, new_account_cnt bigint, dw_create_time timestamp"
    ),
    "dws_video_stats_account_di": (
        f"mid bigint, {_UPLOADER}, video_cnt bigint, total_view_count bigint, "
        "total_view_user_count bigint, total_play_duration_sec bigint, avg_play_duration_sec int, "
        "total_like_delta bigint, total_unlike_delta bigint, total_net_like_delta bigint, "
        "total_coin_count_delta bigint, total_coin_total_delta bigint, total_favorite_delta bigint, "
        "total_unfavorite_delta bigint, total_net_favorite_delta bigint, total_share_count bigint, "
        "total_danmaku_count bigint, total_triple_count bigint, dw_create_time timestamp"
    ),
    "dws_video_stats_account_di_v2": (
        "bvid string, title string, duration int, pubdate bigint, pub_date string, category_id int, "
        f"category_name string, mid bigint, {_UPLOADER}, view_count bigint, view_user_count bigint, "
        "total_play_duration_sec bigint, avg_play_duration_sec int, like_delta bigint, "
        "unlike_delta bigint, net_like_delta bigint, coin_count_delta bigint, "
        "coin_total_delta bigint, favorite_delta bigint, unfavorite_delta bigint, "
        "net_favorite_delta bigint, share_count bigint, danmaku_count bigint, triple_count bigint, "
        "dw_create_time timestamp"
    ),
    "dws_vip_order_source_di": (
        "order_status string, plan_id string, plan_name string, plan_duration_days int, "
        "pay_method string, platform string, channel string, from_page string, "
        "current_vip_type int, coupon_id string, error_code string, cancel_stage string, "
        "sex string, age int, birth_year int, level int, official_type int, is_official boolean, "
        "primary_tag string, account_age_days int, follower_cnt int, order_cnt bigint, "
        "order_user_cnt bigint, original_price decimal(12,2), final_price decimal(12,2), "
        "discount_amount decimal(12,2), pay_duration_sec int, dw_create_time timestamp"
    ),
    # Not in the source layout: the relation pairs behind the account snapshot's lists.
    "dim_account_relation_df": (
        "lo bigint, hi bigint, follow_fwd boolean, follow_bwd boolean, block_fwd boolean, "
        "block_bwd boolean, chg_fwd int, chg_bwd int"
    ),
    "dim_account_list_df": (
        "mid bigint, chunk int, chunks int, following_list array<bigint>, follower_list array<bigint>, "
        "mutual_follow_list array<bigint>, blocking_list array<bigint>, blocked_by_list array<bigint>"
    ),
}


@cache
def table_schema(name: str) -> T.StructType:
    """The table's columns without ``dt``; needs a running session to read the DDL."""
    return T.StructType.fromDDL(DDL[name])


def cast_to_schema(df: DataFrame, schema: T.StructType, extra: tuple[str, ...] = ()) -> DataFrame:
    """The table's columns in order and type; absent columns become typed nulls."""
    present = set(df.columns)
    body = (
        f"CAST({f'`{f.name}`' if f.name in present else 'NULL'} AS {f.dataType.simpleString()}) AS `{f.name}`"
        for f in schema.fields
    )
    return df.selectExpr(*body, *extra)
