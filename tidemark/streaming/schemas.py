"""Message schemas of the streams: just the fields the live jobs use."""

from __future__ import annotations

# Message fields and types.
VIDEO_EVENT = (
    "event_id string, mid bigint, bvid string, server_ts bigint, "
    "properties struct<coin_count:int, progress_sec:int, from:string>"
)
COMMENT_EVENT = (
    "event_id string, mid bigint, oid string, rpid bigint, server_ts bigint, "
    "properties struct<otype:int, root_rpid:bigint, parent_rpid:bigint, content:string, "
    "content_length:int>"
)
VIP_EVENT = (
    "event_id string, mid bigint, server_ts bigint, order_no string, "
    "app_context struct<app_version:string, channel:string, platform:string>, "
    "properties struct<plan_id:string, plan_name:string, original_price:bigint, final_price:bigint, "
    "discount_amount:bigint, coupon_id:string, pay_method:string, pay_duration_sec:int, "
    "new_vip_expire:bigint, error_code:string, error_msg:string, cancel_stage:string, "
    "current_vip_type:int>"
)
ACCOUNT_EVENT = (
    "event_id string, mid bigint, server_ts bigint, "
    "device_info struct<device_id:string, brand:string, os:string, network:string>, "
    "app_context struct<app_version:string, channel:string, platform:string>, "
    "properties struct<source_page:string, register_type:string, invite_code:string, channel:string>"
)
PROFILE = (
    "mid bigint, nick_name string, sex string, face_url string, sign string, level int, "
    "birthday string, coins decimal(12,2), vip_type int, "
    "official_verify struct<type:int, desc:string>, "
    "settings struct<privacy:struct<show_fav:boolean, show_history:boolean>, "
    "push:struct<comment:boolean, like:boolean, at:boolean>, theme:string>, "
    "tags array<string>, status int, created_at bigint, updated_at bigint"
)
VIDEO_CONTENT = (
    "bvid string, title string, cover string, desc_text string, duration int, pubdate bigint, "
    "mid bigint, category_id int, category_name string, state int, attribute int, is_private boolean, "
    "meta_info struct<upload_ip:string, camera:string, software:string, resolution:string, fps:int>, "
    "stats struct<view:bigint, danmaku:int, reply:int, favorite:int, coin:int, share:int, like:int>, "
    "audit_info string, created_at bigint, updated_at bigint"
)
COMMENT = (
    "rpid bigint, oid string, otype int, mid bigint, root bigint, parent bigint, content string, "
    "state int, created_at bigint, updated_at bigint"
)
