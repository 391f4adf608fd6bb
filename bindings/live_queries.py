"""Registered queries of the live side that run over several rounds, with their SQL twins beside them."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bindings import topics
from bindings.oracle import COMMON, interactions, when
from bindings.oracle_queries import MOVING, ORACLE, _COUNTED, _UPLOADER, sql
from bindings.queries import STREAM_PARTITIONS, Book, in_rounds, plain, query
from bindings.topics import ROUND, RUN_DAY, run_ts, table
from tidemark.operators.serving import pack_families
from tidemark.plans import detail
from tidemark.plans.serving import Serving, night_version
from tidemark.session import stream_session, work_path
from tidemark.sources.changelog import upsert_versioned
from tidemark.sources.wide import WideTable
from tidemark.streaming import dims as live_dims
from tidemark.streaming import summaries as live
from tidemark.streaming.counters import DayCounters
from tidemark.streaming.lookups import ACCOUNT_COLUMNS, VIDEO_COLUMNS, read_first_described, start_enriched
from tidemark.streaming.runs import run_to_end

BUCKETS = 16


# ---- wide tables -----------------------------------------------------------------------------


@query
def wide_compaction(spark, sf_dir):
    """Two sources upsert a customer's row; compactions fall between versions that are still to come."""
    wide = WideTable(work_path(spark, "wide-orders"), buckets=BUCKETS)
    orders = table(spark, sf_dir, "orders").withColumn("rowkey", F.col("o_custkey").cast("string"))
    orders = orders.withColumn("version", F.unix_date(F.col("o_orderdate").cast("date")).cast("bigint") * 100_000_000 + F.col("o_orderkey"))
    families = {
        "price": F.struct(F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("total")).alias("price"),
        "status": F.struct(F.col("o_orderstatus").alias("code"), F.col("o_orderpriority").alias("priority")).alias("status"),
    }
    for step in range(3):
        for place, (source, family) in enumerate(families.items()):
            rows = orders.where((F.col("o_orderkey") % 3 == step) & (F.floor(F.col("o_orderkey") / 3) % 2 == place))
            wide.load(rows.select("rowkey", "version", family), source, step)
        wide.compact(spark, [*families], open_batches=step % 2)
    return plain(wide.read(spark, [*families]))


sql("wide_compaction", """WITH o AS (SELECT *, CAST(o_custkey AS VARCHAR) AS rowkey, (o_orderkey // 3) % 2 AS place,
  CAST(date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS BIGINT) * 100000000 + o_orderkey AS v FROM orders)
SELECT rowkey, max(v) AS version, CAST(CAST(arg_max(o_totalprice, v) FILTER (WHERE place = 0) AS DECIMAL(18,2)) AS VARCHAR) AS price__total,
  arg_max(o_orderstatus, v) FILTER (WHERE place = 1) AS status__code,
  arg_max(o_orderpriority, v) FILTER (WHERE place = 1) AS status__priority FROM o GROUP BY rowkey""", common=False)


@query
def entity_by_bucket(spark, sf_dir):
    """One customer's wide row out of all: one bucket is read."""
    wide = WideTable(work_path(spark, "wide-customers"), buckets=BUCKETS)
    customers = table(spark, sf_dir, "customer").withColumn("version", F.lit(1).cast("bigint"))
    families = {"basic": {"name": F.col("c_name"), "segment": F.col("c_mktsegment")}, "place": {"nation": F.col("c_nationkey")}}
    packed = pack_families(customers, F.reverse(F.col("c_custkey").cast("string")), families)
    wide.load(packed.withColumn("version", F.lit(1).cast("bigint")), "customers", 0)
    wide.compact(spark, ["customers"], open_batches=0)
    return plain(wide.entity(spark, "12"[::-1], ["customers"]))


sql("entity_by_bucket", """SELECT reverse(CAST(c_custkey AS VARCHAR)) AS rowkey, CAST(1 AS BIGINT) AS version, c_name AS basic__name,
  c_mktsegment AS basic__segment, CAST(c_nationkey AS VARCHAR) AS place__nation FROM customer WHERE c_custkey = 12""", common=False)


# ---- nightly loads over live rows ------------------------------------------------------------

LATER_MS = 2 * 86_400_000


@query
def wide_night_over_live(spark, sf_dir):
    """A night's comment rows over live ones, of which every third is newer than the night."""
    book, serving = Book(spark, sf_dir), Serving(work_path(spark, "serving"), BUCKETS)
    live_rows = live_dims.comment_attributes(book.raw("app_comment"))
    newer = F.col("info.rpid").cast("bigint") % 3 == 0
    live_rows = live_rows.withColumn("version", F.col("version") + F.when(newer, LATER_MS).otherwise(0))
    content = F.when(newer, F.concat("content.content", F.lit("!"))).otherwise(F.col("content.content"))
    live_rows = live_rows.withColumn("content", F.struct(content.alias("content")))
    wide = serving.wide("comment")
    wide.load(live_rows, "live", 0, ties=("content",))
    serving.load_wide("comment", book.comments, RUN_DAY)
    serving.compact(spark, "comment", ["live"])
    return plain(wide.read(spark, ["live", "nightly"]))


_OF_BOTH = [
    *(f"info__{n}" for n in "rpid oid otype mid root parent state".split()),
    *(f"meta__{n}" for n in "created_at updated_at created_date updated_date".split()),
]
_WINS = f"n.rowkey IS NULL OR l.version > {night_version(RUN_DAY)}"
ORACLE["wide_night_over_live"] = f"""WITH night AS ({ORACLE['serve_comment_rows']}), every AS ({ORACLE['speed_comment_columns']}),
live AS (SELECT * REPLACE (version + CASE WHEN CAST(info__rpid AS BIGINT) % 3 = 0 THEN {LATER_MS} ELSE 0 END AS version,
  content__content || CASE WHEN CAST(info__rpid AS BIGINT) % 3 = 0 THEN '!' ELSE '' END AS content__content) FROM every)
SELECT coalesce(n.rowkey, l.rowkey) AS rowkey,
  greatest(CASE WHEN n.rowkey IS NOT NULL THEN {night_version(RUN_DAY)} END, l.version) AS version,
  {', '.join(f'CASE WHEN l.rowkey IS NOT NULL AND ({_WINS}) THEN l.{c} ELSE n.{c} END AS {c}' for c in [*_OF_BOTH, 'content__content'])},
  n.stats__like_count, n.stats__dislike_count, n.stats__reply_count
FROM night n FULL JOIN live l ON n.rowkey = l.rowkey"""


@query
def serve_uploaders_reloaded(spark, sf_dir):
    """A day's summary loaded twice over live rows: the second load has fewer keys, some live rows are newer."""
    book, name = Book(spark, sf_dir), "dws_video_stats_account_di"
    path = work_path(spark, "uploaders")
    book.uploaders().write.parquet(path)
    rows = spark.read.parquet(path)
    serving = Serving(work_path(spark, "serving"), BUCKETS)

    def moved(by: int, hours: int, where: str = "true") -> DataFrame:
        return rows.where(where).withColumns(
            {"mid": F.col("mid") + by, "dw_create_time": F.col("dw_create_time") + F.expr(f"INTERVAL {hours} HOURS")}
        )

    upsert = serving.summary(name).upsert("live")
    upsert(moved(2_000_000, -1), 0)
    upsert(moved(0, 3, "mid % 10 = 0").withColumn("total_view_count", F.col("total_view_count") + 1), 1)
    serving.load_summary(name, moved(0, -2).unionByName(moved(1_000_000, -2)), RUN_DAY)
    serving.load_summary(name, rows, RUN_DAY)
    return plain(serving.summary(name).read(spark, RUN_DAY).drop("dw_create_time"))


_NIGHT = _UPLOADER.format(mid="coalesce(a.mid, 0)")
ORACLE["serve_uploaders_reloaded"] = f"""SELECT * REPLACE (total_view_count + CASE WHEN mid > 0 AND mid % 10 = 0 THEN 1 ELSE 0 END AS total_view_count)
FROM ({COMMON}{_NIGHT}) WHERE dt = '{RUN_DAY}'"""


# ---- streams in rounds -----------------------------------------------------------------------


@query
def stream_first_lookup(spark, sf_dir):
    """Totals over forty days with looked-up columns: half the videos are known at first, and all of them
    under a new title from the third round on; the first title found stays."""
    path, book = work_path(spark, "first-lookup"), Book(spark, sf_dir)
    videos, accounts = WideTable(f"{path}/videos", buckets=BUCKETS), WideTable(f"{path}/accounts", buckets=BUCKETS)
    book.video_wide.write.parquet(f"{path}/known")
    known = spark.read.parquet(f"{path}/known")
    even = F.expr("CAST(substr(reverse(rowkey), 3) AS BIGINT) % 2 = 0")
    videos.load(known.where(even), "attributes", 0)
    profiles = live_dims.account_attributes(book.raw("app_user_profile"), run_ts(), run_ts())
    unknown = F.struct(*(F.lit(None).cast("string").alias(f"{n}_cnt") for n in ("follower", "following")))
    accounts.load(profiles.withColumn("relation", unknown), "attributes", 0)
    accounts.compact(spark, ["attributes"], open_batches=0)
    summary = replace(live.VIDEO, size="40 days")
    events = topics.in_rounds(topics.events_of(spark, sf_dir))
    messages = topics.video_messages(events, ("round",)).select("json_str", "topic", "round")
    rounds = iter(range(topics.ROUNDS))

    def run() -> None:
        if next(rounds) == 2:
            videos.compact(spark, ["attributes"], open_batches=0)
            renamed = known.withColumn("content", F.col("content").withField("title", F.concat("content.title", F.lit("!"))))
            videos.load(renamed.withColumn("version", F.col("version") + 1), "attributes", 1)
        files = stream_session(spark, STREAM_PARTITIONS).readStream.schema("json_str string, topic string")
        totals = summary.totals(summary.parse(files.parquet(f"{path}/messages")), "3 days")
        run_to_end(start_enriched(
            totals, lambda keys: videos.read_for(keys, ["attributes"]), lambda keys: accounts.read_for(keys, ["attributes"]),
            upsert_versioned(f"{path}/rows", "video"), f"{path}/checkpoint",
        ))

    in_rounds(messages, f"{path}/messages", run)
    described = [*VIDEO_COLUMNS, *ACCOUNT_COLUMNS]
    made = read_first_described(spark, f"{path}/rows", ["window_start", "bvid", "mid"], described)
    return plain(made.select("bvid", "mid", "title", "duration", "nick_name", "level", *live.VIDEO_METRICS))


sql("stream_first_lookup", f""", t AS (SELECT bvid, mid, min({ROUND}) AS lo, max({ROUND}) AS hi, {interactions(True)} {_COUNTED} GROUP BY bvid, mid),
v AS ({ORACLE['speed_video_columns']}), a AS ({ORACLE['speed_account_columns']}),
d AS (SELECT t.*, v.*, lo <= 1 AND CAST(substr(t.bvid, 3) AS BIGINT) % 2 = 0 AS early FROM t LEFT JOIN v ON v.rowkey = reverse(t.bvid))
SELECT bvid, mid, CASE WHEN early THEN content__title WHEN hi >= 2 THEN content__title || '!' END AS title,
  CASE WHEN early OR hi >= 2 THEN TRY_CAST(content__duration AS BIGINT) END AS duration,
  basic__nick_name AS nick_name, TRY_CAST(basic__level AS BIGINT) AS level,
  {', '.join(f'CAST({m} AS BIGINT) AS {m}' for m in live.VIDEO_METRICS)}
FROM d LEFT JOIN a ON a.rowkey = reverse(CAST(mid AS VARCHAR))""")


COUNTERS = ("view_count", "danmaku_count", "favorite_count", "coin_count", "share_count", "like_count")
EVENING_MS, MORNING_MS = 1706551200000, 1706594400000  # 2024-01-29 18:00 and 2024-01-30 06:00 UTC


@query
def stream_counters_over_midnight(spark, sf_dir):
    """Video counters read twice: past midnight on top of the snapshot of two days before, and at the end on
    top of the one that has come since."""
    path = work_path(spark, "midnight")
    part = f"CASE WHEN ms < {EVENING_MS} THEN 0 WHEN ms < {MORNING_MS} THEN 1 ELSE 2 END AS round"
    events = topics.events_of(spark, sf_dir).selectExpr("*", part)
    messages = topics.video_messages(events, ("round",)).select("json_str", "topic", "ms", "round")
    counters = DayCounters(f"{path}/days", ["bvid"], list(COUNTERS))

    def arrived(rows: DataFrame) -> DataFrame:
        return live_dims.video_counters(rows.withColumn("arrival", F.timestamp_millis("ms")))

    arrived(messages).write.parquet(f"{path}/batch")
    rounds, done = iter(("", "2024-01-28", "2024-01-29")), []

    def run() -> None:
        files = stream_session(spark, STREAM_PARTITIONS).readStream.schema("json_str string, topic string, ms bigint")
        run_to_end(counters.start(arrived(files.parquet(f"{path}/messages")), f"{path}/checkpoint", trigger=None))
        if day := next(rounds):
            past = spark.read.parquet(f"{path}/batch").where(F.date_format("window.start", "yyyy-MM-dd") <= day)
            snapshot = past.groupBy("bvid").agg(*(F.sum(n).alias(n) for n in COUNTERS))
            counters.current(snapshot, day).withColumn("after", F.lit(day)).write.parquet(f"{path}/seen/{len(done)}")
            done.append(day)

    in_rounds(messages, f"{path}/messages", run, 3)
    return plain(spark.read.parquet(*(f"{path}/seen/{n}" for n in range(len(done)))))


def _counters_at(day: str, until: int) -> str:
    return f"""SELECT '{day}' AS after, bvid, CAST(view_count AS BIGINT) AS view_count, CAST(danmaku_count AS BIGINT) AS danmaku_count,
  CAST(net_favorite_delta AS BIGINT) AS favorite_count, CAST(coin_total_delta AS BIGINT) AS coin_count,
  CAST(share_count AS BIGINT) AS share_count, CAST(net_like_delta AS BIGINT) AS like_count
  FROM (SELECT bvid, max(dt) AS newest, {interactions(True)} FROM ve
    WHERE bvid IS NOT NULL AND {when('event_id', MOVING)} AND ms < {until} GROUP BY bvid) WHERE newest > '{day}'"""


ORACLE["stream_counters_over_midnight"] = (
    f"{COMMON.rstrip().rstrip(',')} {_counters_at('2024-01-28', MORNING_MS)} UNION ALL {_counters_at('2024-01-29', 1 << 60)}"
)


@query
def stream_late_registrations(spark, sf_dir):
    """New accounts per day; messages that come a round late meet a window that is over, and are dropped."""
    path = work_path(spark, "late")
    events = topics.in_rounds(topics.events_of(spark, sf_dir))
    messages = topics.account_messages(events, ("round",)).select("json_str", "topic", "round")

    def run() -> None:
        files = stream_session(spark, STREAM_PARTITIONS).readStream.schema("json_str string, topic string")
        run_to_end(live.REGISTRATION.start(files.parquet(f"{path}/messages"), f"{path}/rows", f"{path}/checkpoint"))

    in_rounds(messages, f"{path}/messages", run)
    return plain(live.REGISTRATION.read(spark, f"{path}/rows", run_ts()).select("dt", "new_account_cnt"))


sql("stream_late_registrations", f""", r AS (SELECT *, {ROUND} AS round, (ms // 86400000 + 1) * 86400000 AS window_end FROM ae
    WHERE event_id = 'account_register' AND mid IS NOT NULL),
marks AS (SELECT n, coalesce((SELECT max(ms) - 5000 FROM r WHERE round < n), 0) AS mark FROM range(0, {topics.ROUNDS}) AS t(n))
SELECT dt, count(*) AS new_account_cnt FROM r JOIN marks ON marks.n = r.round WHERE window_end > mark GROUP BY dt""")


# ---- kept text -------------------------------------------------------------------------------


@query
def kept_json_text(spark, sf_dir):
    """The JSON text of three sub-objects, kept whole beside columns that are read out of it."""
    rows = detail.video_actions(Book(spark, sf_dir).raw("app_event_video"))
    return plain(rows.select("trace_id", "properties", "device_info", "app_context"))


_TEXT = """'{' || concat_ws(',', %s) || '}'"""


def _member(name: str, value: str, quoted: bool = True) -> str:
    return f"""'"{name}":' || {f"""'"' || {value} || '"'""" if quoted else f"({value})"}"""


_KEPT = {
    "properties": [
        _member("from", "event_type"), _member("coin_count", "coin_count", False), _member("progress_sec", "k", False),
        _member("play_speed", "'1.5'", False), _member("is_auto_play", "CASE WHEN k % 2 = 0 THEN 'true' ELSE 'false' END", False),
        _member("fav_folder_ids", "'[' || k || ',' || uid || ']'", False), _member("content", "'c' || k"),
    ],
    "device_info": [
        *(_member(n, v) for n, v in {"device_id": "device_id", "brand": "brand", "model": "'m1'", "os": "os", "os_version": "'17.1'"}.items()),
        _member("screen_width", "1080", False), _member("screen_height", "k + 2000", False),
        _member("carrier", "'cmcc'"), _member("network", "network"),
    ],
    "app_context": [_member(n, n) for n in ("app_version", "channel", "platform")],
}
sql("kept_json_text", f"""SELECT 't' || i AS trace_id, {', '.join(_TEXT % ', '.join(members) + f' AS {name}' for name, members in _KEPT.items())} FROM ve""")
