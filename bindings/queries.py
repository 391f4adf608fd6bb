"""The registered queries: every operator and job over the driver's whole tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bindings import topics
from bindings.topics import DAY_BEFORE, RUN_DAY, old_run_ts, run_ts, table
from tidemark.functions.derive import age_by_calendar, array_text, reverse_key, vip_state
from tidemark.functions.json_paths import extract_json, json_fields
from tidemark.functions.labels import code_label, vip_type_name
from tidemark.operators import cumulate as cum
from tidemark.operators import relations
from tidemark.operators.enrich import inner_enrich, left_enrich
from tidemark.operators.orders import accumulate_order
from tidemark.operators.rows import fill_defaults
from tidemark.operators.serving import latest_version, pack_families, protect_keys, unify_batch_speed, unpack_families
from tidemark.operators.snapshots import (
    accumulate_snapshot,
    assemble,
    key_spine,
    latest_by_key,
    merge_latest,
    new_keys,
)
from tidemark.plans import detail, dims, serving, stats, summaries
from tidemark.session import spread, stream_session, work_path
from tidemark.sources.changelog import read_columns, read_latest, upsert_versioned
from tidemark.sources.raw import read_raw
from tidemark.sources.tables import Tables
from tidemark.sources.wide import WideTable
from tidemark.streaming import dims as live_dims
from tidemark.streaming import orders as live_orders
from tidemark.streaming import summaries as live
from tidemark.streaming.lookups import start_enriched
from tidemark.streaming.landing import land_raw_events
from tidemark.streaming.runs import run_to_end, start

EVENTS_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
# For tables of a few gigabytes.
STREAM_PARTITIONS = 8
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def plain(df: DataFrame) -> DataFrame:
    """Columns in types both engines print alike: bigint, double, boolean, text; structs flattened."""
    columns: list[Column] = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.StructType):
            columns += [column[leaf.name].alias(f"{field.name}__{leaf.name}") for leaf in field.dataType.fields]
        elif isinstance(field.dataType, T.IntegralType):
            columns.append(column.cast("bigint").alias(field.name))
        elif isinstance(field.dataType, T.DecimalType):
            columns.append(column.cast("double").alias(field.name))
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            columns.append(F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias(field.name))
        elif isinstance(field.dataType, T.ArrayType):
            columns.append(array_text(column).alias(field.name))
        else:
            columns.append(column.alias(field.name))
    return df.select(*columns)


def _past(df: DataFrame) -> DataFrame:
    return df.where(F.col("dt") < RUN_DAY)


def _today(df: DataFrame) -> DataFrame:
    return df.where(F.col("dt") == RUN_DAY)


class Book:
    """The jobs over one data folder: all days before the run day folded into the snapshot of the
    day before, and the run day rolled on top of it.

    What a query reads several times is written as the nightly run writes it, under the shared
    folder, and read back, so that nothing is computed twice; what it reads once (or once per
    disjoint set of days) stays a plan.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def tables(self) -> Tables:
        return Tables(self.spark, work_path(self.spark, "book"))

    def _day(self, name: str, dt: str, df: DataFrame) -> DataFrame:
        self.tables.overwrite_partition(df, name, dt)
        return self.tables.scan_snapshot(name, dt)

    def _days(self, name: str, df: DataFrame) -> DataFrame:
        self.tables.overwrite_days(df, name)
        return self.tables.read(name)

    def _known(self, name: str) -> DataFrame:
        """The stored form of a step if this book has stored it, else the step's plan."""
        return self.__dict__[f"stored_{name}"] if f"stored_{name}" in self.__dict__ else getattr(self, name)

    def raw(self, topic: str) -> DataFrame:
        return topics.raw_messages(self.spark, self.sf_dir, topic).drop("ms")

    @cached_property
    def video_actions(self) -> DataFrame:
        return detail.video_actions(self.raw("app_event_video"), columns=stats.VIDEO_STATS_INPUT)

    @cached_property
    def comment_actions(self) -> DataFrame:
        return detail.comment_actions(self.raw("app_event_comment"), columns=stats.COMMENT_STATS_INPUT)

    @cached_property
    def account_actions(self) -> DataFrame:
        return detail.account_actions(self.raw("app_event_social"), columns=["mid", "target_mid"])

    @cached_property
    def orders(self) -> DataFrame:
        return detail.vip_orders(self.raw("app_event_vip"))

    def _paid(self) -> DataFrame:
        """What the accounts read of the orders."""
        if "stored_orders" in self.__dict__:
            return self.stored_orders
        return detail.vip_orders(self.raw("app_event_vip"), columns=dims.PAID_INPUT)

    @cached_property
    def stored_orders(self) -> DataFrame:
        return self._days("dwd_order_vip_di", self.orders)

    @cached_property
    def video_stats(self) -> DataFrame:
        return stats.video_stats(self.video_actions)

    @cached_property
    def stored_video_stats(self) -> DataFrame:
        return self._days("dwd_stats_video_di", self.video_stats)

    @cached_property
    def pairs_before(self) -> DataFrame:
        pairs = relations.relation_rollforward(None, _past(self.account_actions))
        return self._day("dim_account_relation_df", DAY_BEFORE, pairs)

    @cached_property
    def pairs(self) -> DataFrame:
        return relations.relation_rollforward(self.pairs_before, _today(self.account_actions))

    @cached_property
    def stored_pairs(self) -> DataFrame:
        return self._day("dim_account_relation_df", RUN_DAY, self.pairs)

    @cached_property
    def accounts_before(self) -> DataFrame:
        # Only the id and the membership state are read from it, so no lists are built.
        return dims.account_snapshot(
            DAY_BEFORE, old_run_ts(), dims.profiles(self.raw("app_user_profile"), DAY_BEFORE), self.pairs_before,
            _past(self._paid()), None, lists=False,
        )

    @cached_property
    def stored_accounts_before(self) -> DataFrame:
        return self._day("dim_account_df", DAY_BEFORE, self.accounts_before)

    def _accounts(self, inline_limit: int | None = None, lists: bool = True) -> DataFrame:
        return dims.account_snapshot(
            RUN_DAY, run_ts(), dims.profiles(self.raw("app_user_profile"), RUN_DAY), self.stored_pairs,
            _today(self._paid()), self._known("accounts_before"), inline_limit=inline_limit,
            lists=lists,
        )

    @cached_property
    def accounts(self) -> DataFrame:
        return self._accounts()

    @cached_property
    def accounts_without_lists(self) -> DataFrame:
        return self._accounts(lists=False)

    @cached_property
    def videos_before(self) -> DataFrame:
        return dims.video_snapshot(
            DAY_BEFORE, old_run_ts(), dims.video_content(_past(self.raw("app_video_content")), None),
            _past(self._known("video_stats")), _past(stats.reply_counts(self.comment_actions)), None,
        )

    @cached_property
    def videos(self) -> DataFrame:
        return dims.video_snapshot(
            RUN_DAY, run_ts(), dims.video_content(self.raw("app_video_content"), RUN_DAY),
            _today(self._known("video_stats")), _today(stats.reply_counts(self.comment_actions)), self.videos_before,
        )

    @cached_property
    def comments(self) -> DataFrame:
        entities = self.raw("app_comment")
        daily = stats.comment_stats(self.comment_actions)
        before = dims.comment_snapshot(
            DAY_BEFORE, old_run_ts(), dims.comment_entities(_past(entities), None), _past(daily), None
        )
        return dims.comment_snapshot(RUN_DAY, run_ts(), dims.comment_entities(entities, RUN_DAY), _today(daily), before)

    @cached_property
    def video_wide(self) -> DataFrame:
        """Wide video rows from the messages alone, as the live attribute stream writes them."""
        changes = live_dims.video_attributes(self.raw("app_video_content"))
        return latest_by_key(changes, ["rowkey"], ["version"])

    @cached_property
    def account_wide(self) -> DataFrame:
        return serving.account_rows(self.accounts, RUN_DAY)

    def registry(self) -> DataFrame:
        before = self.stored_accounts_before
        fresh = summaries.registry_source(self.accounts_without_lists, before, run_ts())
        return fresh.withColumn("dt", F.lit(RUN_DAY))

    def uploaders(self) -> DataFrame:
        daily = self.stored_video_stats
        return summaries.uploader_summary(daily, self.videos, self.accounts_without_lists, run_ts())

    def video_rows(self) -> DataFrame:
        daily = self.stored_video_stats
        return summaries.video_summary(daily, self.videos, self.accounts_without_lists, run_ts())

    def order_source(self) -> DataFrame:
        orders = self.stored_orders
        return summaries.order_source(orders, self.accounts_without_lists, run_ts())


# ---- operators over the tables ---------------------------------------------------------------


@query
def json_flatten(spark, sf_dir):
    fields = json_fields("k bigint\nk_text string k\nk_double double k\nk_flag flag k\nabsent int a.b.c")
    return plain(extract_json(table(spark, sf_dir, "events"), fields, "props", carry=("event_id", "user_id")))


@query
def quality_flags(spark, sf_dir):
    rows = detail.video_actions(Book(spark, sf_dir).raw("app_event_video"))
    return plain(rows.select("trace_id", "dt", "is_valid", "invalid_reason"))


@query
def code_labels(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    labelled = orders.select(
        "o_orderkey",
        code_label(F.col("o_orderstatus"), {"O": "open", "F": "filled"}, "other").alias("status_label"),
        vip_type_name((F.col("o_orderkey") % 5).cast("int")).alias("vip_label"),
        F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_orderpriority")).alias("priority"),
        F.when(F.col("o_totalprice") > 1000, F.floor("o_totalprice")).alias("price"),
    )
    return plain(fill_defaults(labelled, {"priority": "unknown", "price": -1}))


@query
def order_accumulate(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    names = ("vip_create_order", "vip_pay_start", "vip_pay_fail", "vip_pay_cancel", "vip_pay_success", "vip_page_view", "x")
    number = F.col("l_linenumber") % len(names)
    events = lines.select(
        "l_orderkey",
        F.get(F.array(*(F.lit(n) for n in names)), number.cast("int")).alias("event_id"),
        F.unix_millis(F.col("l_shipdate").cast("timestamp")).alias("server_ts"),
        F.col("l_suppkey").alias("mid"),
        F.col("l_returnflag").alias("plan_id"),
        F.floor("l_extendedprice").alias("final_price"),
        F.col("l_linestatus").alias("platform"),
    )
    return plain(accumulate_order(events, ["l_orderkey"]))


@query
def latest_order_per_customer(spark, sf_dir):
    newest = latest_by_key(table(spark, sf_dir, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"])
    return plain(newest)


@query
def merge_latest_orders(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    old = latest_by_key(orders.where(F.col("o_orderdate") < "1998-01-01"), ["o_custkey"], ["o_orderdate", "o_orderkey"])
    changes = orders.where(F.col("o_orderdate") >= "1998-01-01")
    return plain(merge_latest(old, changes, ["o_custkey"], "o_orderdate", ["o_orderkey"]))


@query
def relation_pairs(spark, sf_dir):
    return plain(relations.live_pairs(Book(spark, sf_dir).pairs))


@query
def relation_counts(spark, sf_dir):
    return plain(relations.relation_counts(Book(spark, sf_dir).pairs))


@query
def relation_members(spark, sf_dir):
    return plain(relations.relation_members(Book(spark, sf_dir).pairs))


@query
def relation_lists(spark, sf_dir):
    pairs = Book(spark, sf_dir).stored_pairs
    return plain(relations.relation_lists(pairs, relations.relation_counts(pairs)))


@query
def relation_chunks(spark, sf_dir):
    """Every member of every list, by way of chunks of about twenty ids."""
    pairs = Book(spark, sf_dir).stored_pairs
    chunks = relations.relation_chunks(pairs, relations.relation_counts(pairs), 20)
    return plain(relations.chunk_members(chunks))


@query
def dim_account_members(spark, sf_dir):
    """Every member by the two places that hold it: account rows, and chunks of the larger accounts."""
    book = Book(spark, sf_dir)
    rows = book._accounts(20).select("mid", *(f"{name}_list" for name in relations.LISTS))
    large = dims.large_account_lists(book.stored_pairs, 20).select(*rows.columns)
    return plain(relations.chunk_members(rows.unionByName(large)))


@query
def relation_pairs_ordered(spark, sf_dir):
    actions = Book(spark, sf_dir).account_actions
    return plain(relations.live_pairs(relations.relation_rollforward(None, actions, ordered=True)))


@query
def cumulative_snapshot(spark, sf_dir):
    totals = {"views": "view_count", "likes": "net_like_delta"}
    daily = Book(spark, sf_dir).stored_video_stats
    before = _past(daily).groupBy("bvid").agg(*(F.sum(d).alias(t) for t, d in totals.items()))
    return plain(accumulate_snapshot(before, _today(daily), ["bvid"], totals))


@query
def customers_without_orders(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey")
    fresh = new_keys(table(spark, sf_dir, "customer"), orders, ["c_custkey"])
    return plain(fresh.select("c_custkey", "c_mktsegment"))


@query
def key_spine_assembly(spark, sf_dir):
    """Customers and nations' suppliers on one key spine, with what each side knows."""
    customers = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("nation")).agg(
        F.count("*").alias("customers")
    )
    suppliers = table(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("nation")).agg(
        F.count("*").alias("suppliers")
    )
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("nation"))
    return plain(assemble(key_spine(["nation"], nations, customers, suppliers), [customers, suppliers], ["nation"]))


@query
def line_detail(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_partkey").alias("p_partkey"), F.col("l_suppkey").alias("s_suppkey"),
        "l_quantity",
    )
    parts = inner_enrich(lines, table(spark, sf_dir, "part"), ["p_partkey"], ["p_name", "p_brand"])
    return plain(left_enrich(parts, table(spark, sf_dir, "supplier"), ["s_suppkey"], ["s_name", "s_nationkey"]))


@query
def customer_summary(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), F.col("l_quantity").cast("bigint").alias("quantity")
    )
    per_order = lines.groupBy("o_orderkey").agg(F.sum("quantity").alias("quantity"), F.count("*").alias("lines"))
    owned = inner_enrich(per_order, table(spark, sf_dir, "orders"), ["o_orderkey"], ["o_custkey"])
    totals = owned.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count("o_orderkey").alias("orders"), F.sum("lines").alias("lines"), F.sum("quantity").alias("quantity"),
        F.call_function("div", F.sum("quantity"), F.nullif(F.sum("lines"), F.lit(0))).alias("avg_quantity"),
    )
    return plain(left_enrich(totals, table(spark, sf_dir, "customer"), ["c_custkey"], ["c_name", "c_mktsegment"]))


@query
def order_cube(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("c_custkey"), "o_orderstatus", "o_orderpriority",
        F.year("o_orderdate").alias("year"), F.floor("o_totalprice").alias("price"),
    )
    known = left_enrich(orders, table(spark, sf_dir, "customer"), ["c_custkey"], ["c_mktsegment", "c_nationkey"])
    named = left_enrich(
        known.withColumnRenamed("c_nationkey", "n_nationkey"), table(spark, sf_dir, "nation"), ["n_nationkey"],
        ["n_name", "n_regionkey"],
    )
    keys = ["o_orderstatus", "o_orderpriority", "year", "c_mktsegment", "n_name", "n_regionkey"]
    return plain(
        named.groupBy(*keys).agg(
            F.count("*").alias("order_cnt"), F.count("c_custkey").alias("user_cnt"),
            F.max(F.coalesce("price", F.lit(0))).alias("price"),
        )
    )


@query
def vip_state_rules(spark, sf_dir):
    events = topics.events_of(spark, sf_dir)
    new = F.when(F.col("i") % 2 == 0, F.col("ms") + F.col("k") * 86_400_000)
    old = F.timestamp_seconds(F.call_function("div", F.col("ms"), F.lit(1000)) + F.col("uid") * 3600)
    rows = events.withColumns({"new": new, "old": F.when(F.col("i") % 5 != 0, old), "days": F.col("k")})
    out = {}
    for unit, value in (("ms", F.col("new")), ("s", F.call_function("div", F.col("new"), F.lit(1000)))):
        expire, kind = vip_state("2024-01-15", value, F.col("days"), F.col("old"), F.lit(2), unit)
        out |= {f"expire_{unit}": expire, f"kind_{unit}": kind}
    return plain(rows.select("i", *(c.alias(n) for n, c in out.items())))


@query
def calendar_age(spark, sf_dir):
    born = F.concat((F.lit(1960) + F.col("c_nationkey")).cast("string"), F.lit("-0"), (F.col("c_custkey") % 9 + 1).cast("string"), F.lit("-30"))
    return plain(table(spark, sf_dir, "customer").select("c_custkey", age_by_calendar(born, F.lit(RUN_DAY)).alias("age")))


@query
def cumulate_hourly(spark, sf_dir):
    events = topics.events_of(spark, sf_dir).withColumn("ts", F.timestamp_millis("ms"))
    return plain(
        cum.cumulate(
            events, "ts", "1 hour", "1 day", ["event_type"],
            sums={"n": F.lit(1), "amount": F.col("amount")}, maxima={"top_k": F.col("k")}, firsts={"first_i": "i"},
        )
    )


@query
def cumulate_dense(spark, sf_dir):
    events = topics.events_of(spark, sf_dir).withColumn("ts", F.timestamp_millis("ms"))
    return plain(cum.cumulate(events, "ts", "15 minutes", "1 hour", ["event_type"], sums={"n": F.lit(1)}, dense=True))


@query
def cumulate_distinct(spark, sf_dir):
    events = topics.events_of(spark, sf_dir).withColumn("ts", F.timestamp_millis("ms"))
    return plain(
        cum.cumulate(
            events, "ts", "1 hour", "1 day", ["event_type"], sums={"n": F.lit(1)}, distincts={"users": "uid", "keys": "k"}
        )
    )


@query
def cumulate_registrations(spark, sf_dir):
    rows = live.REGISTRATION.parse(Book(spark, sf_dir).raw("app_event_account"))
    return plain(cum.cumulate(rows, "event_time", "60 seconds", "1 day", sums={"new_account_cnt": F.lit(1)}))


@query
def local_day_totals(spark, sf_dir):
    events = topics.events_of(spark, sf_dir).withColumn("ts", F.timestamp_millis("ms"))
    final = cum.cumulate_final(
        events, "ts", "1 day", ["event_type"], [F.count("*").alias("n")], start=cum.utc_offset_start(8)
    )
    return plain(final)


@query
def latest_versions(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "props")
    return plain(latest_version(events, ["user_id", "event_type"], "ts", ["event_id"]))


@query
def unify_layers(spark, sf_dir):
    daily = topics.events_of(spark, sf_dir).groupBy("uid", "dt").agg(
        F.sum("amount").alias("amount"), F.count("*").alias("n"), F.max("ms").alias("dw_create_time")
    )
    closing = F.unix_millis(F.to_timestamp(F.col("dt"))) + 26 * 3_600_000
    batch = _past(daily).withColumns({"amount": -F.col("amount"), "dw_create_time": closing})
    speed = daily.drop("amount")
    return plain(unify_batch_speed(batch, speed, ["uid", "dt"]))


@query
def protected_keys(spark, sf_dir):
    holes = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).alias("segment"),
        F.when(F.col("c_nationkey") > 5, F.col("c_nationkey")).alias("nation"),
        F.when(F.col("c_acctbal") > 0, F.floor("c_acctbal")).alias("balance"),
    )
    return plain(protect_keys(holes, {"segment": "unknown", "nation": -1, "absent": 0}))


@query
def wide_rows(spark, sf_dir):
    """Flat to families and back again, keyed by the reversed id."""
    customer = table(spark, sf_dir, "customer")
    layout = {
        "basic": {"id": F.col("c_custkey"), "name": F.col("c_name")},
        "place": {"nation": F.col("c_nationkey"), "segment": F.col("c_mktsegment")},
    }
    packed = pack_families(customer, reverse_key(F.col("c_custkey")), layout)
    flat = {"id": ("basic.id", "bigint"), "name": ("basic.name", "string"), "nation": ("place.nation", "int"),
            "segment": ("place.segment", "string")}
    return plain(unpack_families(packed, flat))


# ---- nightly jobs ----------------------------------------------------------------------------


@query
def dwd_account_actions(spark, sf_dir):
    return plain(detail.account_actions(Book(spark, sf_dir).raw("app_event_social")))


@query
def dwd_comment_actions(spark, sf_dir):
    rows = detail.comment_actions(Book(spark, sf_dir).raw("app_event_comment"))
    kept = rows.withColumns(
        {"properties": F.get_json_object("properties", "$.content"), "device_info": F.get_json_object("device_info", "$.os"),
         "app_context": F.get_json_object("app_context", "$.platform")}
    )
    return plain(kept)


@query
def dwd_video_actions(spark, sf_dir):
    rows = detail.video_actions(Book(spark, sf_dir).raw("app_event_video"))
    kept = rows.withColumns(
        {"properties": F.get_json_object("properties", "$.from"), "device_info": F.get_json_object("device_info", "$.os"),
         "app_context": F.get_json_object("app_context", "$.platform")}
    )
    return plain(kept)


@query
def dwd_vip_orders(spark, sf_dir):
    return plain(Book(spark, sf_dir).orders)


@query
def dwd_vip_orders_newest(spark, sf_dir):
    return plain(detail.vip_orders(Book(spark, sf_dir).raw("app_event_vip"), newest=True))


@query
def dwd_video_stats(spark, sf_dir):
    return plain(Book(spark, sf_dir).video_stats)


@query
def dwd_video_stats_triple(spark, sf_dir):
    return plain(stats.video_stats(Book(spark, sf_dir).video_actions, triple_counts=True))


@query
def dwd_comment_stats(spark, sf_dir):
    return plain(stats.comment_stats(Book(spark, sf_dir).comment_actions))


@query
def dwd_comment_stats_parent(spark, sf_dir):
    return plain(stats.comment_stats(Book(spark, sf_dir).comment_actions, credit_parent=True))


@query
def video_reply_counts(spark, sf_dir):
    return plain(stats.reply_counts(Book(spark, sf_dir).comment_actions))


@query
def dim_account(spark, sf_dir):
    return plain(Book(spark, sf_dir).accounts.drop("dw_create_time"))


@query
def dim_video(spark, sf_dir):
    return plain(Book(spark, sf_dir).videos)


@query
def dim_comment(spark, sf_dir):
    return plain(Book(spark, sf_dir).comments)


@query
def dws_account_registry(spark, sf_dir):
    return plain(Book(spark, sf_dir).registry().drop("dw_create_time"))


@query
def dws_uploader_summary(spark, sf_dir):
    return plain(Book(spark, sf_dir).uploaders().drop("dw_create_time"))


@query
def dws_video_summary(spark, sf_dir):
    return plain(Book(spark, sf_dir).video_rows().drop("dw_create_time"))


@query
def dws_order_source(spark, sf_dir):
    return plain(Book(spark, sf_dir).order_source().drop("dw_create_time"))


@query
def exact_uploader_viewers(spark, sf_dir):
    book = Book(spark, sf_dir)
    return plain(summaries.exact_uploader_viewers(book.video_actions, book.videos))


# ---- serving ---------------------------------------------------------------------------------


@query
def serve_uploaders(spark, sf_dir):
    return plain(serving.load_summary("dws_video_stats_account_di", Book(spark, sf_dir).uploaders()).drop("dw_create_time"))


@query
def serve_videos(spark, sf_dir):
    return plain(serving.load_summary("dws_video_stats_account_di_v2", Book(spark, sf_dir).video_rows()).drop("dw_create_time"))


@query
def serve_registry(spark, sf_dir):
    return plain(serving.load_summary("dws_account_registry_source_di", Book(spark, sf_dir).registry()).drop("dw_create_time"))


@query
def serve_orders(spark, sf_dir):
    return plain(serving.load_summary("dws_vip_order_source_di", Book(spark, sf_dir).order_source()).drop("dw_create_time"))


@query
def serve_account_rows(spark, sf_dir):
    return plain(serving.account_rows(Book(spark, sf_dir).accounts, RUN_DAY))


@query
def serve_video_rows(spark, sf_dir):
    return plain(serving.video_rows(Book(spark, sf_dir).videos, RUN_DAY))


@query
def serve_comment_rows(spark, sf_dir):
    return plain(serving.comment_rows(Book(spark, sf_dir).comments, RUN_DAY))


# ---- live summaries on stored events ---------------------------------------------------------


def _live_view(spark: SparkSession, sf_dir: str, summary: live.LiveSummary) -> DataFrame:
    totals = summary.totals(summary.parse(Book(spark, sf_dir).raw(summary.topic)))
    return summary.view(totals, run_ts()).drop("dw_create_time")


@query
def speed_uploader(spark, sf_dir):
    return plain(_live_view(spark, sf_dir, live.UPLOADER))


@query
def speed_video(spark, sf_dir):
    book = Book(spark, sf_dir)
    view = _live_view(spark, sf_dir, live.VIDEO)
    videos = book.videos.select("bvid", "title", "duration", "pubdate", "pub_date", "category_id", "category_name")
    return plain(live.enrich_video_view(view, videos, book.accounts_without_lists))


@query
def speed_vip_order(spark, sf_dir):
    return plain(_live_view(spark, sf_dir, live.VIP_ORDER))


@query
def speed_registration(spark, sf_dir):
    return plain(_live_view(spark, sf_dir, live.REGISTRATION))


@query
def speed_registration_source(spark, sf_dir):
    return plain(_live_view(spark, sf_dir, live.REGISTRATION_SOURCE))


@query
def speed_account_columns(spark, sf_dir):
    changes = live_dims.account_attributes(Book(spark, sf_dir).raw("app_user_profile"), F.lit(RUN_DAY), run_ts())
    return plain(latest_by_key(changes, ["rowkey"], ["version"]))


@query
def speed_video_columns(spark, sf_dir):
    return plain(Book(spark, sf_dir).video_wide)


@query
def speed_comment_columns(spark, sf_dir):
    changes = live_dims.comment_attributes(Book(spark, sf_dir).raw("app_comment"))
    return plain(latest_by_key(changes, ["rowkey"], ["version", "content"]))


def _arrivals(spark: SparkSession, sf_dir: str, topic: str) -> DataFrame:
    return topics.raw_messages(spark, sf_dir, topic).withColumn("arrival", F.timestamp_millis("ms"))


@query
def speed_video_counters(spark, sf_dir):
    totals = live_dims.video_counters(_arrivals(spark, sf_dir, "app_event_video"))
    return plain(totals.withColumn("dt", F.date_format("window.start", "yyyy-MM-dd")).drop("window"))


@query
def speed_video_counters_total(spark, sf_dir):
    """The run day's counters on top of the snapshot of the day before."""
    book = Book(spark, sf_dir)
    totals = live_dims.video_counters(_arrivals(spark, sf_dir, "app_event_video")).where(F.date_format("window.start", "yyyy-MM-dd") == RUN_DAY)
    return plain(live_dims.counter_columns(totals, live_dims.video_key(), book.videos_before, ("bvid",)).drop("version"))


@query
def speed_video_replies(spark, sf_dir):
    totals = live_dims.video_reply_counters(_arrivals(spark, sf_dir, "app_event_comment"))
    return plain(totals.withColumn("dt", F.date_format("window.start", "yyyy-MM-dd")).drop("window"))


@query
def speed_comment_counters(spark, sf_dir):
    totals = live_dims.comment_counters(_arrivals(spark, sf_dir, "app_event_comment"))
    return plain(totals.withColumn("dt", F.date_format("window.start", "yyyy-MM-dd")).drop("window"))


# ---- streams ---------------------------------------------------------------------------------


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = stream_session(spark, STREAM_PARTITIONS).readStream.schema(EVENTS_SCHEMA)
    # A stream's plain path must be a folder; a pattern may match the table as a file or a folder.
    return topics.shape_events(spread(files.parquet(f"{sf_dir}/event[s].parquet"), table(spark, sf_dir, "events")))


def _live_stream(spark: SparkSession, sf_dir: str, summary: live.LiveSummary, messages) -> DataFrame:
    path = work_path(spark, summary.name)
    raw = messages(_event_stream(spark, sf_dir))
    run_to_end(summary.start(raw, f"{path}/rows", f"{path}/checkpoint"))
    return plain(summary.read(spark, f"{path}/rows", run_ts()).drop("dw_create_time"))


@query
def stream_uploader(spark, sf_dir):
    return _live_stream(spark, sf_dir, live.UPLOADER, topics.video_messages)


@query
def stream_video_lookup(spark, sf_dir):
    """Live totals per video and account, with columns looked up in the wide rows."""
    path, book = work_path(spark, "video-lookup"), Book(spark, sf_dir)
    tables = {"videos": book.video_wide, "accounts": book.account_wide.withColumn("version", F.lit(1).cast("bigint"))}
    wide = {name: WideTable(f"{path}/{name}", buckets=16) for name in tables}
    for name, rows in tables.items():
        wide[name].load(rows, name, 0)
        wide[name].compact(spark, [name], open_batches=0)
    raw = topics.video_messages(_event_stream(spark, sf_dir))
    query_run = start_enriched(
        live.VIDEO.totals(live.VIDEO.parse(raw)),
        lambda keys: wide["videos"].read_for(keys, ["videos"]),
        lambda keys: wide["accounts"].read_for(keys, ["accounts"]),
        upsert_versioned(f"{path}/rows", "video"),
        f"{path}/checkpoint",
    )
    run_to_end(query_run)
    return plain(read_latest(spark, f"{path}/rows", ["window_start", "bvid", "mid"]).drop("window_end"))


@query
def stream_vip_order(spark, sf_dir):
    return _live_stream(spark, sf_dir, live.VIP_ORDER, topics.vip_messages)


@query
def stream_registration(spark, sf_dir):
    return _live_stream(spark, sf_dir, live.REGISTRATION, topics.account_messages)


@query
def stream_registration_source(spark, sf_dir):
    return _live_stream(spark, sf_dir, live.REGISTRATION_SOURCE, topics.account_messages)


def in_rounds(rows: DataFrame, path: str, run: Callable[[], None], rounds: int = topics.ROUNDS) -> None:
    """Rows fed to a stream's folder by their ``round``; the stream is restarted from its checkpoint for each."""
    for number in range(rounds):
        rows.where(F.col("round") == number).drop("round").write.mode("append").parquet(path)
        run()


def _order_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order messages in several rounds; every thirteenth comes a round late, behind the watermark."""
    path = work_path(spark, "order-changes")
    events = topics.in_rounds(topics.events_of(spark, sf_dir))
    messages = topics.vip_messages(events, ("round",)).select("json_str", "topic", "round")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/rows/batch_id={batch_id}")

    def run() -> None:
        files = stream_session(spark, STREAM_PARTITIONS, keyed=True).readStream.schema("json_str string, topic string")
        changing = live_orders.order_events(files.parquet(f"{path}/messages"))
        changes = live_orders.order_changes(changing, ttl_seconds=6 * 3600)
        run_to_end(start(changes, write, f"{path}/checkpoint", mode="append"))

    in_rounds(messages, f"{path}/messages", run)
    return spark.read.schema(live_orders.CHANGE_SCHEMA).parquet(f"{path}/rows/batch_id=*")


@query
def stream_order_changes(spark, sf_dir):
    return plain(_order_changes(spark, sf_dir))


@query
def stream_pending_orders(spark, sf_dir):
    """Orders whose last change created them, at the end of the stream."""
    pending = live_orders.pending_orders(_order_changes(spark, sf_dir))
    return plain(pending.select("order_no", "mid", "server_ts"))


@query
def stream_vip_updates(spark, sf_dir):
    path = work_path(spark, "vip-updates")
    raw = topics.vip_messages(_event_stream(spark, sf_dir))
    run_to_end(live_orders.start_vip_updates(raw, f"{path}/rows", f"{path}/checkpoint", run_ts(), expire_unit="ms"))
    return plain(read_columns(spark, f"{path}/rows", ["vip_orders"]))


@query
def stream_column_upsert(spark, sf_dir):
    """Three streams and one table of wide video rows: attributes, counters and reply counts."""
    path = work_path(spark, "videos")
    events = _event_stream(spark, sf_dir)

    def arriving(messages: DataFrame) -> DataFrame:
        return messages.withColumn("arrival", F.timestamp_millis("ms"))

    parts = stream_session(spark, STREAM_PARTITIONS).readStream.schema(
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
    ).parquet(f"{sf_dir}/par[t].parquet")
    parts = spread(parts, table(spark, sf_dir, "part"))
    rows = f"{path}/rows"
    run_to_end(
        live_dims.start_upsert(
            live_dims.video_attributes(topics.content_messages(parts)), rows, "attributes", f"{path}/c1"
        ),
        live_dims.start_counters(
            live_dims.video_counters(arriving(topics.video_messages(events))), live_dims.video_key(), rows,
            "counters", f"{path}/c2", trigger=None, keys=("bvid",),
        ),
        live_dims.start_counters(
            live_dims.video_reply_counters(arriving(topics.comment_messages(events))), live_dims.video_key(), rows,
            "replies", f"{path}/c3", trigger=None, keys=("bvid",),
        ),
    )
    return plain(read_columns(spark, rows, ["attributes", "counters", "replies"]))


@query
def stream_landing(spark, sf_dir):
    path = work_path(spark, "landing")
    events = _event_stream(spark, sf_dir)
    makers = (topics.video_messages, topics.social_messages, topics.comment_messages, topics.vip_messages, topics.account_messages)
    records = None
    for maker in makers:
        part = maker(events).select("json_str", "topic", F.timestamp_millis("ms").alias("arrival"))
        records = part if records is None else records.unionByName(part)
    run_to_end(land_raw_events(records, f"{path}/raw", f"{path}/checkpoint"))
    landed = read_raw(spark, f"{path}/raw")
    return plain(landed.groupBy("dt", "topic").agg(F.count("json_str").alias("messages")))


__all__ = ["QUERIES", "plain"]
