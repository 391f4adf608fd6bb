"""Follow and block relations between accounts.

The state is kept as one row per unordered pair of accounts (``lo`` <= ``hi``) with one flag per
direction, not as lists per account. Roll-forward, mutual follows and counts then need no list at
all: rows spread evenly over tasks however many followers one account has. Lists are built from
the pairs only for output, in chunks of bounded size (:func:`relation_chunks`), which :func:`relation_lists`
puts together to the whole lists of each account, one row per account however many relations it has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STATES = ("follow_fwd", "follow_bwd", "block_fwd", "block_bwd")
CHANGES = ("chg_fwd", "chg_bwd")
LISTS = ("following", "follower", "mutual_follow", "blocking", "blocked_by")
PAIR_SCHEMA = (
    "lo bigint, hi bigint, follow_fwd boolean, follow_bwd boolean, "
    "block_fwd boolean, block_bwd boolean, chg_fwd int, chg_bwd int"
)
# Ids in a chunk of an account's lists.
CHUNK_IDS = 100_000

# Which event adds to and which removes from each relation.
ADDING = {"follow": "social_follow", "block": "social_block"}
REMOVING = {"follow": "social_unfollow", "block": "social_unblock"}


def _seen(condition: Column) -> Column:
    return F.coalesce(F.bool_or(condition), F.lit(False))


def pair_actions(actions: DataFrame, ordered: bool = False) -> DataFrame:
    """One row per pair touched by ``actions`` (mid, target_mid, event_id), with what happened.

    Within a day the order of adding and removing does not matter: a removal wins. With
    ``ordered`` only the last event by ``server_ts`` of each direction and relation counts.
    """
    both = actions.where(F.col("mid").isNotNull() & F.col("target_mid").isNotNull())
    rows = both.select(
        F.least("mid", "target_mid").alias("lo"),
        F.greatest("mid", "target_mid").alias("hi"),
        (F.col("mid") <= F.col("target_mid")).alias("forward"),
        "event_id",
        *(["server_ts"] if ordered else []),
    )
    sides = {"fwd": F.col("forward"), "bwd": ~F.col("forward")}
    flags = {}
    for relation in ADDING:
        for side, on_side in sides.items():
            added = on_side & (F.col("event_id") == ADDING[relation])
            removed = on_side & (F.col("event_id") == REMOVING[relation])
            if ordered:
                # On equal time the removal counts as the later event.
                stamp = F.struct("server_ts", removed.alias("removed"))
                last = F.max(F.when(added | removed, stamp))["removed"]
                flags[f"add_{relation}_{side}"] = F.coalesce(~last, F.lit(False))
                flags[f"rem_{relation}_{side}"] = F.coalesce(last, F.lit(False))
            else:
                flags[f"add_{relation}_{side}"] = _seen(added)
                flags[f"rem_{relation}_{side}"] = _seen(removed)
    return rows.groupBy("lo", "hi").agg(*(flag.alias(name) for name, flag in flags.items()))


def relation_rollforward(
    previous: DataFrame | None, actions: DataFrame, ordered: bool = False
) -> DataFrame:
    """Pairs after the day: (yesterday or added) and not removed, per direction and relation.

    Pairs touched today stay in the result even when no relation is left, because the day's
    changes are read from them; :func:`live_pairs` drops them for the next day.
    """
    today = pair_actions(actions, ordered)
    if previous is None:
        joined = today.select(
            "*", *(F.lit(None).cast("boolean").alias(state) for state in STATES)
        )
    else:
        joined = live_pairs(previous).select("lo", "hi", *STATES).join(today, ["lo", "hi"], "full")

    def flag(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(False))

    return joined.select(
        "lo",
        "hi",
        *(
            ((flag(state) | flag(f"add_{state}")) & ~flag(f"rem_{state}")).alias(state)
            for state in STATES
        ),
        *(
            (flag(f"add_follow_{side}").cast("int") - flag(f"rem_follow_{side}").cast("int"))
            .alias(f"chg_{side}")
            for side in ("fwd", "bwd")
        ),
    )


def live_pairs(pairs: DataFrame) -> DataFrame:
    """Pairs with at least one relation left."""
    return pairs.where(F.col("follow_fwd") | F.col("follow_bwd") | F.col("block_fwd") | F.col("block_bwd"))


def pairs_from_lists(accounts: DataFrame) -> DataFrame:
    """Pairs out of a snapshot that holds ``following_list`` and ``blocking_list`` per account."""
    edges = None
    for relation, column in (("follow", "following_list"), ("block", "blocking_list")):
        part = accounts.select(
            "mid", F.explode(column).alias("target_mid"), F.lit(ADDING[relation]).alias("event_id")
        )
        edges = part if edges is None else edges.unionByName(part)
    return relation_rollforward(None, edges).withColumns(
        {change: F.lit(0) for change in CHANGES}
    )


def account_sides(pairs: DataFrame) -> DataFrame:
    """Each pair seen from both accounts: mid, other and one flag per list, plus the day's changes."""
    mutual = F.col("follow_fwd") & F.col("follow_bwd")

    def side(me: str, other: str, out: str, back: str) -> Column:
        own = F.col("lo") == F.col("hi")
        inward = F.when(own, F.col(f"follow_{out}")).otherwise(F.col(f"follow_{back}"))
        inward_block = F.when(own, F.col(f"block_{out}")).otherwise(F.col(f"block_{back}"))
        inward_chg = F.when(own, F.col(f"chg_{out}")).otherwise(F.col(f"chg_{back}"))
        return F.struct(
            F.col(me).alias("mid"),
            F.col(other).alias("other"),
            F.col(f"follow_{out}").alias("following"),
            inward.alias("follower"),
            F.when(own, F.col(f"follow_{out}")).otherwise(mutual).alias("mutual_follow"),
            F.col(f"block_{out}").alias("blocking"),
            inward_block.alias("blocked_by"),
            F.col(f"chg_{out}").alias("following_chg"),
            inward_chg.alias("follower_chg"),
        )

    low, high = side("lo", "hi", "fwd", "bwd"), side("hi", "lo", "bwd", "fwd")
    views = F.when(F.col("lo") == F.col("hi"), F.array(low)).otherwise(F.array(low, high))
    return pairs.select(F.inline(views))


def relation_counts(pairs: DataFrame) -> DataFrame:
    """Per account the size of every list and the day's net changes; sums combine map-side."""
    return account_sides(pairs).groupBy("mid").agg(
        *(F.count_if(F.col(name)).alias(f"{name}_cnt") for name in LISTS),
        F.sum("following_chg").alias("following_chg"),
        F.sum("follower_chg").alias("follower_chg"),
    )


def relation_members(pairs: DataFrame) -> DataFrame:
    """Every member of every account's relations as one row: mid, relation, other.

    A projection of the pairs, with no shuffle and no limit, so it is whole for accounts of any size.
    """
    named = F.array(*(F.when(F.col(name), F.lit(name)) for name in LISTS))
    return account_sides(live_pairs(pairs)).select("mid", F.explode(F.array_compact(named)).alias("relation"), "other")


def relation_chunks(pairs: DataFrame, counts: DataFrame, chunk_ids: int = CHUNK_IDS) -> DataFrame:
    """All lists of all accounts in chunks of about ``chunk_ids`` ids: mid, chunk, chunks, sorted id lists.

    An account's number of chunks follows from its exact counts, and an id's chunk from its hash, so a list of
    any length is put together by as many tasks as it has chunks, and no row grows with it. An id lies in the
    same chunk of all of its account's lists; mutual follows are so found chunk by chunk.
    """
    size = sum((F.col(f"{name}_cnt") for name in LISTS), F.lit(0))
    parts = counts.select("mid", F.ceil(size / chunk_ids).cast("int").alias("chunks")).where("chunks > 0")
    rows = account_sides(live_pairs(pairs)).join(parts, "mid")
    placed = rows.withColumn("chunk", F.pmod(F.xxhash64("other"), F.col("chunks")).cast("int"))
    return placed.groupBy("mid", "chunk", "chunks").agg(
        *(
            F.sort_array(F.collect_list(F.when(F.col(name), F.col("other")))).alias(f"{name}_list")
            for name in LISTS
        )
    )


def relation_lists(
    pairs: DataFrame, counts: DataFrame, inline_limit: int | None = None, chunk_ids: int = CHUNK_IDS
) -> DataFrame:
    """Sorted id lists per account, whole for accounts of any size.

    With ``inline_limit`` only accounts with at most so many relations get a row; :func:`relation_chunks` has the
    others. Chunks of an account are put together where they lie, as arrays of numbers, and are not moved once more.
    """
    if inline_limit is not None:
        return relation_chunks(pairs, counts, inline_limit).where("chunks = 1").drop("chunk", "chunks")
    return relation_chunks(pairs, counts, chunk_ids).groupBy("mid").agg(
        *(F.sort_array(F.flatten(F.collect_list(f"{name}_list"))).alias(f"{name}_list") for name in LISTS)
    )


def chunk_members(chunks: DataFrame) -> DataFrame:
    """Chunks of lists as rows: mid, relation, other."""
    lists = F.array(*(F.struct(F.lit(name).alias("relation"), F.col(f"{name}_list").alias("ids")) for name in LISTS))
    return chunks.select("mid", F.inline(lists)).select("mid", "relation", F.explode("ids").alias("other"))
