"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored


def _stars(pairs: DataFrame, centres: DataFrame) -> DataFrame:
    """Each node's neighbours hung on the node's centre; pairs without two ends go."""
    hung = pairs.join(centres, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.where("u <> v")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (u, v: bigint) but the roots; the root is a component's
    smallest node. Minima are combined before their shuffle, so a node with very many neighbours is
    spread; each round is written, so a lost executor costs a task."""
    now = stored(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    mark = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = _stars(both.where("v > u"), lowest).unionByName(lowest.where("u <> m").select("u", F.col("m").alias("v")))
        large = large.distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = _stars(large, lowest).unionByName(lowest.select("u", F.col("m").alias("v")))
        now = stored(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == mark:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = state
