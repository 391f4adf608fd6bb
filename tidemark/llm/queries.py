"""The registered queries of the subpackage and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.common import table
from tidemark.llm.exact_dedup import OP7_SQL, op7_exact_dedup
from tidemark.llm.html_text import op10_html_text
from tidemark.llm.jaccard import OP6_SQL, op6_jaccard_join
from tidemark.llm.language import op9_language
from tidemark.llm.lexical import OP11_SQL, op11_lexical_search
from tidemark.llm.mixing import OP8_SQL, op8_mixing
from tidemark.llm.packing import op4_packing
from tidemark.llm.quality import OP5_SQL, op5_quality
from tidemark.llm.records import op2_records
from tidemark.llm.simhash import op12_simhash
from tidemark.llm.toxicity import op3_toxicity
from tidemark.llm.url_filter import op1_url_filter
from tidemark.llm.whitening import op13_whitening

Query = Callable[[SparkSession, str], DataFrame]


def _documents(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(table(spark, sf_dir, "documents"))


def _toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op3_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Query] = {
    "op1_url_filter": lambda spark, sf_dir: op1_url_filter(table(spark, sf_dir, "pages")),
    "op2_records": _documents(op2_records),
    "op3_toxicity": _toxicity,
    "op4_packing": _documents(op4_packing),
    "op5_quality": _documents(op5_quality),
    "op6_jaccard_join": _documents(op6_jaccard_join),
    "op7_exact_dedup": _documents(op7_exact_dedup),
    "op8_mixing": _documents(op8_mixing),
    "op9_language": _documents(op9_language),
    "op10_html_text": lambda spark, sf_dir: op10_html_text(table(spark, sf_dir, "pages")),
    "op11_lexical_search": lambda spark, sf_dir: op11_lexical_search(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    ),
    "op12_simhash": _documents(op12_simhash),
    "op13_whitening": lambda spark, sf_dir: op13_whitening(table(spark, sf_dir, "embeddings")),
}

ORACLE: dict[str, str] = {
    "op5_quality": OP5_SQL,
    "op6_jaccard_join": OP6_SQL,
    "op7_exact_dedup": OP7_SQL,
    "op8_mixing": OP8_SQL,
    "op11_lexical_search": OP11_SQL,
}
