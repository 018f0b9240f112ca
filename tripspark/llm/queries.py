"""The registered query of each operator, over its whole table, and its SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tripspark.llm import (
    chat_format,
    decontaminate,
    lexical_search,
    line_dedup,
    lm_scoring,
    neighbours,
    packing,
    prefix_trie,
    quality_classifier,
    quality_rules,
    simhash,
    substring_dedup,
    warc,
)
from tripspark.llm.common import read
from tripspark.session import ship_package

Query = Callable[[SparkSession, str], DataFrame]


def over(operator: Callable[..., DataFrame], *tables: str) -> Query:
    """A query that gives the operator the named tables, whole."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return operator(*(read(spark, sf_dir, t) for t in tables))

    return query


QUERIES: dict[str, Query] = {
    "op1_line_dedup": over(line_dedup.line_report, "documents"),
    "op2_simhash_near_dedup": over(simhash.report, "documents"),
    "op3_warc": over(warc.report, "pages"),
    "op4_decontamination": over(decontaminate.report, "documents", "benchmark"),
    "op5_packing": over(packing.packed, "documents"),
    "op6_quality_rules": over(quality_rules.report, "documents", "labels"),
    "op7_quality_classifier": over(quality_classifier.report, "documents", "labels"),
    "op8_lm_scoring": over(lm_scoring.report, "documents", "labels"),
    "op9_chat_format": over(chat_format.report, "conversations"),
    "op10_substring_dedup": over(substring_dedup.report, "documents"),
    "op11_prefix_trie": over(prefix_trie.report, "conversations"),
    "op12_lexical_search": over(lexical_search.report, "documents", "benchmark"),
    "op13_neighbours": over(neighbours.report, "embeddings"),
}

ORACLE: dict[str, str] = {
    "op1_line_dedup": line_dedup.ORACLE,
    "op3_warc": warc.ORACLE,
    "op4_decontamination": decontaminate.ORACLE,
    "op9_chat_format": chat_format.ORACLE,
    "op11_prefix_trie": prefix_trie.ORACLE,
    "op12_lexical_search": lexical_search.ORACLE,
}
