"""Queries over the language-model operators, and the SQL each is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.llm import conversations, packing, pii, quality, tokens
from threadloom.session import materialise, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql is not None:
            ORACLE[name] = sql
        return f

    return add


@query("p7_ids")
def p7_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.encode(table(spark, sf_dir, "documents"))


@query("p7_round_trip", "SELECT doc_id, coalesce(text, '') AS text FROM documents")
def p7_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text decoded from its tokens."""
    return tokens.decode(tokens.encode(table(spark, sf_dir, "documents")))


def _statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = quality.common_word_list(table(spark, sf_dir, "common_words"))
    return quality.statistics(table(spark, sf_dir, "documents"), words)


@query("p9_found")
def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _statistics(spark, sf_dir).where("kind <> 'prose'").select("doc_id", "kind")


@query("p9_statistics")
def p9_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All statistics and the rules that each document fails."""
    return _statistics(spark, sf_dir).withColumn("failures", F.array_join("failures", ","))


@query("p6_found")
def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "chat_events"))


@query("p6_redacted")
def p6_redacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text and name with placeholders."""
    return pii.redacted(table(spark, sf_dir, "chat_events").select("row_id", "text", "name"))


@query("p4_found")
def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.conversations(table(spark, sf_dir, "chat_events"), table(spark, sf_dir, "chat_groups"))


@query("p4_alternation")
def p4_alternation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether user and bot take turns in each kept conversation."""
    found = conversations.spoken(table(spark, sf_dir, "chat_events"), table(spark, sf_dir, "chat_groups"))
    return conversations.alternation(materialise(found, "spoken"))


@query("p8_packed")
def p8_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@query("p8_utilisation")
def p8_utilisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.utilisation(packing.pack(table(spark, sf_dir, "documents")))
