"""The driver's tables as domain tables. Nothing is cut, sampled or filtered: every row and every whole text takes part."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ids import NS_CLEAN, NS_RAW, uuid5
from ..operators.ordered import ranked
from ..operators.scratch import shared_folder  # noqa: F401

#: A small rule set whose words occur in the invented prose; order and weights matter as in real rules.
RULES = {
    "sudden_event": (100.0, ["trash", "thing in", "Tion was", "réeux", "ción de la"]),
    "mass_event": (95.0, ["moron", "the and attion", "der ist", "une an"]),
    "police_stability": (92.0, ["idiot", "token", "que para"]),
    "livelihood_sensitive": (75.0, ["with the", "keit", "elle", "mente"]),
    "cyber_fraud": (85.0, ["stupid", "disgusting", "worthless", "als das"]),
    "other": (30.0, []),
}
ANALYSED_CATEGORY = {"toxic": "cyber_fraud"}
REF = "2024-01-11 00:00:00"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def raw_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as keyword-search items: the title is the first line's 120 characters, as for items without a title."""
    d = table(spark, sf, "documents")
    published = F.timestamp_seconds(F.lit(1704067200) + (F.col("doc_id") % 240) * 3600)
    return d.select(
        uuid5(NS_RAW, F.concat(F.lit("doc:"), F.col("doc_id").cast("string"))).alias("id"), "doc_id", F.lit("keyword_search").alias("source_type"), F.col("source").alias("platform"),
        F.concat(F.lit("doc:"), F.col("doc_id").cast("string")).alias("external_id"), F.substring("text", 1, 120).alias("title"), F.col("text").alias("content"),
        F.when(F.col("doc_id") % 17 != 0, published).alias("published_at"), F.timestamp_seconds(F.lit(1704931200) + F.col("doc_id") % 3600).alias("collected_at"), "lang",
    )


def raw_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Pages as trending items: the host is the platform, ranked by page id."""
    p = table(spark, sf, "pages").withColumn("host", F.lower(F.regexp_extract("url", "^[a-zA-Z]+://([^/:?#]+)", 1)))
    return ranked(p, ["host"], ["page_id"]).withColumn("rank", F.col("rank").cast("int"))


def comments(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "conversations")
    return c.select(
        F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("id"), F.concat(F.lit("doc:"), F.col("conv_id").cast("string")).alias("note_external_id"), "conv_id", "turn",
        F.col("text").alias("content"), (F.length("text") % 100).cast("long").alias("like_count"), F.timestamp_seconds(F.lit(1704067200) + F.col("conv_id") * 60 + F.col("turn")).alias("published_at"), F.col("role").alias("author_name"),
    )


def clean(raw: DataFrame) -> DataFrame:
    return raw.withColumn("clean_item_id", uuid5(NS_CLEAN, F.concat(F.lit("clean:"), "id")))


def analyses(spark: SparkSession, sf: str) -> DataFrame:
    """Labels as the answers of a language model; a document with a conversation has a sentiment."""
    lab = table(spark, sf, "labels")
    conv = table(spark, sf, "conversations").select(F.col("conv_id").alias("doc_id")).distinct().withColumn("has", F.lit(True))
    x = lab.join(conv, "doc_id", "left")
    return x.select(
        "doc_id", F.when(F.col("toxic") == 1, "cyber_fraud").otherwise("other").alias("llm_category"), F.when(F.col("quality") == 1, 0.9).otherwise(0.4).alias("llm_confidence"),
        (40 * F.col("toxic") + 20 * (1 - F.col("quality")) + F.col("doc_id") % 40).cast("double").alias("risk_score"), F.when(F.col("has"), ((F.col("doc_id") * 7) % 101).cast("double")).alias("sentiment_score"),
    )
