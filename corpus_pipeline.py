"""A training-corpus pipeline: quality rules, near duplicates, benchmark decontamination, secrets, packing.

Every stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept; all but the last return the
columns of documents, in any order of rows. Three of them read each row and keep, change or drop it where it is. Only the
near-duplicate stage compares rows: it knows them by 128 bits of all their columns, so null ids, ids that repeat with other
texts and rows that differ in any column are decided one by one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontam, jaccard, packing, quality, secrets
from tidemark.llm.common import Table, may_be_among, read_table
from tidemark.llm.queries import PACK_VOCABULARY, SCAN_VOCABULARY

#: Names that no column of documents has: a text's key, a second one that tells whether the first is one text's, and a row's.
TEXT, OTHER, ROW, ROW2 = "__tidemark_text__", "__tidemark_other__", "__tidemark_row__", "__tidemark_row2__"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go; so do null and empty texts, which have no words. Repeated rows stay or go together."""
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group that links of five-word shingles and similarity 0.8 or more connect, the row of the least id stays.

    Null ids come last, and of rows with one id in a group that with the least row key stays. Rows that repeat in all columns
    are one. Rows without words (null, empty and blank texts) are groups of their own and stay, each that differs. So a text
    is lost only to a row of its group: ids that repeat with unlike texts, and rows without an id, cost nothing. An empty
    table stays empty. Texts that share 64 bits by chance are told by 64 more, and stay.

    Only rows that may have to go, or repeat, are shuffled with their texts; the others stay where they are.
    """
    cols = [F.col(f"`{c}`") for c in docs.columns]
    null = [c.isNull() for c in cols]  # a hash passes over nulls
    d = docs.withColumn(TEXT, F.xxhash64("text")).withColumn(OTHER, F.xxhash64(F.lit(1), F.reverse("text")))
    d = d.withColumn(ROW, F.xxhash64(*cols, *null)).withColumn(ROW2, F.xxhash64(*null, *reversed(cols)))
    groups = jaccard.jaccard_components(d.select(TEXT, "text"), id_col=TEXT).select(F.col("doc_id").alias(TEXT), F.when(F.col("n_shingles") > 0, F.col("component_id")).alias("group"))
    ids = Table(d.groupBy(TEXT, OTHER, ROW, ROW2).agg(F.first("doc_id").alias("doc_id"), F.count("*").alias("times")), "row-ids")
    # a key of unlike texts, or of texts with and without words, is no group
    sure = groups.groupBy(TEXT).agg(F.min("group").alias("group"), (F.count_distinct("group") + F.max(F.col("group").isNull().cast("int"))).alias("n")).where("n = 1")
    alike = ids.df.groupBy(TEXT).agg((F.min(OTHER) == F.max(OTHER)).alias("alike")).where("alike").select(TEXT)
    rows = Table(ids.df.join(sure.join(alike, TEXT).select(TEXT, "group"), TEXT, "left"), "row-groups")
    ids.drop()
    least = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", ROW, ROW2)).alias("first")
    kept = rows.df.where("group is not null").groupBy("group").agg(least).select(F.col(f"first.{ROW}").alias(ROW), F.col(f"first.{ROW2}").alias(ROW2))
    kept = Table(kept.unionByName(rows.df.where("group is null").select(ROW, ROW2)), "survivors")
    doubtful = rows.df.join(kept.df, [ROW, ROW2], "left_anti").select(ROW).unionByName(rows.df.where("times > 1").select(ROW))
    maybe = d.withColumn("__tidemark_maybe__", may_be_among(F.col(ROW), doubtful))
    judged = maybe.where("__tidemark_maybe__").join(kept.df, [ROW, ROW2], "left_semi").dropDuplicates([ROW, ROW2])
    rows.drop()
    return maybe.where("not __tidemark_maybe__").unionByName(judged.select(maybe.columns)).select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten consecutive words of a benchmark item, or a shorter item whole, go. Null and empty texts stay."""
    return decontam.keep_clean(docs, read_table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by [SECRET], and n_chars follows; every row stays, null and empty texts as they are."""
    return secrets.redact(docs, SCAN_VOCABULARY, length_col="n_chars")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of 2048-token sequences, with their token ids. A null text is an empty one: one end token."""
    return packing.pack(docs, PACK_VOCABULARY)


STAGES = [("quality_rules", quality_rules), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("secret_scan", secret_scan), ("packing", pack)]

#: Expectation-maximisation and the packing order can't be said in SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    previous = None
    for name, stage in STAGES[:-1]:
        table = Table(stage(spark, docs, sf_dir), f"stage-{name}")
        if previous is not None:
            previous.drop()
        previous, docs = table, table.df
    return STAGES[-1][1](spark, docs, sf_dir)
