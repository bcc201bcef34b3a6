"""Groups of equal texts stay in one shard where they fit one."""

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF
from tests.llm.test_llm import check_shards, prose
from tidemark.llm import sharding


def test_moderate_groups_stay_whole(spark):
    rows = [(k, prose(k, 60)) for k in range(2400)]
    rows += [(10_000 * (g + 1) + k, prose(5000 + g, 60)) for g in range(40) for k in range(4 + g)]
    rows += [(900_000 + k, prose(9000, 60)) for k in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    check_shards(sharding.shard(df), rows, 0.02)
    shard = {r.doc_id: r.shard for r in sharding.shard(df).collect()}
    where = defaultdict(set)
    for i, t in rows:
        where[t].add(shard[i])
    big = where.pop(prose(9000, 60))
    assert len(big) == 24  # several shards' bytes
    assert all(len(s) == 1 for s in where.values())


def test_copies_of_documents_stay_together(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    text = {r.doc_id: r.text or "" for r in docs.collect()}
    where, size = defaultdict(set), defaultdict(int)
    for r in sharding.shard(docs).collect():
        where[text[r.doc_id]].add(r.shard)
        size[text[r.doc_id]] += r.size
    mean = sum(size.values()) / 24
    assert all(len(s) == 1 for t, s in where.items() if size[t] < mean / 3)


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_no_group_is_split(spark, sf):
    """None of these tables' groups of copies is larger than a shard."""
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").select("doc_id", F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("text"))
    whole = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    placed = sharding.shard(whole).select("doc_id", "shard").join(docs, "doc_id").groupBy("text").agg(F.count("*").alias("n"), F.countDistinct("shard").alias("shards"))
    assert placed.where("n > 1").count() > 20 and placed.where("shards > 1").count() == 0


def test_tokens_are_words(spark):
    rows = [(1, " a  b\tc\n\nd "), (2, ""), (3, None), (4, "one")]
    got = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.tokens) for r in got) == [(1, 4), (2, 0), (3, 0), (4, 1)]


def test_a_group_of_one_id_is_split_too(spark):
    """A third of all rows with one text and one id, or none, exceed a shard: they must not be one cell."""
    import zlib

    rows = [(None if k % 2 else 7, "the same words " * 40) for k in range(400)] + [(k, f"text {k} " * 25) for k in range(800)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sharding.shard(docs, shards=6).collect()
    sizes = [sum(r.size for r in got if r.shard == s) for s in range(6)]
    assert len(got) == len(rows) and max(sizes) < 1.1 * sum(sizes) / 6
    assert sorted((r.doc_id or 0, r.text_crc32) for r in got) == sorted((d or 0, zlib.crc32(t.encode())) for d, t in rows)
    for s in range(6):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
