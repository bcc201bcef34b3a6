"""Tables that lazy results read are dropped when the caller says so, and bit maps let through all that they must."""

from pyspark.sql import functions as F

from tests.llm.test_llm import prose
from tidemark.llm import common, quality


def test_release(spark):
    df = spark.createDataFrame([(k, prose(k, 40)) for k in range(6)], "doc_id long, text string")
    out = quality.quality(df)
    assert out.count() == 6
    paths = list(common._kept)
    fs = lambda p: spark._jvm.org.apache.hadoop.fs.Path(p).getFileSystem(spark._jsc.hadoopConfiguration())
    exists = lambda p: fs(p).exists(spark._jvm.org.apache.hadoop.fs.Path(p))
    assert paths and all(map(exists, paths))
    assert common.release() == len(paths) and not any(map(exists, paths)) and not common._kept


def test_may_be_among(spark):
    keys = spark.range(0, 3000, 7).withColumnRenamed("id", "k")
    found = spark.range(3000).where(common.may_be_among(F.col("id"), keys)).join(keys, F.col("id") == F.col("k"), "left")
    r = found.agg(F.count("k").alias("there"), F.count("*").alias("all")).first()
    assert r.there == 429 and r["all"] < 450
    assert spark.range(50).where(common.may_be_among(F.col("id"), keys.limit(0))).count() == 0
