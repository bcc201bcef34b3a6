"""The functions for SQL: registered by name in a session."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf

from ..sources import hotsearch
from . import text


@udtf(returnType="place int, feature string, hash string", useArrow=True)
class TextFeatures:
    """A row for each feature of a text that its SimHash is made of, with the 64 bits it votes with."""

    def eval(self, value: str) -> Iterator[tuple]:
        import hashlib

        normal = text.normalized(value)
        if normal:
            features = normal.split(" ") + [normal[i : i + 3] for i in range(max(1, len(normal) - 2))]
            for k, f in enumerate(features):
                yield k, f, hashlib.sha256(f.encode()).digest()[:8].hex()


@udtf(returnType="rank int, title string, url string, hot string, content string", useArrow=True)
class HotSearch:
    """The items of a saved trending page; a page without any has no rows."""

    def eval(self, platform: str, body: str) -> Iterator[tuple]:
        try:
            for x in hotsearch.parse(platform, body):
                yield x[:5]
        except hotsearch.ParseError:
            return


def register(spark: SparkSession) -> list[str]:
    """normalize_text(s), simhash64(s) of normalised text, text_features(s) and hot_search(platform, body) for spark.sql."""
    spark.udf.register("normalize_text", text.normalize_text)
    spark.udf.register("simhash64", text.simhash64_arrow)
    spark.udtf.register("text_features", TextFeatures)
    spark.udtf.register("hot_search", HotSearch)
    return ["normalize_text", "simhash64", "text_features", "hot_search"]
