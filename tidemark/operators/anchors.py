"""The index of accepted items: a run reads only the parts that its new items can be adjacent to.

Every item has a signature for its URL, its platform and id, its title's length and its content's length, in cells that partition
the signature table; its texts are in a second table, partitioned by the item. A run's new items name cells (a bounded number, so
they can be literals that prune the scan), signatures narrow them to ids, and ids name the cells of texts.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import hamming
from .similar import CELLS, cells

#: Cells of keys and of items. Lengths have about 20 and 30 cells for every factor of a hundred.
PARTS = 128
URL, EXTERNAL, TITLE, CONTENT = range(4)
BODY = ["id", "source_type", "platform", "external_id", "url_hash", "norm_title", "norm_full", "simhash", "published_at", "collected_at"]


def _part(key: Column) -> Column:
    return F.pmod(key, F.lit(PARTS)).cast("int")


def _width(floor: float) -> float:
    return -math.log(floor / (2 - floor))


def signatures(items: DataFrame, title_min: float = 0.90, content_min: float = 0.88) -> DataFrame:
    """(kind, cell, key, n, simhash, counts, id): up to four rows an item; what is null or empty has none."""
    none = lambda kind: F.lit(None).cast(kind)
    short = lambda kind, key: F.struct(F.lit(kind).alias("kind"), _part(key).alias("cell"), key.alias("key"), none("int").alias("n"), none("string").alias("simhash"), none("binary").alias("counts"))

    @F.pandas_udf("binary")
    def counted(s: pd.Series) -> pd.Series:
        return s.map(lambda t: cells(t or ""))

    def long(kind: int, text: str, floor: float) -> Column:
        n = F.char_length(text)
        return F.struct(F.lit(kind).alias("kind"), F.floor(F.log(n.cast("double")) / _width(floor)).cast("int").alias("cell"), none("bigint").alias("key"), n.cast("int").alias("n"), F.col("simhash").alias("simhash"), F.col(f"_{text}").alias("counts"))

    x = items.select("id", "platform", "external_id", "url_hash", "norm_title", "norm_full", "simhash", counted("norm_title").alias("_norm_title"), counted("norm_full").alias("_norm_full"))
    rows = F.array(
        F.when(F.col("url_hash").isNotNull(), short(URL, F.xxhash64("url_hash"))),
        F.when(F.length("external_id") > 0, short(EXTERNAL, F.xxhash64("platform", "external_id"))),
        F.when(F.length("norm_title") > 0, long(TITLE, "norm_title", title_min)),
        F.when(F.length("norm_full") > 0, long(CONTENT, "norm_full", content_min)),
    )
    return x.select("id", F.explode(F.filter(rows, lambda r: r.isNotNull())).alias("r")).select("r.*", "id")


def bodies(items: DataFrame) -> DataFrame:
    """(cell, and what items are compared by)."""
    return items.select(_part(F.xxhash64("id")).alias("cell"), *BODY)


def _pruned(table: DataFrame, wanted: list[tuple]) -> DataFrame:
    """Rows of the wanted cells, as literals on the partition columns."""
    kinds: dict = {}
    for kind, cell in wanted:
        kinds.setdefault(kind, []).append(cell)
    where = F.lit(False)
    for kind, some in kinds.items():
        inside = F.col("cell").isin(sorted(some))
        where |= inside if kind is None else (F.col("kind") == kind) & inside
    return table.where(where)


def beside(new: DataFrame, index: DataFrame, title_min: float = 0.90, content_min: float = 0.88, gate: int = 22) -> DataFrame:
    """Ids of the index that may be adjacent to a new item: equal keys, or lengths, SimHash and character counts that allow it."""
    mine = signatures(new, title_min, content_min)
    reach = F.when(F.col("kind") >= TITLE, F.array(F.col("cell") - 1, F.col("cell"), F.col("cell") + 1)).otherwise(F.array("cell"))
    mine = mine.select("kind", F.explode(reach).alias("cell"), *(F.col(c).alias(f"m_{c}") for c in ("key", "n", "simhash", "counts")))
    wanted = [(r.kind, r.cell) for r in mine.select("kind", "cell").distinct().collect()]  # 2 * PARTS and the cells of lengths at most
    floor = F.when(F.col("kind") == TITLE, title_min).otherwise(content_min)
    sizes = F.least("n", "m_n") >= floor / (2 - floor) * F.greatest("n", "m_n")

    @F.pandas_udf("boolean")
    def close(x: pd.Series, y: pd.Series, floor: pd.Series) -> pd.Series:
        a, b = (np.frombuffer(b"".join(s), np.int32).reshape(-1, CELLS) for s in (x, y))
        return pd.Series(np.abs(a - b).sum(1) <= (1 - floor.to_numpy()) * (a.sum(1) + b.sum(1)) + 1e-6)

    old = _pruned(index, wanted)
    met = mine.where(F.col("kind") < TITLE).join(old.where(F.col("kind") < TITLE), ["kind", "cell"]).where("key = m_key").select("id")
    like = mine.where(F.col("kind") >= TITLE).join(old.where(F.col("kind") >= TITLE), ["kind", "cell"]).where(sizes & (hamming(F.col("simhash"), F.col("m_simhash")) <= gate))
    return met.unionByName(like.where(close("counts", "m_counts", floor)).select("id")).distinct()


def anchors_for(new: DataFrame, index: DataFrame, texts: DataFrame, title_min: float = 0.90, content_min: float = 0.88, gate: int = 22) -> DataFrame:
    """The accepted items that decide of new ones: the rest is adjacent to none, so decisions are those of a run that reads all."""
    from .scratch import Scratch

    spark = new.sparkSession
    ids = Scratch(spark).table(beside(new, index, title_min, content_min, gate).select("id", _part(F.xxhash64("id")).alias("cell")), "beside", kept=True)
    wanted = [(None, r.cell) for r in ids.select("cell").distinct().collect()]  # PARTS at most
    return _pruned(texts, wanted).join(ids, ["cell", "id"], "left_semi").select(BODY)
