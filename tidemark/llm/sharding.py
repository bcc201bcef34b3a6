"""Vector bin packing: shards that balance bytes, tokens and rows together."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Table, batch, map_batches


def place(vectors: np.ndarray, shards: int, weights: np.ndarray, total: np.ndarray | None = None, left: np.ndarray | None = None, whole: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Shard of each vector, and the residual capacity: the largest first, each where its dot product with the residual is highest.

    Vectors are scaled to shares of a shard of `total` (their own sum by default), residuals may go below zero, and ties
    go to the lower shard. With `whole` only shards that a vector fits into are asked, and one that fits none gets -1.
    """
    total = vectors.sum(0) if total is None else total
    share = vectors / np.where(total > 0, total / shards, 1) * np.sqrt(weights)
    left = np.tile(np.where(total > 0, np.sqrt(weights), 0), (shards, 1)) if left is None else left.copy()
    out = np.zeros(len(vectors), np.int64)
    for i in np.lexsort((np.arange(len(share)), -(share**2).sum(1))):
        product = left @ share[i]
        if whole:
            product[(left < share[i] - 1e-9).any(1)] = -np.inf
        best = int(product.argmax())
        out[i] = -1 if product[best] == -np.inf else best
        if out[i] >= 0:
            left[best] -= share[i]
    return out, left


def shard(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shards: int = 24,
    overhead: int = 8,
    cells_per_shard: int = 256,
    weights: tuple[float, float, float] = (8.0, 1.0, 1.0),
) -> DataFrame:
    """doc_id, size (UTF-8 bytes and `overhead`), text_crc32, tokens, shard, slot (gapless from 0 in each shard).

    Groups of equal texts are dealt by their digest into shards x cells_per_shard cells, and only the cells' sums of
    bytes, tokens (words) and rows, a number that doesn't depend on the corpus, come to the driver to be packed. A group
    that would outweigh a cell by four, of which there are at most shards x cells_per_shard / 4, is a vector of its own and
    placed whole, before the cells; only one that fits no shard's residual capacity is split by a hash of its rows' numbers into
    parts of a cell's size. Slots are counted per task and offset by the counts of the tasks
    before, so no shard is ever sorted or held by one task.

    Null texts are empty ones of their own group. A null id is a row like any other; repeated rows are each placed. An
    empty table gives no rows. Other columns are ignored.
    """
    spark = docs.sparkSession
    cells = shards * cells_per_shard
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    features = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (F.octet_length(text) + overhead).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("tokens"),
        F.unhex(F.md5(text.cast("binary"))).alias("group"),
        F.monotonically_increasing_id().alias("row"),  # written with the table, so it stays what it is
    )
    table = Table(features, "shard-features")
    f = table.df
    total = np.array([x or 0 for x in f.agg(F.sum("size"), F.sum("tokens"), F.count("*")).first()], float)
    limit = max(1, 4 * int(total[0]) // cells)
    large = f.groupBy("group").agg(F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"), F.count("*").alias("n")).where(F.col("bytes") > limit).orderBy("group").collect()  # at most cells / 4
    vectors, w = np.array([[r.bytes, r.tokens, r.n] for r in large], float).reshape(-1, 3), np.array(weights)
    own, left = place(vectors, shards, w, total, whole=True)
    parts = np.ceil(vectors[:, 0] * cells / max(1, total[0])).astype(np.int64)
    rows = [(bytearray(r.group), None, int(s)) if s >= 0 else (bytearray(r.group), int(p), None) for r, p, s in zip(large, parts, own)]
    hot = spark.createDataFrame(rows, "group binary, parts long, own int")
    part = F.when(F.col("parts").isNull(), 0).otherwise(F.pmod(F.xxhash64("row"), F.col("parts")))
    # cells from `cells` on are the shards of groups that are placed already
    cell = F.coalesce(F.col("own") + F.lit(cells), F.pmod(F.xxhash64("group", part), F.lit(cells)).cast("int"))
    celled = f.join(F.broadcast(hot), "group", "left").withColumn("cell", cell).drop("parts", "own", "group", "row")
    sums = celled.where(F.col("cell") < cells).groupBy("cell").agg(F.sum("size"), F.sum("tokens"), F.count("*")).collect()
    found, _ = place(np.array([[r[1], r[2], r[3]] for r in sums], float).reshape(-1, 3), shards, w, total, left)
    of_cell = spark.createDataFrame([(r[0], int(s)) for r, s in zip(sums, found)] + [(cells + s, s) for s in range(shards)], "cell int, shard int")
    schema = pa.schema([("doc_id", pa.int64()), ("size", pa.int64()), ("text_crc32", pa.int64()), ("tokens", pa.int64()), ("shard", pa.int32()), ("task", pa.int32()), ("rank", pa.int64())])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, task = np.zeros(shards, np.int64), TaskContext.get().partitionId()
        for b in batches:
            s = b.column(4).to_numpy(zero_copy_only=False)
            order = np.argsort(s, kind="stable")
            count = np.bincount(s, minlength=shards)
            rank = np.empty(len(s), np.int64)
            rank[order] = np.arange(len(s)) - np.repeat(np.cumsum(count) - count, count)
            yield batch(schema, *b.columns, np.full(len(s), task, np.int32), rank + seen[s])
            seen += count

    numbered = Table(map_batches(celled.join(F.broadcast(of_cell), "cell").select("doc_id", "size", "text_crc32", "tokens", "shard"), number, "doc_id long, size long, text_crc32 long, tokens long, shard int, task int, rank long"), "shard-ranks")
    counts = numbered.df.groupBy("shard", "task").agg(F.count("*").alias("n"))
    from pyspark.sql import Window

    before = counts.select("shard", "task", (F.sum("n").over(Window.partitionBy("shard").orderBy("task")) - F.col("n")).alias("before"))
    table.drop()
    return numbered.df.join(before, ["shard", "task"]).select("doc_id", "size", "text_crc32", "tokens", "shard", (F.col("before") + F.col("rank")).alias("slot"))
