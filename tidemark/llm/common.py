"""Shared helpers of the training-data operators: shared tables, Arrow batches, word splitting and link components."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows and bytes an Arrow batch holds; texts can be long, so batches are short.
ARROW_ROWS, ARROW_BYTES = 1000, 8 << 20

#: Every byte but space, tab and the line breaks ends no word: `bytes.split()` is the rule `[^\\x20\\x09-\\x0D]+`.
WHITE = b" \t\n\r\x0b\x0c"


def shared_root(spark: SparkSession) -> str:
    """The folder all executors share, read from the session. Only a local session may do without: it gets a folder of its own."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir is not set: on a cluster, tables between steps need a folder that all executors share")
        root = getattr(spark, "_tidemark_shared", None)
        if root is None:
            folder = tempfile.mkdtemp(prefix="tidemark-")
            atexit.register(shutil.rmtree, folder, ignore_errors=True)
            root = spark._tidemark_shared = f"file://{folder}"
    return root.rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    return f"{shared_root(spark)}/tidemark-{name}-{uuid.uuid4().hex}"


#: Tables of this process that haven't been dropped, by path.
_kept: dict[str, Table] = {}


def release() -> int:
    """Drops every table that this process's operators have left for results that read them; how many there were.

    An operator drops what it has used up. What it returns is lazy and still reads its last tables, so only the caller can
    know when those results have been written: call this then.
    """
    tables = list(_kept.values())
    for t in tables:
        t.drop()
    return len(tables)


class Table:
    """A frame written as Parquet to the shared folder, so that lineage ends there and lost executors cost no recomputation."""

    def __init__(self, df: DataFrame, name: str, compression: str = "zstd"):
        self.spark = df.sparkSession
        self.path = shared_path(self.spark, name)
        _kept[self.path] = self
        df.write.option("compression", compression).parquet(self.path)
        self.df = self.spark.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        _kept.pop(self.path, None)
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | T.StructType) -> DataFrame:
    """mapInArrow with batches short enough for very long texts: the session's limits are set for that, as there is no other way."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    return df.mapInArrow(fn, schema)


def texts(column: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a string column, without decoding."""
    return column.cast(pa.binary()).to_pylist()


def batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema)


def passed(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch]) -> DataFrame:
    """Every batch of all columns through `fn`, which filters it or replaces columns: nothing is joined or shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield fn(b)

    return map_batches(df, run, df.schema)


def replaced(b: pa.RecordBatch, **columns) -> pa.RecordBatch:
    """The batch with columns of other values, of the types they had."""
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else b.column(k) for k, f in enumerate(b.schema)], schema=b.schema)


def may_be_among(column: Column, keys: DataFrame, bits: int = 26) -> Column:
    """False only where the value of `column` is surely none of the one column of `keys`.

    Keys set bits, by hash, of a map of 2 to the `bits`, whatever their number: what may be among them can then be shuffled
    and joined, and all other rows stay where they are. The map only fills up, and lets more pass, as keys become more.
    """
    spark = keys.sparkSession
    at = lambda c: F.pmod(F.xxhash64(c), F.lit(1 << bits))
    own = F.col(keys.columns[0])
    words = keys.select(F.shiftright(at(own), 5).cast("int").alias("w"), F.lit(1).cast("long").alias("one"), F.pmod(at(own), F.lit(32)).cast("int").alias("k"))
    words = words.groupBy("w").agg(F.bit_or(F.expr("shiftleft(one, k)")).alias("b")).toArrow()
    table = np.zeros(1 << (bits - 5), np.uint32)
    table[words.column(0).to_numpy()] = words.column(1).to_numpy().astype(np.uint32)
    sent = spark.sparkContext.broadcast(table)

    @F.pandas_udf(T.BooleanType())
    def there(h: pd.Series) -> pd.Series:
        x = h.to_numpy()
        return pd.Series((sent.value[x >> 5] >> (x & 31).astype(np.uint32)) & 1 == 1)

    return there(at(column))


def components(edges: DataFrame, checkpoint_name: str = "cc") -> DataFrame:
    """Connected components of (a, b) links: returns (node, component), component being the least node reached.

    Alternates large-star and small-star steps, so a chain of n links takes about log n rounds. A node's links are aggregated
    to their minimum, combined before the shuffle; the minimum, one row a node, is then joined back to the links, where a node
    with very many of them is a skewed key that Spark's adaptive join splits. Rows with a null end are left out; loops only
    make their node known. Each round is a table in the shared folder.
    """
    e = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).where("u is not null and v is not null")
    nodes = e.select(F.col("u").alias("node")).union(e.select("v")).distinct()
    cur = Table(e.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), checkpoint_name)
    start = Table(nodes, checkpoint_name + "-nodes")
    state = None
    while True:
        # large star: every larger neighbour of a node is linked to the node's least neighbour (or itself)
        both = cur.df.unionByName(cur.df.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small star: a node and its smaller neighbours are linked to the least of them
        small_min = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(small_min, "u")
            .select(F.explode(F.array(F.col("u"), F.col("v"))).alias("u"), F.col("m").alias("v"))
            .where("u <> v").distinct()
        )
        nxt = Table(small, checkpoint_name)
        new = nxt.df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        cur.drop()
        cur = nxt
        if new == state:
            break
        state = new
    return start.df.join(cur.df.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("m")), "node", "left").select("node", F.coalesce("m", "node").alias("component"))
