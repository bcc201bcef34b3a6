"""JSON-lines crawl output: contents and comments, with a side output of bad lines."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.ids import NS_RAW, sha256_hex, uuid5
from ..functions.parse import as_int, first_of, parse_count, parse_datetime
from ..operators.ordered import Ranges

VERSION = "jsonl-v1"

# ---- fixed values: the names a field can have, the first that is there wins ----
ALIASES = {
    "title": ("title", "display_title", "name", "subject"),
    "body": ("desc", "description", "content", "text", "excerpt"),
    "external": ("note_id", "note_id_str", "aweme_id", "video_id", "content_id", "post_id", "id"),
    "url": ("note_url", "url", "aweme_url", "video_url", "content_url"),
    "published": ("publish_time", "published_at", "create_time", "create_date_time", "time", "timestamp"),
    "author_id": ("user_id", "author_id", "sec_uid", "uid"),
    "author_name": ("nickname", "author_name", "user_name", "author"),
}
ENGAGEMENT = {
    "like": ("liked_count", "like_count", "digg_count", "voteup_count"),
    "comment": ("comment_count", "comments_count"),
    "share": ("share_count", "shared_count"),
    "read": ("read_count", "view_count", "play_count"),
    "collect": ("collected_count", "collect_count", "favorite_count"),
}
# ---- end of fixed values ----


@dataclass(frozen=True)
class Context:
    """What the task says about every row of its files."""

    task_id: str = "task"
    platform: str = "xhs"
    source_type: str = "keyword_search"
    keyword: str | None = None
    keyword_level: int | None = None
    account_config_id: str | None = None
    collected_at: str = "2024-01-01 00:00:00"


def discover(spark: SparkSession, directory: str, comments: bool | None = None) -> DataFrame:
    """(path, modified, size) of `*.jsonl` below a directory, newest first; content or comment files by their names."""
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.jsonl").load(directory)
        files = files.select("path", F.col("modificationTime").alias("modified"), F.col("length").alias("size"))
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], "path string, modified timestamp, size long")
    name = F.lower(F.element_at(F.split("path", "/"), -1))
    is_comment = F.contains(name, F.lit("comment"))
    if comments is True:
        files = files.where(is_comment)
    elif comments is False:
        files = files.where(F.contains(name, F.lit("content")) & ~is_comment)
    return files.orderBy(F.desc("modified"), F.desc("path"))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(path, line_number, line), blank lines left out.

    Files are read by ranges of lines, so a large one has many tasks and none is ever a row. Line numbers are part of item
    ids: lines are numbered inside each range as they stream by, and a range's first number is the sum of the lines of the
    ranges before it in its file, of which there is one row each. Lines end at `\\n`, `\\r` or both only: characters such as
    U+2028 may stand inside JSON strings.
    """
    return numbered(with_place(spark.read.option("recursiveFileLookup", "true").text(path)))


def with_place(raw: DataFrame) -> DataFrame:
    """(path, start, value) of text read by ranges, from files that are there or that land in a stream."""
    return raw.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), "value")


def numbered(raw: DataFrame) -> DataFrame:
    """Lines with a place as (path, line_number, line), blank ones left out; all ranges of a file must be there."""
    schema = "path string, start long, k long, value string"

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, n = None, 0
        for b in batches:
            k = np.empty(b.num_rows, np.int64)
            for i, here in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist())):
                if here != at:
                    at, n = here, 0
                n += 1
                k[i] = n
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(k), b.column(2)], names=["path", "start", "k", "value"])

    own = raw.mapInArrow(number, schema)
    lines = own.groupBy("path", "start").agg(F.max("k").alias("lines"))
    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = lines.select("path", "start", F.coalesce(F.sum("lines").over(before), F.lit(0)).alias("before"))
    found = own.where(F.trim("value") != "").join(offsets, ["path", "start"])
    return found.select("path", (F.col("before") + F.col("k")).cast("int").alias("line_number"), F.col("value").alias("line"))


def parsed(lines: DataFrame) -> DataFrame:
    """Adds `v`, the line as a variant, and `error`, why it can't be used."""
    v = F.try_parse_json("line")
    kind = F.schema_of_variant(F.col("v"))
    return lines.withColumn("v", v).withColumn(
        "error",
        F.when(F.col("v").isNull(), F.lit("invalid JSON")).when(~F.startswith(kind, F.lit("OBJECT")), F.lit("not an object")),
    )


def get(name: str, kind: str = "string") -> Column:
    return F.try_variant_get(F.col("v"), f"$.{name}", kind)


def first(names: tuple[str, ...]) -> Column:
    return first_of(*(get(n) for n in names))


def map_items(rows: DataFrame, ctx: Context) -> DataFrame:
    """Parsed lines as raw items; rows without any title keep an error. Needs path, line_number, line, v, error."""
    body = first(ALIASES["body"])
    title = F.coalesce(first(ALIASES["title"]), F.substring(body, 1, 120))
    found = first(ALIASES["external"])
    external = F.concat(F.lit(ctx.platform + ":"), F.coalesce(found, F.concat(F.lit("hash:"), F.substring(sha256_hex(F.to_json("v")), 1, 20))))
    url = first(ALIASES["url"])
    counts = F.map_from_arrays(F.array(*(F.lit(k) for k in ENGAGEMENT)), F.array(*(parse_count(first(a)) for a in ENGAGEMENT.values())))
    return rows.select(
        "path", "line_number",
        F.coalesce("error", F.when(title.isNull(), F.lit("no title"))).alias("error"),
        uuid5(NS_RAW, F.concat_ws(":", F.lit(ctx.task_id), F.col("line_number").cast("string"), external, title)).alias("id"),
        F.lit(ctx.source_type).alias("source_type"), F.lit(ctx.platform).alias("platform"), external.alias("external_id"), title.alias("title"), body.alias("content"),
        F.when(F.startswith(url, F.lit("http")), url).alias("url"),
        first(ALIASES["author_id"]).alias("author_id"), first(ALIASES["author_name"]).alias("author_name"),
        parse_datetime(first(ALIASES["published"])).alias("published_at"), F.lit(ctx.collected_at).cast("timestamp").alias("collected_at"),
        F.lit(ctx.keyword).cast("string").alias("keyword"), F.lit(ctx.keyword_level).cast("int").alias("keyword_level"), F.lit(ctx.account_config_id).cast("string").alias("account_config_id"),
        F.lit(None).cast("int").alias("rank"), F.lit(None).cast("long").alias("hot_value"),
        F.map_filter(counts, lambda _, n: n.isNotNull()).alias("engagement"), F.col("line").alias("raw_payload"), F.lit(VERSION).alias("parser_version"),
    )


def map_comments(rows: DataFrame, ctx: Context) -> DataFrame:
    """Parsed lines as comments; the comment's id, the note's id and the content must be there."""
    comment, note, content = first(("comment_id",)), first(("note_id", "aweme_id", "video_id", "content_id")), first(("content", "text"))
    return rows.select(
        "path", "line_number",
        F.coalesce("error", F.when(comment.isNull() | note.isNull() | content.isNull(), F.lit("comment_id, note_id and content are needed"))).alias("error"),
        uuid5(NS_RAW, F.concat_ws(":", F.lit("comment"), F.lit(ctx.task_id), F.col("line_number").cast("string"), note, comment)).alias("id"),
        F.lit(ctx.task_id).alias("task_id"), F.lit(ctx.platform).alias("platform"), F.concat(F.lit(ctx.platform + ":"), note).alias("note_external_id"), comment.alias("comment_external_id"),
        first(("parent_comment_id",)).alias("parent_comment_id"), content.alias("content"), first(ALIASES["author_id"]).alias("author_id"), first(ALIASES["author_name"]).alias("author_name"),
        parse_datetime(first(("create_time", "publish_time", "time"))).alias("published_at"), as_int(first(("like_count", "liked_count", "sub_comment_count"))).alias("like_count"),
        F.lit(ctx.collected_at).cast("timestamp").alias("collected_at"), F.col("line").alias("raw_payload"),
    )


def split_errors(mapped: DataFrame, limit: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(good rows, errors as path, line_number, reason). With a limit, each file ends with its n-th good row."""
    if limit is not None:
        good = F.col("error").isNull().cast("int")
        counted = Ranges(mapped, ["path"], ["line_number"]).running_sum(good, "_n")
        mapped = counted.where(F.col("_n") - good < limit).drop("_n")
    return mapped.where("error is null").drop("error", "path", "line_number"), mapped.where("error is not null").select("path", "line_number", F.col("error").alias("reason"))


def load_items(spark: SparkSession, path: str, ctx: Context, limit: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Items and errors of a content file or folder; a missing one is an error row, not an exception."""
    return _load(spark, path, ctx, limit, map_items)


def load_comments(spark: SparkSession, path: str, ctx: Context, limit: int | None = None) -> tuple[DataFrame, DataFrame]:
    return _load(spark, path, ctx, limit, map_comments)


def _load(spark, path, ctx, limit, mapper):
    try:
        lines = read_lines(spark, path)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        none = spark.createDataFrame([], "path string, line_number int, line string")
        good, _ = split_errors(mapper(parsed(none), ctx))
        return good, spark.createDataFrame([(path, None, "file not found")], "path string, line_number int, reason string")
    return split_errors(mapper(parsed(lines), ctx), limit)


def count_valid(lines: DataFrame) -> DataFrame:
    """total and valid (complete JSON objects): what a crawl watchdog counts."""
    return parsed(lines).agg(F.count("*").alias("total"), F.count_if(F.col("error").isNull()).alias("valid"))


def initial_state(html: Column) -> Column:
    """The object a page assigns to window.__INITIAL_STATE__, as a variant; null if it isn't one."""
    js = F.regexp_extract(html, r"(?s)window\.__INITIAL_STATE__\s*=\s*(\{.*?\})\s*;?\s*</script>", 1)
    js = F.regexp_replace(js, r"new Set\(\[\s*\]\)", "[]")
    js = F.regexp_replace(js, r"new Map\(\[\s*\]\)", "{}")
    js = F.regexp_replace(js, r"(?<=[:\[,])\s*(?:undefined|NaN|-?Infinity)(?=\s*[,}\]])", "null")
    return F.try_parse_json(js)
