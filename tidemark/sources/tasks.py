"""Crawl tasks: the cross product of configuration, and the command that runs one outside Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Config
from ..functions.ids import NS_TASK, uuid5
from ..functions.parse import level_number


def plan(targets: DataFrame, platforms: DataFrame) -> DataFrame:
    """Tasks of (source_type, target, level) times (platform); ids follow from their parts.

    Both sides are configuration: a few hundred rows at most, whatever the data's size.
    """
    t = targets.crossJoin(F.broadcast(platforms))
    name = F.concat_ws(":", F.lit("crawler"), "platform", "source_type", "target", F.col("level").cast("string"))
    return t.select(uuid5(NS_TASK, name).alias("task_id"), "platform", "source_type", "target", "level")


def from_config(spark: SparkSession, cfg: Config) -> DataFrame:
    words = [("keyword_search", w, name, k) for k, (name, ws) in enumerate(sorted(cfg.collect.keyword_levels.items()), 1) for w in ws]
    t = spark.createDataFrame(words, "source_type string, target string, name string, ordinal int").select("source_type", "target", level_number(F.col("name"), F.col("ordinal")).alias("level"))
    out = plan(t, spark.createDataFrame([(p,) for p in cfg.collect.crawl_platforms], "platform string"))
    accounts = spark.createDataFrame([("account", a, None, p) for a, p in cfg.collect.accounts.items()], "source_type string, target string, level int, platform string")
    name = F.concat_ws(":", F.lit("crawler"), "platform", "source_type", "target", F.lit("account"))
    return out.unionByName(accounts.select(uuid5(NS_TASK, name).alias("task_id"), "platform", "source_type", "target", "level"))


def command(task: dict, python: str = "python", entrypoint: str = "main.py", output: str = "data", max_items: int = 50, max_comments: int = 100) -> list[str]:
    """The crawler's argument list; it is never given to a shell."""
    kind = "search" if task["source_type"] == "keyword_search" else "creator"
    target = ["--keywords", task["target"]] if kind == "search" else ["--creator_id", task["target"]]
    return [python, entrypoint, "--platform", task["platform"], "--type", kind, *target, "--save_data_option", "jsonl", "--save_data_path", output, "--max_items", str(max_items), "--max_comments", str(max_comments)]
