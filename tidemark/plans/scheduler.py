"""Interval scheduling: a catalog of sources, due ones run side by side, then one downstream run."""

from __future__ import annotations

import random
import time
from collections.abc import Callable
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from concurrent.futures import TimeoutError as Late
from dataclasses import dataclass, field
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Config
from ..operators.stopping import Work


def catalog(spark: SparkSession, cfg: Config) -> DataFrame:
    """source_key, kind, interval_seconds, jitter_min_seconds, jitter_max_seconds: configuration, a few rows."""
    return spark.createDataFrame(sources(cfg), "source_key string, kind string, interval_seconds int, jitter_min_seconds int, jitter_max_seconds int")


def sources(cfg: Config) -> list[tuple]:
    s = cfg.scheduler
    row = lambda key, kind, i: (key, kind, i.interval_seconds, i.jitter_min_seconds, i.jitter_max_seconds)
    out = [row(f"hotsearch:{p}", "hotsearch", s.hotsearch) for p in cfg.collect.hot_platforms]
    out += [row(f"keyword:{k}", "keyword", s.keyword) for k, words in cfg.collect.keyword_levels.items() if words]
    return out + [row(f"account:{a}", "account", s.account) for a in cfg.collect.accounts]


def catalog_of(platforms: DataFrame, keywords: DataFrame, accounts: DataFrame, cfg: Config) -> DataFrame:
    """The same catalog for sources that are tables: platforms (name), keywords (name, words: how many) and accounts (name).

    Nothing passes through the driver; keywords without words are no source.
    """
    s = cfg.scheduler

    def rows(names: DataFrame, kind: str, i) -> DataFrame:
        number = lambda n: F.lit(n).cast("int")
        return names.select(F.concat(F.lit(f"{kind}:"), "name").alias("source_key"), F.lit(kind).alias("kind"), number(i.interval_seconds).alias("interval_seconds"), number(i.jitter_min_seconds).alias("jitter_min_seconds"), number(i.jitter_max_seconds).alias("jitter_max_seconds"))

    return rows(platforms, "hotsearch", s.hotsearch).unionByName(rows(keywords.where("words > 0"), "keyword", s.keyword)).unionByName(rows(accounts, "account", s.account))


def next_run(completed: Column, interval: Column, jitter_min: Column, jitter_max: Column, seed: int | None = None) -> Column:
    u = F.rand(seed) if seed is not None else F.rand()
    return completed + F.make_interval(secs=interval + jitter_min + u * (jitter_max - jitter_min))


def fold(statuses: list[str]) -> str:
    return "failed" if "failed" in statuses else "partial" if "partial" in statuses else "succeeded"


@dataclass
class Cycle:
    status: str
    runs: list[dict] = field(default_factory=list)
    downstream: dict | None = None
    idle_seconds: float = 0.0


def run_cycle(
    cfg: Config, state: dict[str, datetime], now: datetime, collect: Callable[[str], str], downstream: Callable[[], dict], rng: random.Random | None = None, clock: Callable[[], datetime] | None = None,
    spark: SparkSession | None = None, downstream_timeout: float | None = None,
) -> Cycle:
    """One cycle. state: source key to next run, advanced in place even when a source fails.

    Sources are driver threads (each submits its own Spark jobs), as many at a time as configured. One that exceeds its time is
    a failure and is stopped: its jobs are interrupted by their tag, and a commit that it tries later is refused. The
    downstream run has a limit too (that of a source, unless another is given). A source's time runs from its own start.
    """
    if not cfg.scheduler.enabled:
        return Cycle("skipped")
    rows = sources(cfg)
    rng, clock = rng or random.Random(), clock or (lambda: now)
    ready = [r for r in rows if r[0] not in state or state[r[0]] <= now]
    idle = lambda: max(0.0, min(((state[r[0]] - clock()).total_seconds() for r in rows if r[0] in state), default=0.0))
    if not ready:
        return Cycle("idle", idle_seconds=idle())
    limit, runs = cfg.scheduler.task_timeout_seconds, []
    waiting, busy = list(ready), {}
    pool = ThreadPoolExecutor(len(ready) + 1)  # threads of stopped work may end late: they take nobody's place

    def begin(name: str, f: Callable) -> tuple:
        work = Work(name, spark)

        def go():
            with work.running():
                return f()

        return pool.submit(go), work, time.monotonic()

    def done(row: tuple, status: str, error: str | None) -> None:
        key, kind, interval, lo, hi = row
        at = clock()
        state[key] = at + timedelta(seconds=interval + rng.uniform(lo, hi))
        runs.append({"source_key": key, "kind": kind, "status": status, "error": error, "completed_at": at})

    try:
        while waiting or busy:
            while waiting and len(busy) < cfg.scheduler.max_concurrent_tasks:
                row = waiting.pop(0)
                busy[row] = begin(row[0], lambda key=row[0]: collect(key))
            left = min(began + limit - time.monotonic() for _, _, began in busy.values())
            wait([f for f, _, _ in busy.values()], max(0.0, left), FIRST_COMPLETED)
            for row, (f, work, began) in list(busy.items()):
                if f.done():
                    done(row, "failed" if f.exception() else f.result(), str(f.exception()) if f.exception() else None)
                elif time.monotonic() - began >= limit:
                    work.stop()
                    done(row, "failed", "timed out")
                else:
                    continue
                del busy[row]
        f, work, _ = begin("downstream", downstream)
        try:
            after = f.result(limit if downstream_timeout is None else downstream_timeout)
        except Late:
            work.stop()
            after = {"status": "failed", "error": "timed out"}
        except Exception as e:
            after = {"status": "failed", "error": str(e)}
    finally:
        for _, work, _ in busy.values():
            work.stop()
        pool.shutdown(wait=False, cancel_futures=True)
    return Cycle(fold([r["status"] for r in runs] + [after["status"]]), runs, after, idle())
