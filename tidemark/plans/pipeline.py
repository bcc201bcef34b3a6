"""The engine: six stages over a store, each reading and committing whole tables, so that any run can be repeated."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Config
from ..operators import anchors, emit, enrich, relational, scoring
from ..operators.journal import Journal, Remembered
from ..operators.store import Store
from ..sources import hotsearch, jsonl
from . import cleaning
from .scheduler import fold


@dataclass
class Stage:
    name: str
    status: str
    duration_ms: int = 0
    details: dict = field(default_factory=dict)
    error: str | None = None


@dataclass
class Run:
    status: str
    stages: list[Stage]
    stats: dict[str, int]


class Engine:
    def __init__(self, spark: SparkSession, root: str, cfg: Config | None = None):
        self.spark, self.cfg, self.store = spark, cfg or Config(), Store(spark, root)

    # ---- stages ----
    def hotsearch(self, platforms: list[str], collected_at: str, fetcher: Callable[[str], str], limit: int | None = None, preview: bool = False) -> tuple[str, dict]:
        items, outcomes = hotsearch.collect(self.spark, platforms, collected_at, fetcher)
        if limit is not None:
            items = relational.first_n(items, limit, ["platform"], ["rank"])
        done = {r.platform: r.success for r in outcomes.collect()}
        status = "succeeded" if all(done.values()) else "partial" if any(done.values()) else "failed"
        inserted = None if preview else self.store.append_new("raw_items", items)
        return status, {"platforms": done, "inserted": inserted}

    def ingest(self, path: str, ctx: jsonl.Context, limit: int | None = None, comments: str | None = None) -> tuple[str, dict]:
        items, errors = jsonl.load_items(self.spark, path, ctx, limit)
        out = {"inserted": self.store.append_new("raw_items", items), "failed": errors.count()}
        if comments:
            rows, bad = jsonl.load_comments(self.spark, comments, ctx)
            out |= {"comments_inserted": self.store.append_new("comments", rows), "comments_failed": bad.count()}
        return "succeeded" if not out["failed"] else "partial", out

    def process(self, ref_time: str, run_id: str = "run") -> tuple[str, dict]:
        raw = self.store.read("raw_items")
        if raw is None:
            return "succeeded", {"input_count": 0, "accepted_count": 0, "discarded_count": 0}
        decisions = self.store.read("decisions")
        pending = raw if decisions is None else relational.pending(raw, decisions)
        out = cleaning.run(pending, self._anchors(), self.cfg, F.lit(ref_time).cast("timestamp"), run_id)
        sources = out.sources
        if (old := self.store.read("clean_item_sources")) is not None:  # later sources follow those that are there
            last = old.groupBy("clean_item_id").agg((F.max("pos") + 1).alias("n"))
            sources = sources.join(last, "clean_item_id", "left").select("clean_item_id", "raw_item_id", (F.col("pos") + F.coalesce("n", F.lit(0))).alias("pos"))
        p = self.cfg.processing
        index = {"anchor_signatures": anchors.signatures(out.accepted, p.title_similarity, p.content_similarity), "anchor_bodies": anchors.bodies(out.accepted)}
        self.store.commit({"clean_items": out.accepted, "clean_item_sources": sources, "decisions": out.decisions, "processing_runs": out.run, **index}, append=True)
        n = out.run.first()
        return "succeeded", {"input_count": n.input_count, "accepted_count": n.accepted_count, "discarded_count": n.discarded_count}

    def _anchors(self) -> Callable[[DataFrame], DataFrame] | None:
        """What finds the accepted items beside new ones: by the index, which every run that accepts items adds to."""
        index, texts, p = self.store.read("anchor_signatures"), self.store.read("anchor_bodies"), self.cfg.processing
        if index is None or texts is None:
            return None
        return lambda new: anchors.anchors_for(new, index, texts, p.title_similarity, p.content_similarity)

    def clean_items(self) -> DataFrame | None:
        c = self.store.read("clean_items")
        return None if c is None else c.withColumnRenamed("id", "clean_item_id")

    def _or_empty(self, name: str, schema: str) -> DataFrame:
        df = self.store.read(name)
        return self.spark.createDataFrame([], schema) if df is None else df

    def requests(self, limit: int | None = None) -> DataFrame | None:
        clean = self.clean_items()
        if clean is None:
            return None
        todo = relational.missing(clean, self._or_empty("analyses", "clean_item_id string"), "clean_item_id")
        if limit is not None:
            todo = relational.listed(todo, ["collected_at", "clean_item_id"], limit)
        comments = self.store.read("comments")
        if comments is not None:
            comments = relational.comments_by_item(self.store.read("clean_item_sources"), self.store.read("raw_items"), comments)
        return enrich.requests(todo, comments, self.cfg.analysis.max_input_comments)

    def analyse(self, client, limit: int | None = None) -> tuple[str, dict]:
        reqs = self.requests(limit)
        if reqs is None:
            return "succeeded", {"analysed": 0, "failed": 0}
        sentiments = list(self.cfg.analysis.sentiment_weights)
        from ..operators.dedup import _table

        asked = Remembered(client, Journal(f"{self.store.root}/_answers"), uuid.uuid4().hex)
        rows = _table(enrich.analyse(reqs, asked, sentiments, self.cfg.analysis.prompt_dir).withColumn("created_at", F.current_timestamp()).withColumn("updated_at", F.col("created_at")), "answers")
        audits = rows.select("clean_item_id", F.col("ok").alias("succeeded"), "attempts", "error", "input_tokens", "output_tokens", "total_tokens", "digest", "created_at")
        self.store.commit({"audits": audits}, append=True, upserts={"analyses": rows.where("ok").drop("ok", "error", "attempts")})
        Journal(f"{self.store.root}/_answers").forget()  # what counts is in the tables now; a failed item's answers are asked for again
        n = rows.agg(F.count_if("ok").alias("a"), F.count_if(~F.col("ok")).alias("f")).first()
        return "succeeded" if not n.f else "partial" if n.a else "failed", {"analysed": n.a, "failed": n.f}

    def assessments(self, force: bool = False) -> DataFrame | None:
        clean, analyses = self.clean_items(), self.store.read("analyses")
        if clean is None or analyses is None:
            return None
        done = self.spark.createDataFrame([], "clean_item_id string") if force else self._or_empty("assessments", "clean_item_id string")
        c = clean.select("clean_item_id", "title", F.col("canonical_url").alias("url"), F.col("category").alias("rule_category"), F.col("confidence").alias("rule_confidence"))
        a = analyses.select("clean_item_id", F.col("category").alias("llm_category"), F.col("confidence").alias("llm_confidence"), "risk_score", "risk_reason", F.col("sentiment.dominant").alias("sentiment_dominant"), F.col("sentiment.score").alias("sentiment_score"))
        if self.cfg.scoring.review_when_no_comments:
            a = a.withColumn("sentiment_score", F.when(F.col("sentiment_dominant") != "unknown", F.col("sentiment_score")))
        ready = relational.ready_for_scoring(c, a, done).join(scoring.evidence(self.store.read("clean_item_sources"), self.store.read("raw_items")), "clean_item_id")
        return scoring.score(ready, self.cfg).withColumn("config_fingerprint", F.lit(scoring.fingerprint(self.cfg)))

    def score(self, force: bool = False) -> tuple[str, dict]:
        rows = self.assessments(force)
        if rows is None:
            return "succeeded", {"scored": 0}
        from ..operators.dedup import _table

        rows = _table(rows.withColumn("created_at", F.current_timestamp()).withColumn("updated_at", F.col("created_at")), "scores")
        events = emit.project_events(rows).withColumn("created_at", F.current_timestamp()).withColumn("updated_at", F.col("created_at"))
        self.store.commit({}, upserts={"assessments": rows, "events": events})
        return "succeeded", {"scored": rows.count()}

    def outgoing(self, include_queued: bool = False, force: bool = False) -> DataFrame | None:
        events = self.store.read("events")
        if events is None:
            return None
        open_ = relational.undelivered(events, self._or_empty("deliveries", "event_id string, status string"), force)
        flags = {k: tuple(v) for k, v in self.cfg.output.levels.items()}
        return emit.payloads(relational.select_events(open_, flags, include_queued), self.cfg.output.trigger)

    def output(self, sender: Callable[[str], dict] | None = None, include_queued: bool = False, force: bool = False) -> tuple[str, dict]:
        out = self.outgoing(include_queued, force)
        if out is None:
            return "succeeded", {"attempts": {}}
        from ..operators.dedup import _table

        known = self._or_empty("deliveries", "event_id string, status string, attempt_count int, payload_hash string, error string")
        numbered = _table(emit.number_attempts(out, known), "outgoing")
        if sender is not None:  # what is going to be sent is in the store before anything is
            self.store.append("intents", numbered.select("event_id", "attempt_number", "payload_hash", F.current_timestamp().alias("created_at")))
        notes = Journal(f"{self.store.root}/_deliveries")
        tried = emit.deliver(numbered, sender, notes).withColumn("created_at", F.current_timestamp()).withColumn("updated_at", F.col("created_at"))
        tried = _table(tried, "attempts")
        merged = emit.merge_deliveries(tried, known).withColumn("created_at", F.current_timestamp()).withColumn("updated_at", F.col("created_at"))
        self.store.commit({}, upserts={"attempts": tried, "deliveries": merged})
        if sender is not None:
            notes.forget()
        n = {r.status: r["count"] for r in tried.groupBy("status").count().collect()}
        bad = {"failed", "unknown"} & set(n)
        return "partial" if bad and set(n) - bad else "failed" if bad else "succeeded", {"attempts": n}

    # ---- the whole ----
    def stats(self) -> dict[str, int]:
        from ..schema import KEYS

        tables = {k: df for k in KEYS if (df := self.store.read(k)) is not None}
        return {r.table_name: r.n for r in relational.table_stats(tables).collect()} if tables else {}

    def run(self, steps: dict[str, Callable[[], tuple[str, dict]] | None], fail_fast: bool = False) -> Run:
        """Runs named steps in order; a None is skipped, an exception is a failed stage."""
        done: list[Stage] = []
        for name, step in steps.items():
            if step is None or (fail_fast and any(s.status == "failed" for s in done)):
                done.append(Stage(name, "skipped"))
                continue
            began = time.monotonic()
            try:
                status, details = step()
                error = None
            except Exception as e:
                status, details, error = "failed", {}, str(e)[:500]
            done.append(Stage(name, status, int((time.monotonic() - began) * 1000), details, error))
        return Run(fold([s.status for s in done]), done, self.stats())
