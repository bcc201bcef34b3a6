"""Risk: six components, each 0 to 100 with its evidence, a weighted sum, and an alert level."""

from __future__ import annotations

import hashlib
import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Config

RANKS, REFERENCE = 50, 1_000_000


def round4(c: Column) -> Column:
    return F.floor(c * 10_000 + 0.5) / 10_000


def clamp(c: Column, low: float = 0.0, high: float = 100.0) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), c))


def lookup(table: dict[str, float], key: Column, default: Column | None = None) -> Column:
    """A configuration table as an expression: no join."""
    out = None
    for k, v in table.items():
        out = F.when(key == k, float(v)) if out is None else out.when(key == k, float(v))
    out = F.lit(None).cast("double") if out is None else out
    return out if default is None else F.coalesce(out, default)


def keyword_score(cfg: Config, category: Column, confidence: Column) -> Column:
    return clamp(lookup({k: c.weight for k, c in cfg.rules.items()}, category, F.lit(0.0)) * confidence)


def source_score(cfg: Config, source_type: Column, account: Column) -> Column:
    s = cfg.scoring
    return clamp(F.when(source_type == "account", lookup(s.account_weights, account, F.lit(s.source_ordinary))).when(source_type == "keyword_search", F.lit(s.source_ordinary)).otherwise(F.lit(s.source_default)))


def heat_score(cfg: Config, rank: Column, platform: Column, total: Column) -> Column:
    """0.6 of the rank's worth and 0.4 of the engagement's if ranked, else the engagement's."""
    eng = F.when(total > 0, clamp(100 * F.log10(1 + total.cast("double")) / math.log10(1 + REFERENCE))).otherwise(0.0)
    base = clamp(100 * (1 - (rank - 1) / RANKS))
    worth = base * lookup(cfg.scoring.top_rank_weights, platform, F.lit(100.0)) / 100
    return clamp(F.when(rank.isNotNull(), 0.6 * worth + 0.4 * eng).otherwise(eng))


def sentiment_score(score: Column) -> Column:
    """Scores in (0, 1] are shares; a missing one is nought."""
    return clamp(F.when(score.isNull(), 0.0).when((score > 0) & (score <= 1), score * 100).otherwise(score))


def alert_level(cfg: Config, score: Column) -> Column:
    out = None
    for name, least in sorted(cfg.scoring.thresholds.items(), key=lambda x: -x[1]):
        out = F.when(score >= least, name) if out is None else out.when(score >= least, name)
    return out.otherwise("archive")


def review_reasons(cfg: Config, confidence: Column, rule_category: Column, llm_category: Column, sentiment: Column) -> Column:
    return F.array_compact(F.array(
        F.when(confidence < cfg.scoring.manual_review_confidence, "low_confidence"),
        F.when(rule_category != llm_category, "category_conflict"),
        F.when(sentiment.isNull(), "missing_sentiment"),
    ))


def evidence(sources: DataFrame, raw: DataFrame) -> DataFrame:
    """Per clean item: the highest engagement or heat of its raw items, the best rank, the first ranked one's platform, its first source."""
    from .relational import engagement_total

    r = sources.join(raw.select(F.col("id").alias("raw_item_id"), "platform", "rank", "hot_value", "engagement", "source_type", "account_config_id"), "raw_item_id")
    ranked = F.when(F.col("rank").isNotNull(), F.col("pos"))
    return r.groupBy("clean_item_id").agg(
        F.greatest(F.max(engagement_total(F.col("engagement"))), F.max("hot_value"), F.lit(0)).alias("interaction_total"), F.min("rank").alias("best_rank"),
        F.min_by("platform", ranked).alias("ranked_platform"), F.min_by("source_type", "pos").alias("source_type"), F.min_by("account_config_id", "pos").alias("account_config_id"),
    )


def score(items: DataFrame, cfg: Config) -> DataFrame:
    """Adds components (a struct of six, each score, weight and weighted), overall_score, alert_level, category_conflict, review_reasons, final_category.

    Needs rule_category, rule_confidence, llm_category, llm_confidence, risk_score, sentiment_score (or null), source_type,
    account_config_id, best_rank, ranked_platform, interaction_total. One select: nothing is shuffled. With analysis_item_id
    beside clean_item_id, a row in which they differ fails the query.
    """
    if "analysis_item_id" in items.columns:  # an answer that is another item's must not be scored
        wrong = F.concat(F.lit("the analysis of "), F.coalesce(F.col("analysis_item_id").cast("string"), F.lit("nothing")), F.lit(" stands with item "), F.col("clean_item_id").cast("string"))
        items = items.withColumn("clean_item_id", F.when(F.col("clean_item_id").eqNullSafe(F.col("analysis_item_id")), F.col("clean_item_id")).otherwise(F.raise_error(wrong).cast(items.schema["clean_item_id"].dataType)))
    weights = {k: c.weight for k, c in cfg.rules.items()}
    parts = {
        "keyword_category": keyword_score(cfg, F.col("rule_category"), F.col("rule_confidence")),
        "source": source_score(cfg, F.col("source_type"), F.col("account_config_id")),
        "heat": heat_score(cfg, F.col("best_rank"), F.col("ranked_platform"), F.col("interaction_total")),
        "llm_category": clamp(lookup(weights, F.col("llm_category"), F.lit(0.0)) * F.col("llm_confidence")),
        "sentiment": sentiment_score(F.col("sentiment_score")),
        "llm_risk": clamp(F.col("risk_score").cast("double")),
    }
    one = lambda c, w: F.struct(round4(c).alias("score"), F.lit(w).alias("weight"), round4(c * w).alias("weighted"))
    out = items.withColumn("components", F.struct(*(one(c, cfg.scoring.weights[k]).alias(k) for k, c in parts.items())))
    out = out.withColumn("overall_score", round4(sum((F.col(f"components.{k}.weighted") for k in parts), F.lit(0.0))))
    reasons = review_reasons(cfg, F.col("llm_confidence"), F.col("rule_category"), F.col("llm_category"), F.col("sentiment_score"))
    out = out.withColumn("alert_level", alert_level(cfg, F.col("overall_score"))).withColumn("category_conflict", F.col("rule_category") != F.col("llm_category")).withColumn("review_reasons", reasons)
    return out.withColumn("requires_manual_review", F.size("review_reasons") > 0).withColumn("final_category", F.col("llm_category"))


def fingerprint(cfg: Config) -> str:
    """Twelve digits that change when anything the score depends on does."""
    import dataclasses

    data = {"rules": {k: dataclasses.asdict(v) for k, v in cfg.rules.items()}, "scoring": dataclasses.asdict(cfg.scoring), "sentiment": cfg.analysis.sentiment_weights, "ranks": RANKS, "reference": REFERENCE}
    return hashlib.sha256(json.dumps(data, sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode()).hexdigest()[:12]
