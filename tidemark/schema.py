"""Typed tables of the engine, as DDL."""

from __future__ import annotations

HOT_PLATFORMS = ("weibo", "baidu", "zhihu", "douyin", "bilibili")
CRAWL_PLATFORMS = ("xhs", "dy", "ks", "bili", "wb", "tieba", "zhihu")
CATEGORIES = ("sudden_event", "mass_event", "police_stability", "livelihood_sensitive", "cyber_fraud", "other")
LEVELS = ("red", "orange", "blue", "archive")
SOURCE_TYPES = ("hotsearch", "keyword_search", "account")
STAGES = ("hotsearch", "crawler", "processing", "analysis", "scoring", "output")

RAW_ITEM = (
    "id string not null, source_type string not null, platform string not null, external_id string, title string not null, content string, url string, "
    "author_id string, author_name string, published_at timestamp, collected_at timestamp not null, keyword string, keyword_level int, account_config_id string, "
    "rank int, hot_value long, engagement map<string,long>, raw_payload string, parser_version string"
)
COMMENT = (
    "id string not null, task_id string, platform string, note_external_id string not null, comment_external_id string not null, parent_comment_id string, "
    "content string not null, author_id string, author_name string, published_at timestamp, like_count long, collected_at timestamp, raw_payload string"
)
CLEAN_ITEM = (
    "id string not null, raw_item_id string not null, platform string, external_id string, title string not null, content string, canonical_url string, url_hash string, "
    "title_hash string, content_hash string, simhash string, published_at timestamp, collected_at timestamp, category string, confidence double, reason string"
)
DECISION = ("raw_item_id string not null, outcome string not null, reason string, details string, duplicate_of string")
GEO = "array<struct<name:string,level:string,confidence:double,evidence:string>>"
SENTIMENT = "struct<dominant:string,score:double,distribution:map<string,double>>"
ANALYSIS = (
    f"clean_item_id string not null, category string, confidence double, risk_score double, risk_reason string, geo {GEO}, sentiment {SENTIMENT}, input_tokens long, output_tokens long, total_tokens long, digest string"
)
AUDIT = ("clean_item_id string not null, succeeded boolean, attempts int, error string, input_tokens long, output_tokens long, total_tokens long, digest string")

#: Key columns by table, for upserts and integrity checks.
KEYS = {
    "tasks": ["task_id"], "raw_items": ["id"], "crawler_runs": ["task_id", "started_at"], "clean_items": ["id"], "clean_item_sources": ["clean_item_id", "raw_item_id"],
    "comments": ["id"], "processing_runs": ["id"], "decisions": ["raw_item_id"], "audits": ["clean_item_id", "created_at"], "analyses": ["clean_item_id"],
    "assessments": ["clean_item_id"], "events": ["event_id"], "deliveries": ["event_id"], "attempts": ["event_id", "attempt_number"], "intents": ["event_id", "attempt_number"], "scheduler_state": ["source_key"], "scheduler_runs": ["id"],
}

#: Tables that are read by parts: columns, and those that their folders are named by.
PARTITIONED = {
    "anchor_signatures": ("key long, n int, simhash string, counts binary, id string, kind int, cell int", ["kind", "cell"]),
    "anchor_bodies": ("id string, source_type string, platform string, external_id string, url_hash string, norm_title string, norm_full string, simhash string, published_at timestamp, collected_at timestamp, cell int", ["cell"]),
}
