"""Events: projection, redacted payloads, a guarded webhook sink, and the delivery ledger."""

from __future__ import annotations

import hashlib
import json
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ids import NS_EVENT, uuid5
from ..functions.text import CLIP, inline_text, redact_pii, redact_value
from ..functions.urls import public_url

RETRYABLE = {408, 425, 429, 500, 502, 503, 504}
LABELS = {"red": "红色 - 立即处置", "orange": "橙色 - 关注核实", "blue": "蓝色 - 记录归档", "archive": "归档"}


def fixed2(c: Column) -> Column:
    """Two places after the point; null stays null."""
    return F.when(c.isNotNull(), F.format_string("%.2f", c.cast("double")))


def project_events(assessments: DataFrame) -> DataFrame:
    """Assessments as events: ids follow from the clean item's, so a rerun makes the same event."""
    shown = F.when(F.col("sentiment_dominant").isNotNull(), F.concat("sentiment_dominant", F.lit("，情感分 "), fixed2(F.col("sentiment_score")), F.lit("。")))
    return assessments.select(
        uuid5(NS_EVENT, F.concat(F.lit("event:"), "clean_item_id")).alias("event_id"), F.col("clean_item_id").alias("trace_id"), "clean_item_id", "title", "alert_level", "overall_score",
        F.col("final_category").alias("category"), F.col("risk_reason").alias("summary"), shown.alias("sentiment_summary"), "review_reasons", "url",
    )


def markdown(trigger: str, title: Column, level: Column, score: Column, category: Column, summary: Column, sentiment: Column, url: Column, reasons: Column, as_they_are: tuple[str, ...] = ()) -> Column:
    """A short report; sections without content are left out. Numbers of persons are redacted, but in sections `as_they_are` ("标题" is the first line)."""
    shown = lambda name, c: inline_text(c) if name in as_they_are else redact_pii(inline_text(c))
    line = lambda name, c: F.when(c.isNotNull() & (c != ""), F.concat(F.lit(f"- **{name}**: "), shown(name, c)))
    bullets = F.when(F.size(reasons) > 0, F.concat(F.lit("### 复核\n"), F.array_join(F.transform(reasons, lambda r: F.concat(F.lit("- "), r)), "\n")))
    parts = F.array(
        F.concat(F.lit(f"## {trigger} "), shown("标题", F.coalesce(title, F.lit("")))),
        line("等级", level), line("分数", fixed2(score)), line("类别", category), line("摘要", summary), line("情感", sentiment), line("链接", url), bullets,
    )
    return F.substring(F.array_join(F.array_compact(parts), "\n"), 1, CLIP)


def payloads(events: DataFrame, trigger: str = "舆情预警") -> DataFrame:
    """Adds payload (compact JSON, keys in order, redacted) and payload_hash."""
    text = lambda c: redact_pii(inline_text(F.col(c)))
    body = F.struct(
        F.col("category").alias("category"), F.col("event_id").alias("event_id"), F.col("alert_level").alias("level"),
        markdown(trigger, *(F.col(c) for c in ("title", "alert_level", "overall_score", "category", "summary", "sentiment_summary", "url", "review_reasons"))).alias("markdown"),
        F.col("review_reasons").alias("review_reasons"), fixed2(F.col("overall_score")).alias("score"), text("sentiment_summary").alias("sentiment"), text("summary").alias("summary"), text("title").alias("title"), F.col("trace_id").alias("trace_id"), F.lit(trigger).alias("trigger"),
    )
    return events.withColumn("payload", F.to_json(body, {"ignoreNullFields": "false"})).withColumn("payload_hash", F.sha2("payload", 256))


def payload_of(event: dict, trigger: str) -> tuple[str, str]:
    """The same for one event with nested evidence."""
    body = json.dumps(redact_value(event | {"trigger": trigger}), ensure_ascii=False, sort_keys=True, separators=(",", ":"))
    return body, hashlib.sha256(body.encode()).hexdigest()


def body_problem(body: Column) -> Column:
    """What a 2xx answer's body says against success; null if nothing."""
    t = F.lower(F.trim(F.coalesce(body, F.lit(""))))
    v = F.try_parse_json(body)
    num = lambda k: F.try_variant_get(v, f"$.{k}", "double")
    status = F.lower(F.try_variant_get(v, "$.status", "string"))
    return (
        F.when(t == "", F.lit(None).cast("string"))
        .when(v.isNull(), F.when(t.isin("ok", "success"), F.lit(None).cast("string")).otherwise("not JSON"))
        .when(num("errcode") != 0, "errcode").when(num("code") != 0, "code")
        .when(~F.try_variant_get(v, "$.success", "boolean"), "success").when(status.isin("fail", "failed", "error"), "status")
    )


def body_problem_py(text: str) -> str | None:
    t = text.strip()
    if not t:
        return None
    try:
        v = json.loads(t)
    except ValueError:
        return None if t.lower() in ("ok", "success") else "not JSON"
    if not isinstance(v, dict):
        return None
    for k in ("errcode", "code"):
        if isinstance(v.get(k), (int, float)) and v[k] != 0:
            return k
    if v.get("success") is False:
        return "success"
    return "status" if str(v.get("status")).lower() in ("fail", "failed", "error") else None


class _NoRedirect(urllib.request.HTTPRedirectHandler):
    def redirect_request(self, *args, **kwargs):
        return None


def http_post(url: str, body: bytes, timeout: float) -> tuple[int, str]:
    req = urllib.request.Request(url, body, {"Content-Type": "application/json; charset=utf-8"})
    try:
        with urllib.request.build_opener(_NoRedirect).open(req, timeout=timeout) as r:
            return r.status, r.read().decode("utf-8", "replace")
    except urllib.error.HTTPError as e:
        return e.code, e.read().decode("utf-8", "replace")


def post(url: str, body: str, transport: Callable[[str, bytes, float], tuple[int, str]] = http_post, max_retries: int = 3, backoff: float = 5.0, timeout: float = 15.0, resolve=None, sleep: Callable[[float], None] = time.sleep) -> dict:
    """One delivery: {status, http_tries, response, error}. Placeholder and private addresses are refused before any call."""
    if not url or "example.invalid" in url or "<" in url or "${" in url:
        return {"status": "failed", "http_tries": 0, "response": None, "error": "no webhook address"}
    if not public_url(url, resolve):
        return {"status": "failed", "http_tries": 0, "response": None, "error": "not a public address"}
    error, text, k = "", None, 0
    for k in range(1, 2 + max_retries):
        if k > 1:
            sleep(backoff)
        try:
            status, text = transport(url, body.encode(), timeout)
        except OSError as e:
            error = str(e)
            continue
        if 200 <= status < 300:
            error = body_problem_py(text) or ""
            break
        error = f"status {status}"
        if status not in RETRYABLE:
            break
    return {"status": "failed" if error else "succeeded", "http_tries": k, "response": None if text is None else text[:CLIP], "error": error or None}


ATTEMPT = "event_id string, status string, http_tries int, response string, error string, payload_hash string"


def deliver(events: DataFrame, sender: Callable[[str], dict] | None = None, journal=None) -> DataFrame:
    """An attempt row per event of payloads(); without a sender it is a dry run.

    With a journal (events then have attempt_number) an attempt is claimed before it is sent and its outcome noted after, so a task
    that runs again sends nothing twice; an attempt whose outcome nobody noted is `unknown`. Without one a task that runs
    again sends again.
    """
    more = ["attempt_number"] if "attempt_number" in events.columns else []
    if sender is None:
        return events.select("event_id", F.lit("dry_run").alias("status"), F.lit(0).alias("http_tries"), F.lit(None).cast("string").alias("response"), F.lit(None).cast("string").alias("error"), "payload_hash", *more)
    from .journal import digest, once

    send = None if journal is None else once(sender, journal)
    number = F.col("attempt_number").cast("int") if more else F.lit(None).cast("int")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for e, p, h, n in zip(f["event_id"], f["payload"], f["payload_hash"], f["number"]):
                r = sender(p) if send is None else send(digest(e, int(n), h), p)
                rows.append((e, r["status"], r["http_tries"], r["response"], r["error"], h, n))
            yield pd.DataFrame(rows, columns=["event_id", "status", "http_tries", "response", "error", "payload_hash", "attempt_number"])

    sent = events.select("event_id", "payload", "payload_hash", number.alias("number")).mapInPandas(run, ATTEMPT + ", attempt_number int")
    return sent if more else sent.drop("attempt_number")


def number_attempts(new: DataFrame, deliveries: DataFrame) -> DataFrame:
    """attempt_number: one more than the event had."""
    return new.join(deliveries.select("event_id", F.col("attempt_count").alias("_n")), "event_id", "left").withColumn("attempt_number", F.coalesce("_n", F.lit(0)) + 1).drop("_n")


def merge_deliveries(attempts: DataFrame, deliveries: DataFrame) -> DataFrame:
    """The delivery rows after these attempts: a dry run never takes back a success."""
    d = deliveries.select("event_id", F.col("status").alias("_s"), F.col("payload_hash").alias("_h"))
    a = attempts.join(d, "event_id", "left")
    keep = (F.col("status") == "dry_run") & (F.col("_s") == "succeeded")
    return a.select("event_id", F.when(keep, F.col("_s")).otherwise(F.col("status")).alias("status"), F.col("attempt_number").alias("attempt_count"), F.when(keep, F.col("_h")).otherwise(F.col("payload_hash")).alias("payload_hash"), "error")
