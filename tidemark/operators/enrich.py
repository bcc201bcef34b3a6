"""Structured language-model tasks: request rows, a pluggable client, validated answers, an audit row for every item."""

from __future__ import annotations

import hashlib
import json
import re
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import CATEGORIES

TASKS = ("classification", "geo_extraction", "risk_assessment", "sentiment_analysis")
RETRYABLE = {408, 425, 429, 500, 502, 503, 504}

#: Built-in prompts; a folder of <task>.md files can replace them.
PROMPTS = {
    "classification": "## System\nClassify the item into one of the given categories and say how sure you are.\n\n## User Payload\n{{PAYLOAD_JSON}}\n",
    "geo_extraction": "## System\nList the places the item is about, with the words that show it.\n\n## User Payload\n{{PAYLOAD_JSON}}\n",
    "risk_assessment": "## System\nRate the public risk of the item from 0 to 100 and give the reason in one sentence.\n\n## User Payload\n{{PAYLOAD_JSON}}\n",
    "sentiment_analysis": "## System\nSay which sentiment prevails in the comments, its strength from 0 to 100, and the share of each.\n\n## User Payload\n{{PAYLOAD_JSON}}\n",
}


def load_prompt(task: str, folder: str = "") -> tuple[str, str]:
    """The prompt and a version of twelve digits."""
    text = Path(folder, f"{task}.md").read_text(encoding="utf-8") if folder else PROMPTS[task]
    return text, hashlib.sha256(text.encode()).hexdigest()[:12]


def system_part(prompt: str) -> str:
    m = re.search(r"^##?\s*System\s*\n(.*?)(?=^##?\s|\Z)", prompt, re.S | re.M)
    return m[1].strip() if m else ""


def user_part(prompt: str, payload: str) -> str:
    m = re.search(r"^##?\s*User Payload\s*\n(.*)\Z", prompt, re.S | re.M)
    return (m[1] if m else prompt).replace("{{PAYLOAD_JSON}}", payload).strip()


def schemas(sentiments: list[str]) -> dict[str, dict]:
    obj = lambda **p: {"type": "object", "properties": p, "required": list(p), "additionalProperties": False}
    num = lambda a, z: {"type": "number", "minimum": a, "maximum": z}
    s = {"type": "string"}
    return {
        "classification": obj(category={"type": "string", "enum": list(CATEGORIES)}, confidence=num(0, 1), reason=s),
        "geo_extraction": obj(locations={"type": "array", "items": obj(name=s, level=s, confidence=num(0, 1), evidence=s)}),
        "risk_assessment": obj(risk_score=num(0, 100), risk_reason=s),
        "sentiment_analysis": obj(dominant={"type": "string", "enum": sentiments}, score=num(0, 100), distribution=obj(**{k: num(0, 1) for k in sentiments})),
    }


def strict_problems(schema: dict, path: str = "$") -> list[str]:
    """Why a schema isn't a strict one."""
    out, kind = [], schema.get("type")
    if kind == "object":
        props = schema.get("properties") or {}
        if schema.get("additionalProperties") is not False:
            out.append(f"{path}: additionalProperties must be false")
        if not props:
            out.append(f"{path}: no properties")
        if sorted(schema.get("required", [])) != sorted(props):
            out.append(f"{path}: all properties must be required")
        for k, v in props.items():
            out += strict_problems(v, f"{path}.{k}")
    elif kind == "array":
        out += strict_problems(schema["items"], f"{path}[]") if "items" in schema else [f"{path}: no items"]
    return out


def conforms(value, schema: dict) -> bool:
    """Whether an answer follows its schema: types, ranges, enumerations, and all keys and no others."""
    kind = schema.get("type")
    if kind == "object":
        return isinstance(value, dict) and set(value) == set(schema["properties"]) and all(conforms(value[k], s) for k, s in schema["properties"].items())
    if kind == "array":
        return isinstance(value, list) and all(conforms(v, schema["items"]) for v in value)
    if kind == "number":
        return isinstance(value, (int, float)) and not isinstance(value, bool) and schema.get("minimum", value) <= value <= schema.get("maximum", value)
    return isinstance(value, str) and value in schema.get("enum", [value])


# ---- requests, as a frame ----
def comment_lists(comments: DataFrame, limit: int = 100) -> DataFrame:
    """(clean_item_id, comments): the first of each item by time and id, undated ones first."""
    w = Window.partitionBy("clean_item_id").orderBy(F.asc_nulls_first("published_at"), "id")
    first = comments.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= limit)
    one = F.struct(F.col("_rn"), F.struct("content", "like_count", F.date_format("published_at", "yyyy-MM-dd'T'HH:mm:ss").alias("published_at")).alias("c"))
    return first.groupBy("clean_item_id").agg(F.transform(F.array_sort(F.collect_list(one)), lambda x: x["c"]).alias("comments"))


def item_payload(cols: list[str]) -> Column:
    return F.to_json(F.struct(*(F.col(c) for c in sorted(cols))), {"ignoreNullFields": "false"})


def requests(items: DataFrame, comments: DataFrame | None, limit: int = 100, payload_cols: list[str] | None = None) -> DataFrame:
    """(clean_item_id, task, payload): three tasks for every item, sentiment only where there are comments."""
    cols = payload_cols or [c for c in ("title", "content", "platform", "published_at", "category", "confidence") if c in items.columns]
    base = items.select("clean_item_id", item_payload(cols).alias("payload"))
    out = base.select("clean_item_id", F.explode(F.array(*(F.lit(t) for t in TASKS[:3]))).alias("task"), "payload")
    if comments is not None:
        c = comment_lists(comments, limit).join(base, "clean_item_id").select("clean_item_id", F.lit(TASKS[3]).alias("task"), F.to_json(F.struct("comments"), {"ignoreNullFields": "false"}).alias("payload"))
        out = out.unionByName(c)
    return out


# ---- the client ----
class ClientError(RuntimeError):
    def __init__(self, message: str, tries: int = 0):
        super().__init__(message)
        self.tries = tries


@dataclass
class Answer:
    data: dict
    usage: dict = field(default_factory=dict)
    tries: int = 1


def parse_fenced(text: str) -> dict:
    m = re.match(r"^```[A-Za-z]*\s*(.*?)\s*```$", text.strip(), re.S)
    data = json.loads(m[1] if m else text)
    if not isinstance(data, dict):
        raise ValueError("not an object")
    return data


def response_text(r: dict) -> str:
    """The text of a response; incomplete, refused and failed ones are errors."""
    if r.get("status") not in (None, "completed"):
        raise ClientError(f"response {r.get('status')}: {(r.get('incomplete_details') or {}).get('reason') or (r.get('error') or {}).get('message') or ''}")
    if isinstance(r.get("output_text"), str) and r["output_text"]:
        return r["output_text"]
    parts = [p for o in r.get("output") or [] if o.get("type") == "message" for p in o.get("content") or []]
    if any(p.get("type") == "refusal" for p in parts):
        raise ClientError("refused")
    text = "".join(p.get("text") or "" for p in parts if p.get("type") in ("output_text", "text"))
    if not text:
        raise ClientError("empty response")
    return text


def usage_of(r: dict) -> dict:
    u = r.get("usage") or {}
    a, b = u.get("input_tokens", u.get("prompt_tokens")) or 0, u.get("output_tokens", u.get("completion_tokens")) or 0
    return {"input_tokens": a, "output_tokens": b, "total_tokens": u.get("total_tokens") or a + b}


class Client:
    """POST /responses through an injectable transport (url, headers, body) -> (status, text). It is never used unless given."""

    def __init__(self, transport: Callable[[str, dict, dict], tuple[int, str]], base_url: str = "", model: str = "", key: str = "", temperature: float = 0.1, max_output_tokens: int = 2000, max_retries: int = 2, structured: bool = True, sleep: Callable[[float], None] = time.sleep):
        self.transport, self.base_url, self.model, self.key = transport, base_url.rstrip("/"), model, key
        self.temperature, self.max_output_tokens, self.max_retries, self.structured, self.sleep = temperature, max_output_tokens, max_retries, structured, sleep

    def __call__(self, task: str, system: str, user: str, schema: dict) -> Answer:
        if self.structured and (bad := strict_problems(schema)):
            raise ClientError("; ".join(bad))
        form = {"type": "json_schema", "name": task, "strict": True, "schema": schema} if self.structured else {"type": "json_object"}
        body = {"model": self.model, "temperature": self.temperature, "max_output_tokens": self.max_output_tokens, "input": [{"role": "system", "content": system}, {"role": "user", "content": user}], "text": {"format": form}}
        last = ""
        for k in range(1, 2 + self.max_retries):
            try:
                status, text = self.transport(f"{self.base_url}/responses", {"Authorization": f"Bearer {self.key}", "Content-Type": "application/json"}, body)
            except OSError as e:
                last = str(e)
            else:
                if status < 300:
                    r = json.loads(text)
                    try:
                        return Answer(parse_fenced(response_text(r)), usage_of(r), k)
                    except ValueError as e:
                        raise ClientError(f"not JSON: {e}", k) from e
                last = f"status {status}"
                if status not in RETRYABLE:
                    raise ClientError(last, k)
            if k <= self.max_retries:
                self.sleep(0.1 * k)
        raise ClientError(last, 1 + self.max_retries)


NO_SENTIMENT = {"dominant": "unknown", "score": 0.0, "distribution": {}}
RESULT = (
    "clean_item_id string, ok boolean, category string, confidence double, risk_score double, risk_reason string, geo array<struct<name:string,level:string,confidence:double,evidence:string>>, "
    "sentiment struct<dominant:string,score:double,distribution:map<string,double>>, attempts int, error string, input_tokens long, output_tokens long, total_tokens long, digest string"
)


def analyse(reqs: DataFrame, client: Callable[[str, str, str, dict], Answer], sentiments: list[str], prompt_dir: str = "") -> DataFrame:
    """A row per item: the combined answer if all tasks gave a valid one, and the audit columns in any case.

    An item's few requests are gathered in one row and asked for one after the other; items run in parallel. The calls of
    an item whose task is run again are made again, unless the client is a `journal.Remembered` one.
    """
    prompts = {t: load_prompt(t, prompt_dir)[0] for t in TASKS}
    forms = schemas(sentiments)
    grouped = reqs.groupBy("clean_item_id").agg(F.sort_array(F.collect_list(F.struct("task", "payload"))).alias("tasks"))

    def one(item: str, tasks) -> dict:
        calls = [(t["task"], user_part(prompts[t["task"]], t["payload"])) for t in tasks]
        out = {"clean_item_id": item, "ok": False, "attempts": 0, "error": None, "input_tokens": 0, "output_tokens": 0, "total_tokens": 0, "digest": hashlib.sha256(json.dumps(calls, ensure_ascii=False).encode()).hexdigest()}
        got: dict[str, dict] = {}
        try:
            for task, user in calls:
                a = client(task, system_part(prompts[task]), user, forms[task])
                out["attempts"] += a.tries
                for k in ("input_tokens", "output_tokens", "total_tokens"):
                    out[k] += int(a.usage.get(k) or 0)
                if not conforms(a.data, forms[task]):
                    raise ClientError(f"{task}: the answer doesn't follow its schema")
                got[task] = a.data
        except Exception as e:  # every failure becomes an audit row
            out["attempts"] += getattr(e, "tries", 0)
            out["error"] = str(e) or type(e).__name__
            return out
        c, r = got["classification"], got["risk_assessment"]
        return out | {"ok": True, "category": c["category"], "confidence": float(c["confidence"]), "risk_score": float(r["risk_score"]), "risk_reason": r["risk_reason"], "geo": got["geo_extraction"]["locations"], "sentiment": got.get("sentiment_analysis", NO_SENTIMENT)}

    names = [x.split()[0] for x in re.split(r", (?![^<]*>)", RESULT)]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = [one(i, t) for i, t in zip(f["clean_item_id"], f["tasks"])]
            yield pd.DataFrame({n: pd.Series([r.get(n) for r in rows], dtype=object) for n in names})

    return grouped.mapInPandas(run, RESULT)


def stand_in(task: str, system: str, user: str, schema: dict) -> Answer:
    """A rule-based client for tests and dry runs: the same answer to the same request, no network."""
    h = int(hashlib.sha256(user.encode()).hexdigest()[:8], 16)
    if task == "classification":
        data = {"category": CATEGORIES[h % len(CATEGORIES)], "confidence": 0.9 if h % 3 else 0.4, "reason": "by rule"}
    elif task == "geo_extraction":
        data = {"locations": []}
    elif task == "risk_assessment":
        data = {"risk_score": float(h % 101), "risk_reason": "by rule"}
    else:
        names = list(schema["properties"]["distribution"]["properties"])
        data = {"dominant": names[h % len(names)], "score": float(h % 101), "distribution": {k: float(k == names[h % len(names)]) for k in names}}
    return Answer(data, {"input_tokens": len(user), "output_tokens": 10, "total_tokens": len(user) + 10})
