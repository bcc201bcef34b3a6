"""Command line: `python -m tidemark.cli VERB`. Every verb prints JSON; 2 means a bad configuration or failed work."""

from __future__ import annotations

import argparse
import json
import os
import subprocess
import sys
from dataclasses import asdict
from datetime import datetime, timezone

from .config import Config, ConfigError, env_references, load, redacted

VERBS = (
    "validate-config", "show-config", "inspect-env", "collect-hotsearch", "plan-tasks", "load-crawl", "run-crawler", "init-store", "ingest-task", "process-pending",
    "preview-analysis", "run-analysis", "preview-risk", "run-risk", "preview-output", "send-output", "run-pipeline", "run-scheduler",
)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tidemark")
    p.add_argument("verb", choices=VERBS)
    p.add_argument("--config")
    p.add_argument("--env-file")
    p.add_argument("--strict-env", action="store_true")
    p.add_argument("--store", default="")
    p.add_argument("--path", help="crawl output: a file or a folder")
    p.add_argument("--comments")
    p.add_argument("--task-id", default="task")
    p.add_argument("--platform", action="append")
    p.add_argument("--keyword")
    p.add_argument("--limit", type=int)
    p.add_argument("--ref-time")
    p.add_argument("--pages", help="a folder with a page per platform, instead of the network")
    p.add_argument("--execute", action="store_true", help="really call a model, a crawler or a webhook")
    p.add_argument("--include-queued", action="store_true")
    p.add_argument("--force", action="store_true")
    p.add_argument("--fail-fast", action="store_true")
    p.add_argument("--skip", action="append", default=[])
    p.add_argument("--crawler-dir", default=".")
    p.add_argument("--cycles", type=int, default=1)
    return p


def _spark():
    from pyspark.sql import SparkSession

    return SparkSession.builder.appName("tidemark").config("spark.sql.session.timeZone", "UTC").getOrCreate()


def _rows(df, limit: int | None = None) -> list[dict]:
    return [json.loads(x) for x in (df if limit is None else df.limit(limit)).toJSON().take(limit or 1000)]


def _fetcher(pages: str | None):
    from .sources import hotsearch

    if not pages:
        return hotsearch.fetch
    by_url = {hotsearch.URLS[f.split(".")[0]]: os.path.join(pages, f) for f in os.listdir(pages) if f.split(".")[0] in hotsearch.URLS}

    def get(url: str) -> str:
        with open(by_url[url], encoding="utf-8") as f:
            return f.read()

    return get


def _client(cfg: Config, execute: bool):
    from .operators.enrich import Client, stand_in

    if not execute:
        return stand_in
    import urllib.error
    import urllib.request

    def transport(url, headers, body):
        try:
            with urllib.request.urlopen(urllib.request.Request(url, json.dumps(body).encode(), headers), timeout=cfg.analysis.timeout_seconds) as r:
                return r.status, r.read().decode()
        except urllib.error.HTTPError as e:
            return e.code, e.read().decode("utf-8", "replace")

    a = cfg.analysis
    return Client(transport, os.environ.get(a.base_url_env, ""), os.environ.get(a.model_env, ""), os.environ.get(a.api_key_env, ""), a.temperature, a.max_output_tokens, a.max_retries, a.structured_output)


def _sender(cfg: Config, execute: bool):
    if not execute:
        return None
    from .operators.emit import post

    url, o = os.environ.get(cfg.output.webhook_url_env, ""), cfg.output
    return lambda body: post(url, body, max_retries=o.max_retries, backoff=o.backoff_seconds, timeout=o.timeout_seconds)


def run(args: argparse.Namespace) -> tuple[object, bool]:
    """(what to print, whether it worked)."""
    cfg = load(args.config, args.env_file)
    refs = env_references(cfg)
    missing = [r for r in refs if not os.environ.get(r)]
    if args.verb == "validate-config":
        return {"valid": not (args.strict_env and missing), "missing_env": missing}, not (args.strict_env and missing)
    if args.verb == "show-config":
        return redacted(cfg), True
    if args.verb == "inspect-env":
        return {r: r not in missing for r in refs}, not (args.strict_env and missing)
    from .plans import scheduler
    from .plans.pipeline import Engine
    from .sources import hotsearch, jsonl, tasks

    spark = _spark()
    now = args.ref_time or datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
    ctx = jsonl.Context(task_id=args.task_id, platform=(args.platform or ["xhs"])[0], keyword=args.keyword, collected_at=now)
    if args.verb == "plan-tasks":
        return _rows(tasks.from_config(spark, cfg)), True
    if args.verb == "load-crawl":
        items, errors = jsonl.load_items(spark, args.path, ctx, args.limit)
        return {"loaded": items.count(), "errors": _rows(errors)}, errors.where("line_number is null").count() == 0
    if args.verb == "run-crawler":
        plan = [tasks.command(r.asDict()) for r in tasks.from_config(spark, cfg).limit(args.limit or 1).collect()]
        if not args.execute:
            return {"commands": plan, "status": "skipped"}, True
        codes = [subprocess.run(c, cwd=args.crawler_dir, timeout=cfg.scheduler.task_timeout_seconds).returncode for c in plan]
        return {"commands": plan, "exit_codes": codes}, not any(codes)
    if args.verb == "collect-hotsearch" and not args.store:
        items, outcomes = hotsearch.collect(spark, args.platform or cfg.collect.hot_platforms, now, _fetcher(args.pages))
        if args.limit is not None:
            from .operators.relational import first_n

            items = first_n(items, args.limit, ["platform"], ["rank"])
        out = _rows(outcomes)
        return {"items": _rows(items), "outcomes": out}, any(o["success"] for o in out)
    engine = Engine(spark, args.store or cfg.store or "tidemark-store", cfg)
    if args.verb == "init-store":
        return engine.stats(), True
    if args.verb in ("preview-analysis", "preview-risk", "preview-output"):
        df = {"preview-analysis": lambda: engine.requests(args.limit), "preview-risk": lambda: engine.assessments(args.force), "preview-output": lambda: engine.outgoing(args.include_queued, args.force)}[args.verb]()
        return [] if df is None else _rows(df, args.limit or 1), True
    steps = {
        "hotsearch": lambda: engine.hotsearch(args.platform or cfg.collect.hot_platforms, now, _fetcher(args.pages), args.limit),
        "crawler": (lambda: engine.ingest(args.path, ctx, args.limit, args.comments)) if args.path else None,
        "processing": lambda: engine.process(now, f"run-{now}"),
        "analysis": lambda: engine.analyse(_client(cfg, args.execute), args.limit),
        "scoring": lambda: engine.score(args.force),
        "output": lambda: engine.output(_sender(cfg, args.execute), args.include_queued, args.force),
    }
    one = {"collect-hotsearch": "hotsearch", "ingest-task": "crawler", "process-pending": "processing", "run-analysis": "analysis", "run-risk": "scoring", "send-output": "output"}
    if args.verb in one:
        name = one[args.verb]
        if steps[name] is None:
            raise ConfigError("--path is needed")
        out = engine.run({name: steps[name]})
        return asdict(out), out.status != "failed"
    if args.verb == "run-pipeline":
        out = engine.run({k: None if k in args.skip else f for k, f in steps.items()}, args.fail_fast)
        return asdict(out), out.status != "failed"
    state, cycles = {}, []
    for _ in range(args.cycles):
        t = datetime.fromisoformat(now)

        def collect(key: str) -> str:
            kind, _, target = key.partition(":")
            return engine.hotsearch([target], now, _fetcher(args.pages))[0] if kind == "hotsearch" else "skipped"

        def downstream() -> dict:
            return {"status": engine.run({k: steps[k] for k in ("processing", "analysis", "scoring", "output")}).status}

        cycles.append(asdict(scheduler.run_cycle(cfg, state, t, collect, downstream, spark=spark)))
    return {"cycles": cycles, "state": state}, all(c["status"] != "failed" for c in cycles)


def main(argv: list[str] | None = None) -> int:
    try:
        out, ok = run(parser().parse_args(argv))
    except (ConfigError, FileNotFoundError, ValueError) as e:
        print(json.dumps({"error": str(e)}, ensure_ascii=False))
        return 2
    print(json.dumps(out, ensure_ascii=False, default=str))
    return 0 if ok else 2


if __name__ == "__main__":
    sys.exit(main())
