"""What must not happen twice, or not at all: calls, deliveries, late commits; and what a run may leave unread."""

from __future__ import annotations

import json
import random
import threading
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.config import Config
from tidemark.functions.text import normalized, simhash_py
from tidemark.operators import anchors, emit, enrich, journal, stopping
from tidemark.operators.store import Conflict, Store
from tidemark.plans import cleaning, scheduler
from tidemark.plans.pipeline import Engine


# ---- answers ----
def test_a_task_that_runs_again_asks_nothing_twice(spark, tmp_path):
    calls = f"{tmp_path}/calls"

    def client(task, system, user, schema):
        with open(calls, "a") as f:
            f.write(journal.digest(task, user) + "\n")
        n = sum(1 for _ in open(calls))
        if n == 4:  # the worker dies in the middle of an item
            raise SystemExit(1)
        return enrich.stand_in(task, system, user, schema)

    items = spark.createDataFrame([(f"c{k}", f"t{k}", "x", "p") for k in range(4)], "clean_item_id string, title string, content string, platform string").coalesce(1)
    reqs = enrich.requests(items, None)
    asked = journal.Remembered(client, journal.Journal(f"file://{tmp_path}/notes"), "run")
    go = lambda c: enrich.analyse(reqs, c, ["neutral"]).coalesce(1).collect()
    with pytest.raises(Exception):
        go(asked)  # one attempt a task in a local session
    rows = go(asked)
    made = open(calls).read().split()
    assert all(r.ok for r in rows) and len(rows) == 4
    assert len(set(made)) == 12 and len(made) == 13  # only the call that died was made again
    assert all(r.attempts == 3 for r in rows)  # this run's calls, whichever attempt made them
    later = go(journal.Remembered(client, journal.Journal(f"file://{tmp_path}/notes"), "another"))
    assert all(r.ok and r.attempts == 0 and r.total_tokens == 0 for r in later) and len(open(calls).read().split()) == 13


# ---- deliveries ----
def events(spark, n):
    rows = [(f"e{k}", "{}", f"h{k}", 1) for k in range(n)]
    return spark.createDataFrame(rows, "event_id string, payload string, payload_hash string, attempt_number int").coalesce(1)


def test_a_crash_never_sends_twice(spark, tmp_path):
    sent, notes = f"{tmp_path}/sent", journal.Journal(f"file://{tmp_path}/notes")

    def sender(body):
        with open(sent, "a") as f:
            f.write("x\n")
        if sum(1 for _ in open(sent)) == 3:  # it arrived, but nobody hears of it
            raise SystemExit(1)
        return {"status": "succeeded", "http_tries": 1, "response": "", "error": None}

    with pytest.raises(Exception):
        emit.deliver(events(spark, 5), sender, notes).collect()
    got = {r.event_id: r.status for r in emit.deliver(events(spark, 5), sender, notes).collect()}
    assert got == {"e0": "succeeded", "e1": "succeeded", "e2": "unknown", "e3": "succeeded", "e4": "succeeded"}
    assert len(open(sent).read().split()) == 5
    assert {r.status for r in emit.deliver(events(spark, 5), sender, notes).collect()} == {"succeeded", "unknown"} and len(open(sent).read().split()) == 5


def test_claims_are_exclusive(tmp_path):
    j, won = journal.Journal(f"file://{tmp_path}/n"), []
    threads = [threading.Thread(target=lambda: won.append(j.claim("ab"))) for _ in range(16)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sum(won) <= 1 and not j.claim("ab") and j.claim("cd")
    j.put("ab", {"a": "ü"})
    assert j.get("ab") == {"a": "ü"} and j.get("ef") is None
    j.forget()
    assert j.get("ab") is None


# ---- stopping ----
def test_a_late_source_is_stopped(spark, tmp_path):
    c = Config()
    c.collect.hot_platforms, c.collect.keyword_levels, c.collect.accounts = ["weibo", "baidu"], {}, {}
    c.scheduler.task_timeout_seconds = 12
    s, after = Store(spark, f"file://{tmp_path}/s"), []
    row = spark.createDataFrame([("1", "x")], "id string, platform string")

    def collect(key):
        if key == "hotsearch:weibo":
            s.append_new("raw_items", row)
            return "succeeded"
        try:
            spark.range(4).repartition(2).mapInPandas(lambda f: (time.sleep(60), f)[1], "id long").collect()
            after.append("not interrupted")
        except Exception:
            after.append("interrupted")
        s.append_new("raw_items", row.withColumn("id", F.lit("late")))
        after.append("committed")

    began = time.monotonic()
    cycle = scheduler.run_cycle(c, {}, datetime(2024, 1, 1), collect, lambda: time.sleep(30) or {"status": "succeeded"}, spark=spark, downstream_timeout=1)
    assert time.monotonic() - began < 45
    assert {r["source_key"]: (r["status"], r["error"]) for r in cycle.runs} == {"hotsearch:weibo": ("succeeded", None), "hotsearch:baidu": ("failed", "timed out")}
    assert cycle.downstream == {"status": "failed", "error": "timed out"}
    for _ in range(100):
        if after:
            break
        time.sleep(0.2)
    time.sleep(1)
    assert after == ["interrupted"]  # its job ended, and what it then tried to commit was refused
    assert [r.id for r in s.read("raw_items").collect()] == ["1"]
    assert not spark.sparkContext.statusTracker().getActiveJobsIds()


def test_stopped_work_commits_nothing(spark, tmp_path):
    s, w = Store(spark, f"file://{tmp_path}/s"), stopping.Work("w")
    row = spark.createDataFrame([(1,)], "id int")
    with w.running():
        s.commit({"a": row})
        w.stop()
        with pytest.raises(stopping.Stopped):
            s.commit({"a": row}, append=True)
    s.commit({"b": row})  # other work goes on
    assert s.read("a").count() == 1


def test_sources_that_commit_at_once(spark, tmp_path):
    s = Store(spark, f"file://{tmp_path}/s")
    rows = [spark.createDataFrame([(str(k),), ("same",)], "id string") for k in range(4)]
    threads = [threading.Thread(target=s.append_new, args=("raw_items", r)) for r in rows]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sorted(r.id for r in s.read("raw_items").collect()) == ["0", "1", "2", "3", "same"]
    number, tables = s.manifest()
    with pytest.raises(Conflict):
        s._publish(number - 1, tables)


# ---- both or none ----
@pytest.mark.parametrize("stage", ["score", "output"])
def test_a_crash_between_writes_leaves_both_or_none(spark, tmp_path, stage):
    f = tmp_path / "contents.jsonl"
    f.write_text("\n".join(json.dumps({"note_id": f"n{k}", "title": f"第{k}号 仓库火灾爆炸 {'甲乙丙'[k] * 9}", "publish_time": 1704844800 + k}, ensure_ascii=False) for k in range(3)))
    from tidemark.sources import jsonl

    e = Engine(spark, f"file://{tmp_path}/store")
    e.ingest(str(f), jsonl.Context())
    e.process("2024-01-11 00:00:00")
    e.analyse(enrich.stand_in)
    if stage == "output":
        e.score()
    run = {"score": e.score, "output": lambda: e.output(include_queued=True)}[stage]
    tables = {"score": ("assessments", "events"), "output": ("attempts", "deliveries")}[stage]
    real, writes = e.store._write, []

    def failing(name, df):
        writes.append(name)
        if len(writes) == 2:
            raise RuntimeError("crash")
        return real(name, df)

    e.store._write = failing
    with pytest.raises(RuntimeError, match="crash"):
        run()
    e.store._write = real
    assert [e.store.read(t) for t in tables] == [None, None]
    run()
    a, b = (e.store.read(t).count() for t in tables)
    assert a == b > 0


# ---- the index ----
def clean_rows(r, n, start):
    some = ["the", "tion", "ing", "quiz", "jazz", "over", "river", "kept", "zoo", "house"]
    out = []
    for k in range(n):
        title = " ".join(r.choice(some) for _ in range(r.randint(3, 8)))
        text = " ".join(r.choice(some) + r.choice(["", "s"]) for _ in range(r.choice([5, 30, 120, 400])))
        if out and r.random() < 0.3:
            title, text = out[-1]["title"], out[-1]["content"] + " x"
        out.append({"id": f"r{start + k:04d}", "source_type": "keyword_search", "platform": r.choice("ab"), "external_id": f"e{r.randrange(4 * n)}", "title": title, "content": text, "url": r.choice([None, f"https://x.com/{r.randrange(3 * n)}"]), "keyword": None})
    return out


def test_the_index_decides_the_same_and_reads_less(spark, tmp_path):
    r = random.Random(11)
    old, new = clean_rows(r, 60, 0), clean_rows(r, 12, 100)
    new += [{**old[7], "id": "r0200", "external_id": "z", "url": None}, {**old[9], "id": "r0201", "external_id": "y", "title": old[9]["title"] + " x", "url": None}]
    cols = "id string, source_type string, platform string, external_id string, title string, content string, url string, keyword string"

    def frame(rows):
        df = spark.createDataFrame([tuple(x[c.split()[0]] for c in cols.split(", ")) for x in rows], cols)
        return df.withColumn("published_at", F.lit("2024-01-01").cast("timestamp")).withColumn("collected_at", F.col("published_at"))

    ref = F.lit("2024-01-02").cast("timestamp")
    first = cleaning.run(frame(old), None, Config(), ref)
    s = Store(spark, f"file://{tmp_path}/s")
    s.commit({"clean_items": first.accepted, "anchor_signatures": anchors.signatures(first.accepted), "anchor_bodies": anchors.bodies(first.accepted)})
    index, texts = s.read("anchor_signatures"), s.read("anchor_bodies")
    keyed = lambda out: {x.raw_item_id: (x.outcome, x.duplicate_of) for x in out.decisions.collect()}
    whole = keyed(cleaning.run(frame(new), s.read("clean_items"), Config(), ref))
    got = keyed(cleaning.run(frame(new), lambda x: anchors.anchors_for(x, index, texts), Config(), ref))
    assert got == whole and sum(d is not None for _, d in got.values()) >= 3
    one = frame(new[-1:]).select("*")
    fresh = cleaning.clean_projection(one, Config())
    found = anchors.anchors_for(fresh, index, texts)
    assert 0 < found.count() < first.accepted.count() / 3
    # bytes follow the new items: the parts that are read
    files = lambda df: {x[0] for x in df.select(F.input_file_name()).collect()}
    named = [(None, x[0]) for x in found.select(anchors._part(F.xxhash64("id"))).distinct().collect()]
    assert len(files(anchors._pruned(texts, named))) <= found.count() < len(files(texts)) / 3
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "cell#" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_signatures_lose_no_adjacent_item(spark):
    r = random.Random(12)
    rows = [(f"i{k}", "a", f"e{k}", None, (t := normalized(f"title {r.random()} {r.randrange(9)}")), (n := normalized(f"{t} " + "word river " * r.randint(1, 60))), simhash_py(n)) for k in range(40)]
    cols = "id string, platform string, external_id string, url_hash string, norm_title string, norm_full string, simhash string"
    df = spark.createDataFrame(rows, cols)
    from tidemark.functions.text import ratio

    new = [("n", "b", "", None, rows[3][4], rows[3][5] + " x", rows[3][6])]
    got = {x.id for x in anchors.beside(spark.createDataFrame(new, cols), anchors.signatures(df)).collect()}
    near = lambda a, b: bin(int(a, 16) ^ int(b, 16)).count("1") <= 22
    want = {x[0] for x in rows if near(x[6], new[0][6]) and (ratio(new[0][4], x[4]) >= 0.9 or ratio(new[0][5], x[5]) >= 0.88)}
    assert want and want <= got
