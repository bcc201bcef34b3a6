"""The plans themselves: what is read, what is pushed down, and that nothing pairs everything with everything."""

from __future__ import annotations

import pytest

from tests.conftest import SF
from tidemark.plans.queries import QUERIES

#: These run rounds of jobs before they return a plan.
EAGER = {"dedup_leaders", "dedup_turns", "dedup_documents", "id_dups", "scan_comments", "discover_files", "near_dup_edges", "map_hotsearch", "proc_order", "parse_pages", "as_of_last"}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - EAGER))
def test_no_product_of_rows(spark, name):
    p = plan(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in p
    assert "BroadcastNestedLoopJoin" not in p or name == "task_plan"  # configuration times configuration


def test_pushdown_and_pruning(spark):
    p = plan(QUERIES["anti_missing_analysis"](spark, SF))
    assert "EqualTo(l_returnflag,R)" in p and "ReadSchema: struct<l_orderkey:bigint,l_returnflag:string>" in p
    assert "ReadSchema: struct<lang:string,source:string>" in plan(QUERIES["source_coverage"](spark, SF))
    p = plan(QUERIES["topn_per_platform"](spark, SF))
    assert "text" not in p.split("ReadSchema:")[1] and "WindowGroupLimit" in p


def test_narrow_queries_do_not_shuffle(spark):
    for name in ("rule_classify", "canonical_url", "clean_project", "map_raw_item", "date_filter", "parse_count", "uuid5", "redact_pii", "webhook_body_class"):
        assert "Exchange" not in plan(QUERIES[name](spark, SF)), name


def test_python_only_where_it_must_be(spark):
    with_python = {n for n in set(QUERIES) - EAGER if "Python" in (p := plan(QUERIES[n](spark, SF))) or "Pandas" in p}
    assert with_python <= {"rule_classify", "category_counts", "normalize_text", "simhash64", "clean_project", "page_title", "near_dup_edges", "score_keyword", "score_source", "score_heat", "score_sentiment", "overall_score", "alert_level", "review_reasons", "event_payloads", "simhash_pairs", "simhash_gate", "sql_functions", "parse_pages", "url_join"}


def test_running_ranks_have_no_window_by_key(spark):
    """Windows stand inside a range and key; what ranges hand over is a row for each of them."""
    from tidemark.operators import ordered

    df = spark.read.parquet(f"{SF}/documents.parquet").select("source", "doc_id")
    p = plan(ordered.ranked(df, ["source"], ["doc_id"], parts=5))
    assert p.count("Window [") == 2 and "[_range#" in p.split("windowspecdefinition(")[-1]


@pytest.mark.parametrize("parts", [1, 7])
def test_ranges_equal_windows(spark, parts):
    import random

    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from tidemark.operators import ordered

    r = random.Random(parts)
    rows = [(r.choice(["a", "a", "a", "b", None]), r.randrange(400), k, r.choice([None, 1, 2, 3])) for k in range(400)]
    df = spark.createDataFrame(rows, "g string, t int, id int, v int")
    w = Window.partitionBy("g").orderBy("t", "id")
    x = ordered.Ranges(df, ["g"], ["t", "id"], parts)
    same = lambda a, b: sorted(map(str, a.select(*sorted(a.columns)).collect())) == sorted(map(str, b.select(*sorted(b.columns)).collect()))
    assert same(x.running_sum(F.col("v"), "s"), df.withColumn("s", F.coalesce(F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0))))
    assert same(x.last_known(F.col("v"), "s"), df.withColumn("s", F.last("v", True).over(w.rowsBetween(Window.unboundedPreceding, 0))))
    assert same(x.last_known(F.col("id"), "s", before=True), df.withColumn("s", F.lag("id").over(w)))
    assert same(ordered.ranked(df, ["g"], ["t", "id"], "s", F.col("v").isNotNull(), parts), df.withColumn("s", F.sum(F.col("v").isNotNull().cast("int")).over(w)))
    left, right = df.where("id % 3 = 0").select("g", "t", "id"), df.where("id % 3 = 1").select("g", "t", F.col("v").alias("w"))
    key = {}
    for g, t, k, v in rows:
        if k % 3 == 1:
            key[g, t] = max(key.get((g, t), -1), -1 if v is None else v)
    want = []
    for g, t, k, _ in rows:
        if k % 3 == 0:
            seen = [u for (h, u) in key if h == g and u <= t]
            want.append((g, t, k, None if not seen or key[g, max(seen)] < 0 else key[g, max(seen)]))
    assert sorted(map(tuple, ordered.as_of(left, right, ["g"], "t", ["w"], parts).collect()), key=str) == sorted(want, key=str)
    assert ordered.ranked(df.limit(0), ["g"], ["t", "id"]).count() == 0


def test_sketches_are_near(spark):
    import random

    from pyspark.sql import functions as F

    from tidemark.operators import sketches

    r = random.Random(3)
    rows = [("ab"[k % 2], 1704067200 + 86400 * r.randrange(12), r.random() ** 3 * 1000, r.randrange(700)) for k in range(6000)] + [("c", 1704067200, None, 1), ("a", None, 1.0, 2)]
    df = spark.createDataFrame(rows, "p string, t long, heat double, who long").withColumn("ts", F.timestamp_seconds("t"))
    day = lambda t: t // 86400
    got = sketches.rolling_percentiles(df, ["p"], "ts", "heat", "who", 3).collect()
    assert len(got) == len(rows) - 1
    heats = {}
    for p, t, h, _ in rows[:-2]:
        heats.setdefault((p, day(t)), []).append(h)
    for x in got:
        if x.heat is None:
            assert x.percentile is None
        else:
            near = [h for d in range(3) for h in heats.get((x.p, day(x.t) - d), [])]
            assert abs(x.percentile - sum(h <= x.heat for h in near) / len(near)) < 0.02
    users = {(x.p, str(x.day)): x.n for x in sketches.rolling(sketches.daily(df, ["p"], "ts", "heat", "who"), ["p"], 3).select("p", "day", F.hll_sketch_estimate("who_sketch").alias("n")).collect()}
    assert users["c", "2024-01-01"] == 1 and all(200 < n < 760 for (p, d), n in users.items() if p != "c" and d > "2024-01-03")


def test_many_keywords_cost_about_what_few_do(spark):
    import time

    from tidemark.functions.text import normalize_text
    from tidemark.operators import classify

    df = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", normalize_text("text").alias("t"))
    few = {"x": (90.0, ["the", "ist", "que"]), "y": (95.0, ["zz none"]), "other": (30.0, [])}
    many = {"x": few["x"], "y": (95.0, ["zz none", *(f"kw{k}q" for k in range(10_000))]), "other": few["other"]}
    took = []
    for rules in (few, few, many):
        began = time.monotonic()
        rows = classify.classify(df, "t", rules).select("doc_id", "category", "n_matched", "reason").orderBy("doc_id").collect()
        took.append(time.monotonic() - began)
        texts = {r.doc_id: r.t for r in df.collect()}
        for r in rows:
            hits = [w for w in few["x"][1] if w in (texts[r.doc_id] or "")]
            assert (r.category, r.n_matched, r.reason) == (("x", len(hits), "、".join(hits)) if hits else ("other", 0, classify.NO_MATCH))
    assert took[2] < 4 * took[1] + 3
    assert classify.classify(df, "t", {}).where("category <> 'other'").isEmpty()
