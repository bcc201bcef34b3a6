"""Commits that are whole or not there, lines of files that are split, fingerprint pairs, percentiles, scoring guards."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tidemark.operators import dedup, relational, scoring
from tidemark.operators.store import Store
from tidemark.sources import jsonl


def test_a_commit_is_whole_or_not_there(spark, tmp_path):
    s = Store(spark, f"file://{tmp_path}/s")
    one, two = (spark.createDataFrame([(k,)], "id int") for k in (1, 2))
    s.commit({"a": one, "b": one})
    number, before = s.manifest()

    class Boom(RuntimeError):
        pass

    class Broken:
        def __getattr__(self, name):
            raise Boom

    with pytest.raises(Boom):  # the second table's write fails: the first one's new version must not count
        s.commit({"a": two, "b": Broken()})
    assert s.manifest() == (number, before) and s.read("a").first().id == 1
    stop = Store(spark, s.root)
    stop._publish = lambda *a: (_ for _ in ()).throw(Boom())  # a crash after all tables are written
    with pytest.raises(Boom):
        stop.commit({"a": two, "b": two})
    assert Store(spark, s.root).manifest() == (number, before)
    s.commit({"a": two, "b": two})
    assert {s.read(t).first().id for t in "ab"} == {2} and s.manifest()[0] == number + 1


def test_two_writers(spark, tmp_path):
    s = Store(spark, f"file://{tmp_path}/s")
    row = spark.createDataFrame([(1,)], "id int")
    s.commit({"a": row})
    number, tables = s.manifest()
    s.commit({"a": row}, append=True)
    with pytest.raises(RuntimeError):  # it began before the last commit
        s._publish(number, tables)
    assert s.read("a").count() == 2 and s.read("b") is None


@pytest.mark.parametrize("split", [200, 1 << 20])
def test_lines_of_split_files(spark, tmp_path, split):
    texts = {"x/a.jsonl": ["{}" if k % 7 else "" for k in range(300)], "x/b.jsonl": [json.dumps({"k": "a b"}, ensure_ascii=False), " ", "bad", "é" * 150, "last"], "x/y/c.jsonl": []}
    for name, lines in texts.items():
        f = tmp_path / name
        f.parent.mkdir(parents=True, exist_ok=True)
        f.write_bytes(("\r\n" if "b." in name else "\n").join(lines).encode())
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    try:
        got = jsonl.read_lines(spark, str(tmp_path / "x"))
        assert split > 1000 or got.rdd.getNumPartitions() > 3
        rows = sorted((r.path.rsplit("/x/", 1)[1], r.line_number, r.line) for r in got.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert rows == sorted((name[2:], k + 1, line) for name, lines in texts.items() for k, line in enumerate(lines) if line.strip())


@pytest.mark.parametrize("most,blocks", [(3, 6), (0, 4), (8, 10)])
def test_simhash_pairs(spark, most, blocks):
    import random

    r = random.Random(most)
    base = [r.getrandbits(64) for _ in range(20)]
    values = base + [b ^ sum(1 << k for k in r.sample(range(64), r.randint(0, 10))) for b in base for _ in range(4)]
    rows = [(f"{v:016x}",) for v in values] + [(None,), (f"{base[0]:016x}",)]
    got = {tuple(x) for x in dedup.simhash_pairs(spark.createDataFrame(rows, "simhash string"), most, blocks).collect()}
    each = sorted({f"{v:016x}" for v in values})
    distance = lambda a, b: (int(a, 16) ^ int(b, 16)).bit_count()
    assert got == {(a, b, distance(a, b)) for a in each for b in each if a < b and distance(a, b) <= most}


def test_percentiles(spark):
    rows = [("a", k % 5) for k in range(40)] + [("b", None), ("b", 3), ("c", 1), (None, 2), (None, 4)]
    df = spark.createDataFrame(rows, "g string, v int")
    from pyspark.sql import Window

    want = df.withColumn("percentile", F.percent_rank().over(Window.partitionBy("g").orderBy("v")))
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, relational.heat_percentiles(df, "g", "v").select("g", "v", "percentile").collect()), key=key) == sorted(map(tuple, want.collect()), key=key)


def test_an_analysis_of_another_item_fails(spark):
    from tidemark.config import Config

    row = ("1", "1", "other", 0.3, "other", 0.9, 10.0, None, "account", "x", None, None, 5)
    cols = "clean_item_id string, analysis_item_id string, rule_category string, rule_confidence double, llm_category string, llm_confidence double, risk_score double, sentiment_score double, source_type string, account_config_id string, best_rank int, ranked_platform string, interaction_total long"
    assert scoring.score(spark.createDataFrame([row], cols), Config()).count() == 1
    with pytest.raises(Exception, match="the analysis of 2 stands with item 1"):
        scoring.score(spark.createDataFrame([("1", "2", *row[2:])], cols), Config()).collect()
