"""Streams: large files by ranges, and first sightings whose decisions don't depend on the order of landing."""

from __future__ import annotations

import json
import random

from pyspark.sql import functions as F

from tidemark.plans.pipeline import Engine
from tidemark.sources import jsonl
from tidemark.streaming import incremental, sightings


def test_a_large_file_has_many_ranges_and_equal_ids(spark, tmp_path):
    land = tmp_path / "land"
    land.mkdir()
    lines = [json.dumps({"note_id": str(k), "title": f"第{k}件 {'甲乙丙丁'[k % 4] * (k % 9 + 3)}{k * 7919}"}, ensure_ascii=False) if k % 6 else "" for k in range(60)]
    (land / "a_contents.jsonl").write_text("\n".join(lines))
    want = {r.id for r in jsonl.load_items(spark, str(land), jsonl.Context())[0].collect()}
    old, seen = spark.conf.get("spark.sql.files.maxPartitionBytes"), []
    spark.conf.set("spark.sql.files.maxPartitionBytes", 400)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    e = Engine(spark, f"file://{tmp_path}/store")
    e.process = lambda *a: seen.append(1)
    try:
        assert jsonl.read_lines(spark, str(land)).rdd.getNumPartitions() > 3
        assert incremental.watch(e, str(land), jsonl.Context(), str(tmp_path / "cp"), "2024-01-02 00:00:00").awaitTermination(120)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert seen and {r.id for r in e.store.read("raw_items").collect()} == want and len(want) == 50


def test_sightings_in_any_order_and_after_a_restart(spark, tmp_path):
    r = random.Random(7)
    day = 86400
    items = [(f"i{k:03d}", r.choice("abc"), f"e{r.randrange(12)}", None if r.random() < 0.5 else f"u{r.randrange(10)}", 1704067200 + r.randrange(2 * day)) for k in range(120)]
    schema = "id string, platform string, external_id string, url_hash string, t long"
    made = lambda rows: sightings.keyed(spark.createDataFrame(rows, schema).withColumn("published_at", F.timestamp_seconds("t")).withColumn("collected_at", F.col("published_at")))
    first = {}
    for k in made(items).collect():
        first[k.key] = min(first.get(k.key, (k.time, k.id)), (k.time, k.id))
    want = {(k.key, k.id, first[k.key][1]) for k in made(items).collect()}
    for turn in range(2):
        order = list(items)
        r.shuffle(order)
        land, cp, out = (tmp_path / f"{n}{turn}" for n in ("land", "cp", "out"))
        kept = []

        def write(df, number, out=out, kept=kept):
            df.write.mode("overwrite").parquet(f"{out}/{number}")
            kept.append(number)

        for part in range(3):  # each start reads what has landed since, with the state that is there
            made(order[40 * part : 40 * part + 40]).coalesce(1).write.mode("append").parquet(str(land))
            stream = spark.readStream.schema("key string, id string, time timestamp").parquet(str(land))
            assert sightings.follow(spark, stream, write, str(cp)).awaitTermination(180)
        rows = spark.read.schema(sightings.SIGHTING).parquet(*[f"{out}/{n}" for n in sorted(set(kept))])
        assert {tuple(x) for x in sightings.decided(rows).collect()} == want
        assert rows.where("kind = 'moved'").count() > 0 and len(set(kept)) >= 3
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", "x") != sightings._ROCKS


def test_late_items_are_told(spark, tmp_path):
    land, out = tmp_path / "land", []
    at = lambda k: 1704067200 + 3600 * k
    for rows in ([("k", "b", at(100))], [("k", "old", at(10)), ("k", "a", at(50)), (None, "x", at(1)), ("k", None, at(1)), ("k", "y", None)], [("k", "next", at(300)), ("k", "b", at(100))]):
        spark.createDataFrame(rows, "key string, id string, t long").select("key", "id", F.timestamp_seconds("t").alias("time")).coalesce(1).write.mode("append").parquet(str(land))
        stream = spark.readStream.schema("key string, id string, time timestamp").parquet(str(land))
        sightings.follow(spark, stream, lambda df, n: out.extend(tuple(x) for x in df.select("id", "leader", "kind", "run").collect()), str(tmp_path / "cp")).awaitTermination(120)
    assert out == [("b", "b", "first", 1), ("old", None, "late", 1), ("a", "a", "first", 1), ("b", "a", "moved", 1), ("b", "a", "again", 1), ("next", "next", "first", 2)]
