"""The pipeline's stages, each on its own input, against brute force."""

from __future__ import annotations

from collections import defaultdict

import corpus_pipeline as cp
from pyspark.sql import functions as F
from tidemark.llm.common import Table

from tests.conftest import SF
from tests.llm import brute
from tests.llm.test_llm import ODD, prose


def rows_of(df):
    return {(r.doc_id, r.text) for r in df.collect()}


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    kept = {}
    for name, stage in cp.STAGES[:-1]:
        before = [(r.doc_id, r.text) for r in docs.collect()]
        out = Table(stage(spark, docs, SF), name).df
        assert out.columns == docs.columns
        after = rows_of(out)
        kept[name] = len(after)
        if name == "quality_rules":
            failed = {d for d, *_, bad in brute.quality_base(before) if bad}
            assert after <= set(before) and not failed & {d for d, _ in after} and len(after) > 0.6 * len(before)
        elif name == "near_duplicates":
            groups = brute.jaccard(before, 5, 80, 100)
            assert {d for d, _ in after} == {c for _, _, c in groups} and after <= set(before)
        elif name == "decontamination":
            want = {(d, t) for d, t in before if not next(brute.decontaminate([(d, t)], bench))[5]}
            assert after == want
        else:
            was = dict(before)
            for r in out.collect():
                found = brute.secrets_base(was[r.doc_id])
                assert (r.text == was[r.doc_id]) or "[SECRET]" in r.text
                assert not any(found[:3]) or "[SECRET]" in r.text
                assert r.text == was[r.doc_id] or r.n_chars == len(r.text)
                assert not any(brute.secrets_base(r.text)[:3])
        docs = out
    pieces = cp.STAGES[-1][1](spark, docs, SF)
    whole = defaultdict(int)
    for r in pieces.collect():
        whole[r.doc_id] += r.length
    assert set(whole) == {d for d, _ in rows_of(docs)}
    assert cp.run(spark, SF).agg(F.sum("length")).first()[0] == sum(whole.values())


def test_odd_rows(spark):
    rows = [(d, t, "x") for d, t in ODD] + [(70, prose(70, 60) + " extra", "x"), (70, prose(71, 60), "x"), (70, prose(71, 60), "x"), (None, prose(72, 60), "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, redacted string")
    for name, stage in cp.STAGES[:-1]:
        docs = Table(stage(spark, docs, SF), name).df
        assert docs.columns == ["doc_id", "text", "redacted"], name
    assert docs.where("doc_id is null").count() > 0
    assert {r.text for r in docs.where("doc_id = 70").collect()} == {prose(70, 60) + " extra", prose(71, 60)} and docs.where("doc_id = 70").count() == 2
    assert cp.STAGES[-1][1](spark, docs, SF).count() > 0
    none = docs.limit(0)
    for name, stage in cp.STAGES[:-1]:
        assert stage(spark, none, SF).count() == 0, name
