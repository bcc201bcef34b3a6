"""The filters that carry all columns agree with the operators that answer by id."""

from pyspark.sql import functions as F

from tests.conftest import SF
from tests.llm.test_llm import ODD, prose
from tidemark.llm import decontam, quality, secrets
from tidemark.llm.queries import SCAN_VOCABULARY


def odd(spark):
    rows = [(float(k), d, t, [k, None], 5) for k, (d, t) in enumerate(ODD)]
    return spark.createDataFrame(rows, "votes double, doc_id long, text string, n array<int>, n_chars int").repartition(3)


def kept(df, column):
    return sorted(r[column] for r in df.collect())


def test_quality(spark):
    for docs, key in ((spark.read.parquet(f"{SF}/documents.parquet"), "doc_id"), (odd(spark), "votes")):
        want = quality.quality(docs, id_col=key).where("kept").select(F.col("doc_id").alias(key))
        got = quality.keep_good(docs)
        assert got.schema == docs.schema
        assert kept(got.select(F.col(key).cast("long").alias("k")), "k") == kept(want.select(F.col(key).alias("k")), "k")
        assert quality.keep_good(docs.limit(0)).count() == 0


def test_decontamination(spark):
    bench = spark.createDataFrame([(1, prose(2, 30)), (2, "Wort"), (3, None), (5, prose(5, 12)), (6, prose(77, 300))], "item_id long, text string")
    docs = odd(spark)
    want = kept(decontam.decontaminate(docs, bench, id_col="votes").where("not contaminated"), "doc_id")
    for block in (300, 1 << 20):
        got = decontam.keep_clean(docs, bench, block_bytes=block)
        assert got.schema == docs.schema and [int(x) for x in kept(got, "votes")] == want
    assert 0 < len(want) < len(ODD)
    assert decontam.keep_clean(docs, bench.limit(0)).count() == len(ODD) and decontam.keep_clean(docs.limit(0), bench).count() == 0


def test_redaction(spark):
    docs = odd(spark)
    got = secrets.redact(docs, SCAN_VOCABULARY, length_col="n_chars")
    want = {r.doc_id: r.redacted for r in secrets.find_secrets(docs, SCAN_VOCABULARY, id_col="votes", redact="[SECRET]").collect()}
    assert got.schema == docs.schema
    rows = got.collect()
    assert len(rows) == len(ODD) and {int(r.votes): r.text for r in rows} == want
    was = {k: t for k, (_, t) in enumerate(ODD)}
    assert all(r.n_chars == (5 if r.text == was[int(r.votes)] else len(r.text)) for r in rows)
    assert any(r.n_chars != 5 for r in rows)
    assert secrets.redact(docs.limit(0), SCAN_VOCABULARY).count() == 0
