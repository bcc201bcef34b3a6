"""Decontamination answers each row, whatever the benchmark's size."""

from tests.llm.test_llm import prose, same
from tidemark.llm import decontam


def test_blocks_answer_each_row(spark):
    x = prose(2, 40)
    rows = [(None, x), (None, "no hit"), (None, None), (7, x), (7, prose(3, 50)), (7, prose(3, 50)), (8, "a " + prose(5, 60))]
    items = [(1, x), (2, prose(3, 30)), (3, prose(5, 20)), (4, " ".join(x.split()[:20])), (5, " ".join(x.split()[8:])), (6, prose(9, 400)), (7, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    one = decontam.decontaminate(docs, bench).collect()
    many = decontam.decontaminate(docs, bench, block_bytes=300).collect()
    assert len(many) == len(rows)
    same(many, one)
