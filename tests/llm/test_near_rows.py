"""The pipeline's near duplicates where ids repeat or are missing."""

import corpus_pipeline as cp

from tests.llm.test_llm import prose


def test_repeated_and_missing_ids(spark):
    """Each group keeps one row, that of its least id; unlike texts of one id are rows of groups of their own."""
    a, b, c, d = (prose(300 + k, 80) for k in range(4))
    rows = [(3, a), (3, b), (9, b), (None, c), (None, c + " end"), (None, d), (20, d), (21, d + " end"), (20, d), (5, None), (5, None), (6, "")]
    for order in (rows, rows[::-1]):
        docs = spark.createDataFrame(order, "doc_id long, text string").repartition(3)
        got = sorted(((r.doc_id or 0, r.text or "") for r in cp.near_duplicates(spark, docs, "").collect()))
        assert [x for x in got if x[0]] == [(3, min(a, b)), (3, max(a, b)), (5, ""), (6, ""), (20, d)]
        assert len(got) == 6 and got[0][1] in (c, c + " end")
