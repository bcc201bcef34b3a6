"""The quality verdict is the model's: it differs from all-must-pass and is the more accurate, and equals a plain estimate."""

from tests.llm import brute
from tidemark.llm import quality

SF = "/root/testdata/sf0.01"


def test_verdict(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    rows = quality.quality(docs).collect()
    votes = {r.doc_id: [int(x) for x in r.votes.split(",")] for r in rows}
    counted = [r for r in rows if r.n_words >= 20]
    plain = brute.vote_model([votes[r.doc_id] for r in counted])
    assert all(abs(r.posterior - p) < 1e-6 for r, p in zip(counted, plain))
    assert all(r.kept == (not r.base_failed and r.posterior >= 0.5) for r in counted)
    judged = [r for r in rows if not r.base_failed]
    differ = [r for r in judged if r.kept == (-1 in votes[r.doc_id])]
    assert len(differ) >= 0.02 * len(judged)
    label = {r.doc_id: r.quality for r in labels.collect()}
    known = [r for r in judged if r.doc_id in label]
    by_model = sum(r.kept == (label[r.doc_id] == 1) for r in known) / len(known)
    by_all = sum((-1 not in votes[r.doc_id]) == (label[r.doc_id] == 1) for r in known) / len(known)
    assert by_model > 0.99 and by_model > by_all + 0.02
    good = [r for r in known if label[r.doc_id] == 1]
    assert sum(r.kept for r in good) >= 0.99 * len(good)


def test_no_rule_is_held_up():
    """Accuracies are what the votes say, also far below one half."""
    import numpy as np

    patterns = np.array([[1, 1, 1], [-1, -1, 1], [-1, 1, -1], [1, 1, -1]], float)
    post, accuracy = quality.fit(patterns, np.array([900.0, 60, 30, 5]))
    assert post[0] > 0.99 and post[1] < 0.5 and accuracy[1].min() < 0.5
    assert quality.fit(np.empty((0, 3)), np.empty(0))[0].shape == (0,)
