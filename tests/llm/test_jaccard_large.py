"""Regions that are too large for a task are split by pivots, or dealt into pairs of blocks, and stay exact."""

import random

import pytest
from tests.llm import brute
from tests.llm.test_llm import near_rows, prose, same
from tidemark.llm import jaccard


@pytest.mark.parametrize("seed,limits", [(1, {"region_docs": 20}), (2, {"region_shingles": 2500}), (3, {"region_docs": 60})])
def test_split_regions(spark, seed, limits):
    rows = near_rows(200, seed)
    got = jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), shingle=3, num=90, den=100, **limits).collect()
    same(got, brute.jaccard(rows, 3, 90, 100))


@pytest.mark.parametrize("limits", [{"run_nodes": 10}, {"run_nodes": 3, "region_docs": 25}])
def test_dealt_runs(spark, limits):
    """Unlike texts that share a passage, and near copies among them, in runs that are dealt into pairs of blocks."""
    shared = prose(60, 40)
    rows = [(k, shared + " " + prose(700 + k // 3, 60) + f" end{k}") for k in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for size, num in ((3, 90), (5, 80)):
        same(jaccard.jaccard_components(df, shingle=size, num=num, den=100, heavy_rows=1, **limits).collect(), brute.jaccard(rows, size, num, 100))


def test_a_chain_of_near_copies(spark):
    """Each text links with the next few only, so pivots settle little and windows replicate much."""
    words = prose(77, 700).split()
    rows = [(1000 - k, " ".join(words[k : k + 150])) for k in range(0, 500, 2)]
    random.Random(4).shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for size, num in ((3, 90), (5, 80)):
        for limits in ({}, {"region_docs": 30}):
            same(jaccard.jaccard_components(df, shingle=size, num=num, den=100, **limits).collect(), brute.jaccard(rows, size, num, 100))


def test_texts_without_ids_connect(spark):
    words = prose(78, 300).split()
    rows = [(1, " ".join(words[:200])), (None, " ".join(words[8:208])), (2, " ".join(words[16:216])), (None, prose(79, 50))]
    got = jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), shingle=3, num=90, den=100).collect()
    want = brute.jaccard(rows, 3, 90, 100)
    assert [w[2] for w in want] == [1, 1, 1, None]
    same(got, want)


def test_long_texts(spark):
    base = prose(80, 6000).split()
    rows = []
    for k in range(12):
        w = list(base) if k % 2 else prose(90 + k, 5000 + 400 * k).split()
        for j in range(40 * k):
            w[(j * 131) % len(w)] = f"edit{k}x{j}"
        rows.append((k, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for limits in ({}, {"region_shingles": 20_000}):
        same(jaccard.jaccard_components(df, shingle=3, num=90, den=100, **limits).collect(), brute.jaccard(rows, 3, 90, 100))


def test_histograms_bound_from_below():
    import numpy as np

    r = np.random.default_rng(5)
    for n in (5, 200, 511, 513, 3000, 9000):
        a = np.unique(r.integers(0, 2**63, n).astype(np.uint64))
        for m in (1, n // 20 + 1, n // 3 + 1):
            b = np.unique(np.r_[a[m:], r.integers(0, 2**63, 2 * m).astype(np.uint64)])
            x, y = jaccard.unpacked([jaccard.histogram(a)]), jaccard.unpacked([jaccard.histogram(b)])
            least = min(x.shape[1], y.shape[1])
            assert jaccard.lower_bound(jaccard.folded(x, least), jaccard.folded(y, least))[0] <= len(np.setxor1d(a, b))
