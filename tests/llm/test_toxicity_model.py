"""The label model and the classifier against plain versions, row by row."""

import math
import random
import re
import zlib
from itertools import product

import numpy as np
import pytest

from tests.conftest import SF
from tests.llm.test_llm import ODD
from tidemark.llm import toxicity


def plain_label_model(votes, prior, rounds=60, smooth=5.0):
    m, post, parent = len(votes[0]), [0.95 if v[-1] > 0 else 0.05 for v in votes], None
    kinds = (-1, 0, 1)
    for r in range(rounds):
        pair, single = {}, {}
        for v, p in zip(votes, post):
            for label, w in ((0, 1 - p), (1, p)):
                for j in range(m):
                    single[label, j, v[j]] = single.get((label, j, v[j]), 0.0) + w
                    for k in range(m):
                        pair[label, j, v[j], k, v[k]] = pair.get((label, j, v[j], k, v[k]), 0.0) + w
        n_of = {label: sum(single.get((label, 0, a), 0.0) for a in kinds) for label in (0, 1)}
        if r in (0, 3, 6):
            total = n_of[0] + n_of[1]

            def information(j, k):
                out = 0.0
                for label, a, b in product((0, 1), kinds, kinds):
                    p = pair.get((label, j, a, k, b), 0.0) / total
                    if p > 0:
                        out += p * math.log(p * (n_of[label] / total) / (single[label, j, a] / total * single[label, k, b] / total))
                return round(out, 12)

            parent, inside = {m - 1: m - 1}, [m - 1]
            while len(inside) < m:
                best = max(((information(i, j), i, j) for j in range(m) if j not in parent for i in inside), key=lambda x: (x[0], -x[2], -inside.index(x[1])))
                parent[best[2]] = best[1]
                inside.append(best[2])
        alone = lambda label, j, a: (single.get((label, j, a), 0.0) + 0.5) / (n_of[label] + 1.5)
        new = []
        for v in votes:
            odds = math.log(prior / (1 - prior))
            for j in range(m):
                of, chance = parent[j], []
                for label in (0, 1):
                    if of == j:
                        chance.append(alone(label, j, v[j]))
                    else:
                        chance.append((pair.get((label, of, v[of], j, v[j]), 0.0) + smooth * alone(label, j, v[j])) / (single.get((label, of, v[of]), 0.0) + smooth))
                odds += math.log(chance[1] / chance[0])
            new.append(1 / (1 + math.exp(-max(-30, min(30, odds)))))
        moved, post = max(abs(a - b) for a, b in zip(new, post)), new
        if r > 6 and moved < 1e-6:
            break
    return post, [parent[j] for j in range(m)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_label_model(seed):
    r = random.Random(seed)
    votes = []
    for _ in range(150):
        y = r.random() < 0.3
        first = (1 if r.random() < (0.8 if y else 0.1) else 0, 1 if r.random() < (0.6 if y else 0.2) else -1 if r.random() < 0.5 else 0)
        same = first[0] if r.random() < 0.9 else 0  # a voter that repeats another
        votes.append([*first, same, r.choice([-1, 0, 1]), 1 if y != (r.random() < 0.05) else -1])
    got, tree = toxicity.label_model(np.array(votes), 0.3)
    want, plain = plain_label_model(votes, 0.3)
    assert np.abs(got - np.array(want)).max() < 1e-5
    assert tree == plain
    assert tree[2] == 0 or tree[0] == 2  # the repeated voter hangs on the one it repeats


def test_correlated_voters_count_once():
    """Ten copies of a voter tell hardly more than one of them."""
    r = random.Random(9)
    rows = [(r.random() < 0.4) for _ in range(600)]
    one = [[1 if r.random() < (0.7 if y else 0.3) else 0, 1 if r.random() < (0.75 if y else 0.2) else 0, 1 if y != (r.random() < 0.2) else -1] for y in rows]
    alone, _ = toxicity.label_model(np.array(one), 0.4, rounds=1)
    many, _ = toxicity.label_model(np.array([[v[0]] * 10 + v[1:] for v in one]), 0.4, rounds=1)
    assert np.abs(alone - many).max() < 0.08


def plain_features(text):
    words = re.findall(r"[^\W\d_]+", (text or "").lower())
    times = {}
    for w in words:
        for name in [b"w" + w.encode(), *(b"p" + w[:k].encode() for k in range(3, 9) if k < len(w))]:
            times[zlib.crc32(name)] = times.get(zlib.crc32(name), 0) + 1
    return times


def test_scores(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    weights, bias = toxicity.fit(docs, labels)
    assert len(weights) > 20
    text = {r.doc_id: r.text for r in docs.collect()}
    for r in toxicity.toxicity(docs, labels).collect():
        total = bias + sum(weights.get(f, 0.0) + sum(weights.get((f * 0x9E3779B1 + k) % 2**32, 0.0) for k in (2, 3, 5) if c >= k) for f, c in plain_features(text[r.doc_id]).items())
        assert abs(r.score - 1 / (1 + math.exp(-max(-30, min(30, total))))) < 1e-9 and r.predicted == int(r.score >= 0.3)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)


def test_held_out_labels_are_never_seen(spark):
    from pyspark.sql import functions as F

    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2
    other = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.fit(docs, labels) == toxicity.fit(docs, other)


def test_patterns():
    assert toxicity.patterns("", []) == (0, 0, 0, 0, -1)
    text = "YOU ARE SUCH A LOSERRRR!!! !!! $$$ ### go"
    assert toxicity.patterns(text, re.findall(r"[^\W\d_]+", text.lower())) == (1, 1, 1, 1, 0)
    for _, t in ODD:
        assert len(toxicity.features_of(t)[1]) == len(toxicity.PATTERNS)
