"""Toxicity by weak supervision: a generative model of many voters labels rows, a linear classifier learns from its posterior."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch, map_batches

_WORD = re.compile(r"[^\W\d_]+")
_MARKS = re.compile(r"[#*$%&|<>@]")


def word_features(word: str) -> list[int]:
    """A word and its beginnings of three to eight letters, as 32-bit numbers."""
    return [zlib.crc32(b"w" + word.encode())] + [zlib.crc32(b"p" + word[:k].encode()) for k in range(3, min(8, len(word) - 1) + 1)]


LEVELS = (2, 3, 5)


def level(feature: int, times: int) -> int:
    """The feature that something occurs so often or more."""
    return (feature * 0x9E3779B1 + times) & 0xFFFFFFFF


def counted(words: dict[str, int], of=word_features) -> dict[int, int]:
    """How often each feature occurs in a text, from its words' counts."""
    out: dict[int, int] = {}
    for w, c in words.items():
        for f in of(w):
            out[f] = out.get(f, 0) + c
    return out


#: The pattern voters, in the order of `patterns`: they need no language.
PATTERNS = ("shouts", "exclaims", "repeats a letter", "marks words", "hardly a text")
_DRAWN_OUT = re.compile(r"([^\W\d_])\1{3}")


def patterns(text: str, words: list[str]) -> tuple[int, ...]:
    """Votes of the patterns: 1 for toxic, -1 against, 0 to abstain."""
    n = max(1, len(words))
    return (
        int(sum(len(w) > 2 and w.isupper() for w in _WORD.findall(text)) >= max(3, n // 10)),
        int(text.count("!") >= max(3, n // 10)),
        int(_DRAWN_OUT.search(text) is not None),
        int(len(_MARKS.findall(text)) >= n // 2 + 3),
        -int(len(words) < 5),
    )


def lexicons(doc: np.ndarray, col: np.ndarray, y: np.ndarray, n_features: int, most: int) -> list[int]:
    """The features that make lexicon voters: a stem or word each, so what a voter votes for has a name.

    The most telling one of the toxic rows comes first; rows that a voter has found count half for the next, so voters go on
    to other words and languages. Telling: in four standard deviations more toxic rows than by chance, half of its rows or more.
    A feature that is found in the same rows as a voter, within a tenth, is that voter's word cut otherwise, and is left out.
    """
    rate, tot, pos = y.mean(), np.bincount(col, minlength=n_features), np.bincount(col, y[doc], n_features)
    spread = np.sqrt(tot * rate * (1 - rate) + 1e-9)
    free = ((pos - tot * rate) / spread > 4) & (pos >= 0.5 * tot)
    keep = free[col]
    doc, col = doc[keep], col[keep]
    weight, chosen = y.astype(float).copy(), []
    while free.any() and len(chosen) < most:
        gain = np.where(free, (np.bincount(col, weight[doc], n_features) - tot * rate * weight.sum() / max(1.0, y.sum())) / spread, -np.inf)
        best = int(gain.argmax())
        if gain[best] <= 2:
            break
        chosen.append(best)
        rows = np.unique(doc[col == best])
        there = np.zeros(len(y), bool)
        there[rows] = True
        both = np.bincount(col, there[doc], n_features)
        free &= both < 0.9 * np.maximum(tot, len(rows))
        free[best] = False
        weight[rows] *= 0.5
    return chosen


def voted(doc: np.ndarray, col: np.ndarray, chosen: list[int], patterns: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Votes (rows, voters): lexicons, how many of them agree, patterns, and the given label last."""
    votes = np.zeros((len(y), len(chosen) + 1 + patterns.shape[1] + 1), np.int64)
    for j, f in enumerate(chosen):
        votes[doc[col == f], j] = 1
    number = votes.sum(1)
    votes[:, len(chosen)] = np.where(number >= 2, 1, np.where(number == 0, -1, 0))
    votes[:, len(chosen) + 1 : -1] = patterns
    votes[:, -1] = np.where(y > 0, 1, -1)
    return votes


def tree_of(joint: np.ndarray) -> list[int]:
    """Each voter's parent: the maximum spanning tree of the voters' mutual information given the label, from the last one.

    joint: (label, voter, vote, voter, vote) weights. Ties go to the lower voter; the root's parent is itself.
    """
    p = joint / max(1e-12, joint[:, 0, :, 0, :].sum())
    own = np.einsum("yjvjv->yjv", p)
    of_label = own.sum(2)[:, :1, None]
    with np.errstate(divide="ignore", invalid="ignore"):
        ratio = p * of_label[:, :, :, None, None] / (own[:, :, :, None, None] * own[:, None, None, :, :])
        info = np.where(p > 0, p * np.log(ratio), 0).sum((0, 2, 4)).round(12)
    m = info.shape[0]
    parent, best, left = [m - 1] * m, info[m - 1].copy(), set(range(m - 1))
    while left:
        j = max(sorted(left), key=lambda x: best[x])
        left.remove(j)
        for k in left:
            if info[j, k] > best[k]:
                best[k], parent[k] = info[j, k], j
    return parent


def label_model(votes: np.ndarray, prior: float, rounds: int = 60, smooth: float = 5.0, silent: int = 0) -> tuple[np.ndarray, list[int]]:
    """Posterior of label 1 for rows of votes (-1, 0, 1), and the voters' tree, by expectation-maximisation.

    The generative model: a label is drawn, then each voter's vote given the label and the vote of one other voter, its
    parent. So every voter has a probability of each vote under each label (its accuracy), and each edge of the tree a table
    of how its two voters agree beyond what the label explains (their correlation); all are estimated. The tree is the one of
    the most information given the label, found again while the posterior still moves in the first rounds. The last voter
    is the given label: it is the root, and starts the estimate. Tables lean towards no correlation by the weight of
    `smooth` rows: with less, a few rows that label 0 has wrongly gained make what they share usual there, and more follow.
    The first `silent` voters tell nothing where they abstain. Lexicons are such: those of one language abstain together in
    every other, which no tree can say, so that their silence would outweigh the voters that have spoken.
    """
    n, m = votes.shape
    hot = np.zeros((n, m, 3))
    hot[np.arange(n)[:, None], np.arange(m)[None], votes + 1] = 1
    flat = hot.reshape(n, 3 * m)
    post = np.where(votes[:, -1] > 0, 0.95, 0.05)
    parent: list[int] = []
    for r in range(rounds):
        joint = np.stack([(flat * w[:, None]).T @ flat for w in (1 - post, post)]).reshape(2, m, 3, m, 3)
        if r in (0, 3, 6):
            parent = tree_of(joint)
        single = np.einsum("yjvjv->yjv", joint)
        alone = (single + 0.5) / (single.sum(2, keepdims=True) + 1.5)
        odds = np.full(n, np.log(prior / (1 - prior)))
        for j, of in enumerate(parent):
            if of == j:
                told = np.log(alone[1, j] / alone[0, j])[votes[:, j] + 1]
            else:
                given = (joint[:, of, :, j, :] + smooth * alone[:, j][:, None, :]) / (single[:, of][:, :, None] + smooth)
                told = np.log(given[1] / given[0])[votes[:, of] + 1, votes[:, j] + 1]
            odds += told if j >= silent else np.where(votes[:, j] == 0, 0.0, told)
        new = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        moved, post = np.abs(new - post).max(), new
        if r > 6 and moved < 1e-6:
            break
    return post, parent


def train(
    features: np.ndarray, lengths: np.ndarray, patterns: np.ndarray, y: np.ndarray, voters: int = 32, steps: int = 1000, l2: float = 1e-5, rate_of_change: float = 0.1, positive: float = 2.0, rare: int = 8
) -> tuple[dict[int, float], float]:
    """Weights by feature and the bias. features: those of all rows, one after the other (32 bits); lengths: of each row.

    Features in fewer than `rare` rows tell nothing and are most of all. They go in two steps, first by counts of a fixed
    number of cells, so that memory stays near that of the features themselves.
    """
    n = len(y)
    if not n or y.min() == y.max():
        share = (y.sum() + 0.5) / (n + 1)
        return {}, float(np.log(share / (1 - share)))
    doc = np.repeat(np.arange(n, dtype=np.int32), lengths)
    cell = features & np.int32((1 << 22) - 1)
    keep = np.bincount(cell, minlength=1 << 22)[cell] >= rare
    del cell
    doc, features = doc[keep], features[keep]
    ids, col, tot = np.unique(features, return_inverse=True, return_counts=True)
    often = tot >= rare
    keep = often[col]
    doc, col = doc[keep], (np.cumsum(often) - 1)[col[keep]].astype(np.int32)
    ids, tot = ids[often], tot[often]
    rate = y.mean()
    found = lexicons(doc, col, y, len(ids), voters)
    q, _ = label_model(voted(doc, col, found, patterns, y), rate, silent=len(found))
    # the linear classifier: logistic regression on soft labels, features that tell something
    z = (np.bincount(col, y[doc], len(ids)) - tot * rate) / np.sqrt(tot * rate * (1 - rate) + 1e-9)
    chosen = np.flatnonzero(np.abs(z) > 4)
    at = np.full(len(ids), -1)
    at[chosen] = np.arange(len(chosen))
    keep = at[col] >= 0
    d, c = doc[keep], at[col][keep]
    w, bias = np.zeros(len(chosen)), float(np.log(rate / (1 - rate)))
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for t in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(bias + np.bincount(d, w[c], n), -30, 30)))
        e = (p - q) * (1 + (positive - 1) * q)  # rare positives weigh more
        g = np.bincount(c, e[d], len(w)) / n + l2 * w
        gb = float(e.mean())
        m, v, mb, vb = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g, 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        w -= rate_of_change * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
        bias -= rate_of_change * (mb / (1 - 0.9**t)) / (vb / (1 - 0.99**t)) ** 0.5 if vb else 0
    big = np.abs(w) > 1e-3
    return {int(ids[i]) & 0xFFFFFFFF: float(x) for i, x in zip(chosen[big], w[big])}, float(bias)


def features_of(text: str | None) -> tuple[np.ndarray, tuple[int, ...]]:
    """A text's distinct features as 32-bit numbers, and the votes of the patterns."""
    words = _WORD.findall((text or "").lower())
    times = counted(Counter(words))
    all_of = [*times, *(level(f, k) for f, c in times.items() if c > 1 for k in LEVELS if c >= k)]
    return np.unique(np.array(all_of, np.uint32)).view(np.int32), patterns(text or "", words)


def _is_held(c, of: int, at: int):
    return F.coalesce(F.pmod(F.crc32(c.cast("string").cast("binary")), F.lit(of)) == at, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", held_out_of: int = 4, held_out_is: int = 2, sample_rows: int = 8000) -> tuple[dict[int, float], float]:
    """The classifier's weights by feature, and its bias: see toxicity."""
    spark = docs.sparkSession
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    labelled = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("y")).where("doc_id is not null and y is not null")
    labelled = labelled.where(~_is_held(F.col("doc_id"), held_out_of, held_out_is)).groupBy("doc_id").agg(F.max("y").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    chosen = spark.createDataFrame([tuple(r) for r in labelled.collect()], "doc_id long, y int")  # at most sample_rows
    schema = pa.schema([("doc_id", pa.int64()), ("features", pa.binary()), ("votes", pa.binary()), ("y", pa.int32())])

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [features_of(t) for t in b.column(1).to_pylist()]
            yield batch(schema, b.column(0), [x[0].tobytes() for x in found], [np.array(x[1], np.int8).tobytes() for x in found], b.column(2))

    sample = map_batches(d.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "y"), extract, "doc_id long, features binary, votes binary, y int").toArrow()
    ids, features, votes, y = (sample.column(k).to_pylist() for k in range(4))
    del sample
    order = sorted(range(len(ids)), key=lambda k: (ids[k], features[k]))  # whatever order the rows came in
    flat = np.frombuffer(b"".join([features[k] for k in order]), np.int32)
    lengths = np.array([len(features[k]) // 4 for k in order], np.int64)
    of_patterns = np.frombuffer(b"".join([votes[k] for k in order]), np.int8).reshape(-1, len(PATTERNS))
    del features
    return train(flat, lengths, of_patterns, np.array([y[k] for k in order], float))


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", held_out_of: int = 4, held_out_is: int = 2, sample_rows: int = 8000, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score (0 to 1), predicted.

    Learns from labelled rows that aren't held out (crc32 of the id as text, mod `held_out_of`, is not `held_out_is`): the
    `sample_rows` of them that come first by a hash of the id, a documented bound that keeps the fit on the driver small.
    Voters are lexicons mined from those rows, a word or stem each (see lexicons), how many of them agree, patterns, and the
    given label; the label model's posterior (see label_model) trains a logistic regression on words and stems. The score
    reads the whole text and nothing else.

    Null and empty texts get the score of a text without any known feature. A null id counts as an empty one and isn't
    held out. Labels that are null are ignored; of several for a document the highest holds. Without labels all scores
    are one half. Repeated rows are answered each; other columns are ignored.
    """
    spark = docs.sparkSession
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    model = spark.sparkContext.broadcast(fit(docs, labels, id_col, text_col, label_col, held_out_of, held_out_is, sample_rows))
    out_schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = model.value
        known = {f for f in weights}
        cache: dict[str, tuple] = {}

        def telling(w: str) -> tuple:
            f = cache.get(w)
            if f is None:
                if len(cache) > 500_000:
                    cache.clear()
                f = cache[w] = tuple(x for x in word_features(w) if x in known or any(level(x, k) in known for k in LEVELS))
            return f

        for b in batches:
            scores = []
            for text in b.column(2).to_pylist():
                total = bias
                for f, c in sorted(counted(Counter(_WORD.findall((text or "").lower())), telling).items()):
                    total += weights.get(f, 0.0) + sum(weights.get(level(f, k), 0.0) for k in LEVELS if c >= k)
                scores.append(1 / (1 + np.exp(-np.clip(total, -30, 30))))
            yield batch(out_schema, b.column(0), b.column(1), np.array(scores, float), np.array([s >= threshold for s in scores], np.int32))

    return map_batches(d.select("doc_id", _is_held(F.col("doc_id"), held_out_of, held_out_is).alias("held_out"), "text"), score, "doc_id long, held_out boolean, score double, predicted int")
