"""Weakly supervised quality: rules vote or abstain, expectation-maximisation weighs them, a posterior decides."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WHITE, Table, batch, map_batches, passed, texts

SYMBOLS = b"#*$%&|<>"
#: Bytes inside a character: all others begin one.
_INNER = bytes(range(0x80, 0xC0))

#: (rule, statistic, votes bad at or beyond, votes good at or within): between the two it abstains. Rules overlap, and some
#: are often wrong by themselves (clean texts can have long words, few distinct ones, or be short).
RULES = (
    ("symbols", "symbol_share", 0.20, 0.02),
    ("symbol_chars", "symbol_char_share", 0.05, 0.01),
    ("marked_words", "marked_share", 0.15, 0.05),
    ("word_length", "length_off", 1.5, 1.0),
    ("poor_words", "same_share", 0.40, 0.20),
    ("repeats", "repeat_share", 0.10, 0.02),
    ("dup_lines", "dup_line_share", 0.30, 0.05),
    ("shouting", "upper_share", 0.20, 0.05),
    ("exclaims", "exclaim_share", 0.15, 0.03),
    ("digits", "digit_share", 0.15, 0.03),
    ("stutter", "stutter_share", 0.10, 0.02),
    ("short", "shortness", 0.02, 0.01),
)

_STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_exclaims", "n_digits", "n_distinct", "n_marked", "n_stutters")


def repeated(words: list[bytes], size: int = 8) -> int:
    """Words inside windows of `size` (a power of two) words that occur twice or more. Exact: windows are compared by rank."""
    n = len(words)
    if n <= size:
        return 0
    seen: dict[bytes, int] = {}
    rank = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, n)
    step, most = 1, len(seen)
    while step < size:
        if most == len(rank):  # every window is unique already
            return 0
        pair = rank[:-step] * most + rank[step:]
        _, rank = np.unique(pair, return_inverse=True)
        most = int(rank.max()) + 1
        step *= 2
    if most == len(rank):
        return 0
    twice = np.bincount(rank)[rank] > 1
    edge = np.zeros(n + 1, np.int64)
    (at,) = np.nonzero(twice)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + size, -1)
    return int((np.cumsum(edge)[:-1] > 0).sum())


def measure(text: bytes | None) -> tuple[int, ...]:
    """The statistics of one whole text, in the order of _STATS."""
    raw = text or b""
    words = raw.split()
    points = len(raw.translate(None, _INNER))
    kept, dup, seen = 0, 0, set()
    for line in raw.split(b"\n"):
        if line.strip(WHITE):
            kept += 1
            if line in seen:
                dup += 1
            else:
                seen.add(line)
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    white = len(raw) - len(raw.translate(None, WHITE))
    return (
        len(words), points - white, symbols, dup, repeated(words), kept,
        sum(w.isupper() for w in words), raw.count(b"!"), len(raw) - len(raw.translate(None, b"0123456789")), len(set(words)),
        sum(len(w) != len(w.translate(None, SYMBOLS)) for w in words) if symbols else 0,
        sum(map(bytes.__eq__, words, words[1:])),
    )


def fit(patterns: np.ndarray, counts: np.ndarray, rounds: int = 500) -> tuple[np.ndarray, np.ndarray]:
    """Posterior probability of good for each vote pattern (rows of -1, 0, 1), and each rule's accuracies (good, bad).

    Votes are independent given quality, and abstentions say nothing. A rule has an accuracy for either class, each free
    between 0 and 1 but for one vote of either kind that smooths it: a text with one defect often lacks the others, so most
    rules are mostly wrong of bad texts, and the estimate finds out how much a vote for good is worth. It starts from how
    many rules vote bad: two or more, one, or none. That start is all that tells the classes apart.
    """
    good, bad = (patterns > 0).astype(float), (patterns < 0).astype(float)
    n_bad = bad.sum(1)
    post = np.where(n_bad >= 2, 0.05, np.where(n_bad == 1, 0.7, 0.95))
    on_good = on_bad = np.full(patterns.shape[1], 0.5)
    for _ in range(rounds):
        w1, w0 = counts * post, counts * (1 - post)
        on_good = (w1 @ good + 1) / (w1 @ (good + bad) + 2)
        on_bad = (w0 @ bad + 1) / (w0 @ (good + bad) + 2)
        prior = (w1.sum() + 1) / (counts.sum() + 2)
        odds = np.log(prior / (1 - prior)) + good @ np.log(on_good / (1 - on_bad)) + bad @ np.log((1 - on_good) / on_bad)
        new = 1 / (1 + np.exp(-np.clip(odds, -40, 40)))
        moved, post = np.abs(new - post).max(initial=0), new
        if moved < 1e-9:
            break
    return post, np.stack([on_good, on_bad])


def vote(m: tuple[int, ...]) -> tuple[int, ...]:
    """The rules' votes on what `measure` gives."""
    x = dict(zip(_STATS, m))
    words, chars, lines = max(1, x["n_words"]), max(1, x["word_chars"]), max(1, x["n_lines"])
    shares = {
        "symbol_share": x["n_symbols"] / words, "symbol_char_share": x["n_symbols"] / chars, "marked_share": x["n_marked"] / words, "repeat_share": x["n_repeat_words"] / words,
        "dup_line_share": x["n_dup_lines"] / lines, "upper_share": x["n_upper"] / words, "exclaim_share": x["n_exclaims"] / words, "length_off": abs(x["word_chars"] / words - 6.0),
        "digit_share": x["n_digits"] / chars, "same_share": 1 - x["n_distinct"] / words, "stutter_share": x["n_stutters"] / words, "shortness": 1 / words,
    }
    return tuple(-1 if shares[s] >= bad else 1 if shares[s] <= good else 0 for _, s, bad, good in RULES)


def _votes(m: tuple[int, ...]) -> str:
    return ",".join(map(str, vote(m)))


def fails(m: tuple[int, ...], min_words: int, max_repeat_percent: int) -> bool:
    """The base rules."""
    return m[0] < min_words or 100 * m[4] > max_repeat_percent * m[0]


def posteriors(voted: DataFrame) -> dict[str, float]:
    """Votes as text to the posterior probability of good, for every pattern of votes in the column `votes`."""
    counted = voted.groupBy("votes").count().collect()  # 3 to the number of rules at most, however many texts there are
    counted.sort(key=lambda r: r.votes)
    patterns = np.array([[int(x) for x in r.votes.split(",")] for r in counted], float).reshape(-1, len(RULES))
    post, _ = fit(patterns, np.array([r["count"] for r in counted], float))
    return {r.votes: float(p) for r, p in zip(counted, post)}


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5, min_words: int = 20, max_repeat_percent: int = 30) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, posterior, votes.

    Each rule of RULES votes +1, -1 or 0 on a statistic of the whole text. The votes of all documents with `min_words` or
    more are counted by pattern, and expectation-maximisation over those counts gives the rules' accuracies and each
    pattern's posterior probability of good quality. kept: the base rules hold and that posterior is at least `threshold`.

    Null and empty texts have no words and fail the base. Rows with null ids and repeated rows are answered each. An
    empty table gives no rows. Other columns are ignored.
    """
    spark = docs.sparkSession
    schema = pa.schema([("doc_id", pa.int64()), *((s, pa.int64()) for s in _STATS), ("votes", pa.string()), ("base_failed", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [measure(t) for t in texts(b.column(1))]
            yield batch(schema, b.column(0), *([r[i] for r in rows] for i in range(len(_STATS))), [_votes(r) for r in rows], [fails(r, min_words, max_repeat_percent) for r in rows])

    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    voted = Table(map_batches(d, run, "doc_id long, " + ", ".join(f"{s} long" for s in _STATS) + ", votes string, base_failed boolean"), "quality")
    known = posteriors(voted.df.where(F.col("n_words") >= min_words))
    known = spark.createDataFrame(list(known.items()), "votes string, posterior double")
    out = voted.df.join(F.broadcast(known), "votes", "left")
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & F.coalesce(F.col("posterior") >= threshold, F.lit(False))).alias("kept"), "posterior", "votes")


def keep_good(docs: DataFrame, text_col: str = "text", threshold: float = 0.5, min_words: int = 20, max_repeat_percent: int = 30) -> DataFrame:
    """The rows of `docs` that `quality` keeps, with all their columns.

    Texts are read twice, once for the votes and once to filter, and never written or shuffled. Null and empty texts go;
    repeated rows stay or go together; ids aren't looked at. An empty table gives no rows.
    """
    schema = pa.schema([("votes", pa.string())])

    def votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield batch(schema, [_votes(m) for m in map(measure, texts(b.column(0))) if m[0] >= min_words])

    sent = docs.sparkSession.sparkContext.broadcast(posteriors(map_batches(docs.select(F.col(text_col).cast("string").alias("text")), votes, "votes string")))
    at = docs.columns.index(text_col)

    def good(text: bytes | None) -> bool:
        m = measure(text)
        return not fails(m, min_words, max_repeat_percent) and sent.value.get(_votes(m), 0.0) >= threshold

    return passed(docs, lambda b: b.filter(pa.array([good(t) for t in texts(b.column(at))], pa.bool_())))
