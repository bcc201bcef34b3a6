"""Spelling variants against a plain count and plain comparisons of all words."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from tests.conftest import SF
from tests.llm.test_llm import ODD, docs, odd, pairs  # noqa: F401
from tidemark.llm import spelling
from tidemark.llm.queries import QUERIES


def words_of(rows, least=3):
    total = Counter()
    for d, t in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        for w in re.findall("[A-Za-zÀ-ÿ]+", low):
            h = zlib.crc32(f"{'' if d is None else d}:{w}".encode())
            if h % 97 == 0:
                k = h % len(w)
                w = w[:k] + w[k + 1 :]
            total[w] += 1
    return {w: n for w, n in total.items() if len(w) >= 5 and n >= least}


def near_by_deletion(words):
    """Words at one edit, by the words that one deletion makes, and a plain test of each pair."""
    by = {}
    for w in words:
        for x in {w, *(w[:k] + w[k + 1 :] for k in range(len(w)))}:
            by.setdefault(x, []).append(w)
    near = {w: set() for w in words}
    for group in by.values():
        for a in group:
            for b in group:
                if a != b and edit_one(a, b):
                    near[a].add(b)
    return near


def edit_one(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute(words):
    near, form = near_by_deletion(words), {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 2 * n else None
    out = set()
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n, len(near[w]), words.get(form[w])))
    return out


def test_query_equals_brute_force(spark, docs):  # noqa: F811
    got = [tuple(r) for r in QUERIES["op12_spelling"](spark, SF).collect()]
    want = brute(words_of(pairs(docs)))
    assert len(got) == len(want) and set(got) == want
    assert sum(r[1] is not None for r in want) > 20 and any(r[2] != r[1] and r[1] for r in want)


def test_odd_rows_and_empty(spark, odd):  # noqa: F811
    rows = [*ODD, *ODD, *ODD]
    got = {tuple(r) for r in spelling.spelling_variants(odd.union(odd).union(odd)).collect()}
    assert got == brute(words_of(rows))
    assert spelling.spelling_variants(odd.limit(0)).count() == 0


@pytest.mark.parametrize("long_list", [40, 3])
def test_long_lists_are_split_without_loss(spark, long_list):
    r = random.Random(long_list)
    words = {}
    for _ in range(1500):
        words["".join(r.choice("abé") for _ in range(r.randint(5, 9)))] = r.randint(3, 99)
    words |= {"aaaaa": 9, "aaaaaa": 5, "aaaaaaa": 3, "ÿÿÿÿÿ": 4, "ÿÿÿÿ×": 8}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    got = [(x.word, x.near, x.n, x.near_n) for x in spelling.near_words(df, long_list).collect()]
    near = near_by_deletion(words)
    want = {(a, b, words[a], words[b]) for a in near for b in near[a]}
    assert len(got) == len(want) and set(got) == want


def test_forms_lead_to_roots(spark):
    words = {"house": 3, "houses": 7, "housess": 20, "hhousess": 50, "xhhousess": 99, "garden": 5, "gardex": 10, "gardey": 10}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    got = {tuple(r) for r in spelling.variants(df).select("word", "form", "root", "n", "n_near", "form_n").collect()}
    assert got == brute(words)
    assert {r[0]: r[2] for r in got}["house"] == "hhousess" and {r[0]: r[1] for r in got}["garden"] == "gardex"
