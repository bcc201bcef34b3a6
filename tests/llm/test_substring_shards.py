"""Automata with more words than they hold are several, and windows across their seams are found."""

import random

from tests.llm import brute
from tidemark.llm import substring


def test_cut_passages():
    r = random.Random(3)
    words = [f"w{r.randint(0, 200)}" for _ in range(400)]
    text = " ".join(words).encode()
    docs = [(7, " ".join(words[a : a + 130])) for a in range(0, 270, 30)]
    whole = substring.automata([(1, text)], 50)
    cut = substring.automata([(1, text), (2, text[: len(text) // 2])], 50, most=60)
    assert len(whole) == 1 and len(cut) > 5
    for doc_id, t in docs:
        want = next(iter(x for x in brute.substrings([(1, text.decode()), (doc_id, t)]) if x[0] == doc_id))[2]
        for made in (whole, cut):
            gone = {k for a in made for lo, hi in a.occurrences(doc_id, t.encode()) for k in range(lo, hi)}
            assert len(gone) == want == 130
    assert substring.automata([], 50) == []


def test_a_place_is_told_once_however_many_passages_have_it():
    r = random.Random(4)
    common = [f"c{k}" for k in range(60)]
    passages = [(k, " ".join([*common, *(f"w{r.randint(0, 999)}" for _ in range(40))]).encode()) for k in range(2, 400)]
    (made,) = substring.automata(passages, 50)
    assert made.occurrences(900, " ".join(["x", *common, "y"]).encode()) == [(1, 61)]
    assert made.occurrences(2, " ".join(common).encode()) == []
    assert made.occurrences(3, passages[0][1]) == [(0, 100)]
