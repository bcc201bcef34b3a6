"""Leaders by content: the bounds that make the search narrow, and the rounds, against judging one text after the other."""

from __future__ import annotations

import difflib
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF
from tidemark.functions.text import normalized, ratio, simhash_py
from tidemark.operators import dedup, scratch, similar


def words(r, n):
    some = ["the", "a", "tion", "ing", "quiz", "jazz", "over", "vex", "who", "ble", "zoo", "and", "house", "river", "x", "kept"]
    return " ".join(r.choice(some) + r.choice(["", "", "s", "ed", "y"]) for _ in range(n))


def changed(r, text, share):
    out = list(text)
    for _ in range(int(share * len(out))):
        k = r.randrange(len(out))
        out[k] = r.choice(["", "e", "q", " ", out[k] + "t"])
    return normalized("".join(out))


def test_decided_early_is_decided_right():
    r = random.Random(1)
    for _ in range(300):
        a = normalized(words(r, r.randint(1, 90)))
        b = changed(r, a, r.choice([0.0, 0.02, 0.06, 0.12, 0.3])) if r.random() < 0.8 else normalized(words(r, 60))
        for floor in (0.88, 0.5):
            assert similar.at_least(a, b, floor) == (ratio(a, b) >= floor)
    assert not similar.at_least("", "x", 0.1) and similar.at_least("x", "x", 1.0)


def test_bounds_hold():
    """Blocks, shared grams and histograms of pairs that are alike, and of whatever floor they reach."""
    r, seen = random.Random(2), 0
    for _ in range(400):
        a = normalized(words(r, r.randint(5, 300)))
        b = changed(r, a, r.choice([0.0, 0.01, 0.03, 0.05]))
        floor, m = ratio(a, b), difflib.SequenceMatcher(None, a, b)
        if not a or not b or floor < 0.7:
            continue
        seen += 1
        blocks = [x for x in m.get_matching_blocks() if x.size]
        assert len(blocks) <= similar.most_blocks(b, floor)
        assert similar.may_match(a, b, floor)
        x, y = (dict(zip(*(v.tolist() for v in similar.winnowed(t)))) for t in (a, b))
        assert sum(min(n, x.get(h, 0)) for h, n in y.items()) >= similar.shared_grams(b, floor)
    assert seen > 200


def rows_of(r, n):
    texts = [normalized(words(r, r.randint(1, 120))) for _ in range(n)]
    line = normalized(words(r, 60))
    for k in range(n):
        if r.random() < 0.35:
            texts.append(changed(r, texts[k], r.choice([0.0, 0.01, 0.04, 0.08])))
        if r.random() < 0.2:
            texts.append(line + " " + normalized(words(r, r.randint(1, 60))))
        if r.random() < 0.25:
            texts.append(changed(r, texts[0], 0.01))
    texts += ["", "", texts[1]]
    r.shuffle(texts)
    return [{"id": f"i{k:04d}", "ord": k, "anchor": k < 5, "platform": r.choice("ab"), "norm_title": "", "norm_full": t, "simhash": simhash_py(t), "url_hash": None, "external_id": None} for k, t in enumerate(texts)]


@pytest.mark.parametrize(("seed", "few", "patience", "cross"), [(3, 24, 6, True), (4, 2, 6, False), (5, 2, 1, True)])
def test_equals_one_after_the_other(spark, seed, few, patience, cross):
    rows = rows_of(random.Random(seed), 60)
    want = dedup.sequential([x | {"ord": (not x["anchor"], x["ord"])} for x in rows], cross_platform=cross)
    df = spark.createDataFrame(rows, "id string, ord int, anchor boolean, platform string, norm_title string, norm_full string, simhash string, url_hash string, external_id string")
    out = similar.content_leaders(df, cross=cross, few=few, patience=patience).collect()
    assert {r.id: r.duplicate_of for r in out} == want
    assert all(r.leader == (r.duplicate_of is None) for r in out)
    assert sum(v is not None for v in want.values()) >= 15


def test_with_titles_and_groups(spark):
    r = random.Random(9)
    rows = rows_of(r, 40)
    for x in rows:
        x |= {"norm_title": x["norm_full"][:30] if r.random() < 0.5 else "", "url_hash": f"u{r.randrange(30)}" if r.random() < 0.3 else None, "external_id": f"e{r.randrange(40)}" if r.random() < 0.3 else None}
    want = dedup.sequential(rows)
    df = spark.createDataFrame(rows, "id string, ord int, anchor boolean, platform string, norm_title string, norm_full string, simhash string, url_hash string, external_id string")
    assert {x.id: x.duplicate_of for x in dedup.deduplicate(df, by_grams=True).collect()} == want
    assert sum(v is not None for v in want.values()) >= 15


def test_empty_and_released(spark):
    none = spark.createDataFrame([], "id string, ord int, anchor boolean, platform string, norm_full string, simhash string")
    assert similar.content_leaders(none).count() == 0
    assert scratch.release() >= 1


def test_documents(spark):
    """The registered query over whole texts, against the rule, one document after the other."""
    from tidemark.plans.queries import QUERIES

    got = {r.doc_id: r.duplicate_of for r in QUERIES["dedup_documents"](spark, SF).collect()}
    rows = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    items = [{"id": r.doc_id, "ord": r.doc_id, "anchor": False, "platform": r.source, "norm_title": "", "norm_full": (t := normalized(r.text)), "simhash": simhash_py(t), "url_hash": None, "external_id": None} for r in rows]
    kept, want = [], {}
    for x in items:  # the rule; pairs that common grams rule out aren't matched by sequence
        found = next((y["id"] for y in kept if bin(int(x["simhash"], 16) ^ int(y["simhash"], 16)).count("1") <= dedup.GATE and similar.may_match(x["norm_full"], y["norm_full"], 0.88) and ratio(x["norm_full"], y["norm_full"]) >= 0.88), None)
        want[x["id"]] = found
        kept += [x] if found is None else []
    assert got == want and sum(v is not None for v in want.values()) >= 3


def test_packed_grams_are_those_of_several_texts(spark, monkeypatch):
    """The grams that more than one text has, by owner and times, packed in few and in many rows of few bytes a gram."""
    from collections import Counter

    r = random.Random(21)
    texts = [normalized(words(r, 60)) for _ in range(30)]
    texts += [changed(r, t, 0.02) for t in texts[:15]] + [texts[0] + " " + texts[1], texts[2] * 300, "short"]
    df = spark.createDataFrame([(10**12 + k, t, len(t)) for k, t in enumerate(texts)], "cls long, text string, n int").coalesce(2)
    kept = [dict(zip(*(v.tolist() for v in similar.winnowed(t)))) for t in texts]
    owners = Counter(h for x in kept for h in x)
    want = sorted((10**12 + k, n, owners[h]) for k, x in enumerate(kept) for h, n in x.items() if owners[h] > 1)
    for most in (2_000, 1_000_000):
        monkeypatch.setattr(similar, "PACKED", most)
        got = similar._shared(df).collect()
        assert sorted((x.cls, x.times, x.texts) for x in got) == want and len({x.gram for x in got}) == sum(n > 1 for n in owners.values())
    assert max(n for _, n, _ in want) > 255 and len(want) > 200
    assert similar._shared(df.limit(0)).count() == 0
