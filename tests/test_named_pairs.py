"""What is named for comparison, and what of it is on disk at once."""

import random

from tests.test_similar import words
from tidemark.functions.text import normalized, ratio
from tidemark.operators import scratch, similar


def test_one_shared_sentence_names_few_pairs(spark):
    """Texts made of the same sentences in all: most that share one are not named, copies with a word changed are."""
    r = random.Random(31)
    some = [normalized(" ".join("".join(r.choice("etaoinshrl" * 12 + "wzx") for _ in range(r.randint(2, 9))) for _ in range(5))) for _ in range(900)]
    held = [r.sample(range(900), 40) for _ in range(60)]
    texts = [" ".join(some[k] for k in x) for x in held]
    texts += [t.replace(" ", " q ", 1) for t in texts[:10]]
    rows = [(f"i{k}", k, t, "0" * 16, None, k, k) for k, t in enumerate(texts)]
    items = spark.createDataFrame(rows, "id string, ord int, text string, simhash string, scope string, k1 int, k2 int")
    with scratch.Scratch(spark) as s:
        classes = s.table(similar._classes(items, 0.88), "classes")
        place = {x.cls: x.k1 for x in classes.collect()}
        could = {x.k1 for x in classes.collect() if x.need > 0}
        named = {(place[x.a], place[x.b]) for x in similar._named(classes, 0.88, 22, 24, None, s)[0].collect()}
    one = {(a, b) for a in range(60) for b in range(a) if len({*held[a]} & {*held[b]}) == 1}
    assert len(could) > 60 and len(one) > 400 and len(one & named) < len(one) / 10
    want = {(k + 60, k) for k in range(10) if ratio(texts[k + 60], texts[k]) >= 0.88}
    assert len(want) >= 5 and want <= named


def test_rounds_find_what_one_finds(spark):
    r = random.Random(32)
    texts = sorted({normalized(words(r, r.choice([3, 8, 30]))) for _ in range(90)} - {""})
    texts = sorted({*texts, *(t + " zz" for t in texts)})
    df = spark.createDataFrame([(f"c{k}", t, len(t), 0, None, k % 3) for k, t in enumerate(texts)], "cls string, text string, n int, bits long, scope string, need int")
    want = {tuple(x) for x in similar.met(df, 0.88, 22, most=40).collect()}
    got = [tuple(x) for x in similar.met(df, 0.88, 22, most=40, shipped=3_000).collect()]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 20
    assert scratch.release() >= 2
    sizes = [(True, k, 100 + 5 * k, 104 + 5 * k, 10, 1000) for k in range(8)] + [(False, k, 100 + 5 * k, 104 + 5 * k, 100, 10_000) for k in range(40)]
    place, pairs = similar._plan(sizes, 0.8, 200)
    first = min(at for existing, _, at, _ in place if not existing)
    assert all(i < first for i, _, _ in pairs) and any(j >= first for _, j, _ in pairs)
    for rounds in (similar._rounds(pairs, 30_000), similar._rounds(pairs, 1)):
        assert sorted({v[1] for visits in rounds for v in visits}) == list(range(len(pairs))) and len(rounds) > 1


def test_a_table_leaves_no_shuffle(spark):
    df = spark.range(1000).repartition(3).groupBy("id").count()
    with scratch.Scratch(spark) as s:
        manager = spark._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker()
        held = manager.shuffleStatuses().size()
        assert s.table(df, "counted").count() == 1000
        assert manager.shuffleStatuses().size() <= held + 1  # that of the count itself
        assert spark.conf.get(scratch._CLEANUP, None) is None
