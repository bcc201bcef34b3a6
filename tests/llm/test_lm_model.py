"""The mixing model against plain counting, its probabilities' sum, and its independence of shards and partitions."""

import math
from collections import defaultdict

import numpy as np
import pytest

from tests.conftest import SF
from tests.llm.test_llm import prose
from tidemark.llm import lm


def fitted(docs, shards=1):
    keys, counts = np.unique(lm.keys_of(docs)[0], return_counts=True)
    low = lm.summed(keys & np.uint64(0xFFFFFF), counts)
    of = lm.shard_of(keys, shards)
    return keys, counts, low, lm.Mixer([lm.learn(lm.Counters(keys[of == k], counts[of == k], low)) for k in range(shards)])


def plain_bits(train, mixer, text):
    """Bit by bit: the model's log2 probability of a text."""
    seen = defaultdict(int)
    for d in train:
        raw = b"\n" * 5 + d + b"\0"
        for i in range(5, len(raw)):
            for order in range(1, 6):
                for left in range(9):
                    seen[raw[i - order : i], left, raw[i] >> left] += 1
    raw, total = b"\n" * 5 + text + b"\0", 0.0
    for i in range(5, len(raw)):
        for shift in range(7, -1, -1):
            bit, s, best, sure = raw[i] >> shift & 1, [], 0, 0
            for order in range(1, 6):
                c = raw[i - order : i]
                hit, n = seen[c, shift, raw[i] >> shift], seen[c, shift + 1, raw[i] >> (shift + 1)]
                s.append(math.log((hit + 0.2) / (n - hit + 0.2)))
                if n:
                    best, sure = order, 1 + (n > 3) + (n > 30)
            odds = sum(w * x for w, x in zip(mixer.weights[best * 4 + sure], s))
            p = 1 / (1 + math.exp(-max(-16, min(16, odds))))
            one = max(-16, min(16, odds if bit else -odds))
            cell = (1 << (7 - shift) | raw[i] >> (shift + 1)) * 33 + min(32, max(0, int(np.rint(one * 2)) + 16))
            n, ones = mixer.refine[cell]
            p = (p + ((ones if bit else n - ones) + 4 * p) / (n + 4)) / 2
            total += math.log2(min(1 - 2**-18, max(2**-18, p)))
    return total


def test_bits_are_those_of_plain_counting():
    train = [prose(k, 60).encode() for k in range(8)] + ["Ünïcode é".encode(), b""]
    keys, counts, low, mixer = fitted(train)
    for text in (train[0], prose(99, 40).encode(), b"", "Ünseen é\n".encode()):
        key, _ = lm.keys_of([text])
        asked = np.setdiff1d(key, keys)
        c = lm.Counters(*lm.summed(np.r_[keys, asked], np.r_[counts, np.zeros(len(asked), np.int64)]), low)
        got = lm.Lookup(c.keys, mixer.bits(c))(key).sum()
        assert abs(got - plain_bits(train, mixer, text)) < 1e-3 * max(1, abs(got)) ** 0.5


def test_bits_add_up():
    """After any context the 256 bytes' probabilities sum to one."""
    keys, counts, low, mixer = fitted([prose(k, 200).encode() for k in range(20)])
    for context in (0, 0x6261206B69, 0xFFFEFDFCFB):
        key = np.array([(context << 8) | b for b in range(256)], np.uint64)
        new = np.setdiff1d(key, keys)
        c = lm.Counters(*lm.summed(np.r_[keys, new], np.r_[counts, np.zeros(len(new), np.int64)]), low)
        assert abs((2.0 ** mixer.bits(c)[np.isin(c.keys, key)]).sum() - 1) < 1e-6


def test_shards_count_contexts_whole():
    """A shard's counters are those of the whole corpus."""
    docs = [prose(k, 150).encode() for k in range(20)]
    keys, counts, low, mixer = fitted(docs)
    whole = mixer.bits(lm.Counters(keys, counts, low))
    of = lm.shard_of(keys, 7)
    assert len(set(of.tolist())) == 7
    for k in range(7):
        assert np.allclose(mixer.bits(lm.Counters(keys[of == k], counts[of == k], low)), whole[of == k])


@pytest.mark.parametrize("kwargs", [{"segment_bytes": 50_000}, {"segment_bytes": 50_000, "shard_keys": 20_000}])
def test_scores_do_not_depend_on_partitions(spark, kwargs):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    one = {r.doc_id: r.score for r in lm.score(docs.repartition(1), **kwargs).collect()}
    many = {r.doc_id: r.score for r in lm.score(docs.repartition(5), **kwargs).collect()}
    assert one.keys() == many.keys() and all(abs(one[k] - many[k]) < 1e-4 * (1 + abs(one[k])) for k in one)
    train = [(r.text or "").encode() for r in docs.collect() if not lm.zlib.crc32(str(r.doc_id).encode()) % 10 == 0]
    if "shard_keys" not in kwargs:
        keys, counts, low, mixer = fitted(train)
        c = lm.Counters(keys, counts, low)
        look = lm.Lookup(c.keys, mixer.bits(c))
        for r in docs.limit(40).collect():
            if lm.zlib.crc32(str(r.doc_id).encode()) % 10:
                got = look(lm.keys_of([(r.text or "").encode()])[0]).sum() * math.log10(2)
                assert abs(got - one[r.doc_id]) < 1e-3 * (1 + abs(got))


def test_learning_helps():
    train, fresh = [prose(k, 300).encode() for k in range(30)], [prose(500 + k, 100).encode() for k in range(5)]
    keys, counts, low, mixer = fitted(train)
    key, _ = lm.keys_of(fresh)
    new = np.setdiff1d(key, keys)
    c = lm.Counters(*lm.summed(np.r_[keys, new], np.r_[counts, np.zeros(len(new), np.int64)]), low)
    learned = lm.Lookup(c.keys, mixer.bits(c))(key).mean()
    start = lm.Lookup(c.keys, lm.Mixer([]).bits(c))(key).mean()
    assert learned > start and learned > -2.0
