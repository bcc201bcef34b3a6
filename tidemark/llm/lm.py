"""Language-model scoring: online logistic mixing of hashed-context bit predictors, refined adaptively."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Table, batch, map_batches, texts
from .hashing import chunks, hash_texts

#: The longest context in bytes; there is a predictor for each length from one on.
ORDERS = 5
#: Contexts up to this length are the same in all shards; longer ones lie in one shard, which goes by so many bytes and one.
_SHARED = 2
_LEVELS = 4  # of confidence: how often the longest context was seen
_GATES = (ORDERS + 1) * _LEVELS
_BUCKETS = 33
_STEP = 1024  # keys that are predicted with the same weights
_BLOCK = 1 << 16
_END = b"\0"
_DELTA = np.float32(0.2)
_SHIFTS = np.arange(8)[:, None]


def keys_of(docs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """For each byte of each text and its end: the byte and the five before it, as one number; and the documents' starts."""
    pad = b"\n" * ORDERS
    flat = np.frombuffer(b"".join(chain.from_iterable((pad, d, _END) for d in docs)), np.uint8)
    lengths = np.array([len(d) + 1 for d in docs], np.int64)
    starts = np.cumsum(np.r_[0, lengths])
    own = np.ones(len(flat), bool)
    begin = starts[:-1] + ORDERS * np.arange(len(docs))
    for k in range(ORDERS):
        own[begin + k] = False
    n = len(flat) - ORDERS
    key = np.zeros(n, np.uint64)
    for k in range(ORDERS + 1):
        key <<= np.uint64(8)
        key |= flat[k : k + n]
    return key[own[ORDERS:]], starts


def _mixed(x: np.ndarray) -> np.ndarray:
    return (x * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    """By the last bytes of the context, so that all that longer contexts are counted by lies in one shard."""
    context = (keys >> np.uint64(8)) & np.uint64((1 << 8 * (_SHARED + 1)) - 1)
    return (_mixed(_mixed(context) + context) % np.uint64(shards)).astype(np.int64)


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sums of their counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    new = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[new], np.add.reduceat(counts, new)


def _packed(keys: np.ndarray) -> bytes:
    return zlib.compress(np.diff(keys, prepend=np.uint64(0)).tobytes(), 1)


def _unpacked(raw: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(zlib.decompress(raw), np.uint64), dtype=np.uint64)


class Counters:
    """The bit counters of some keys' contexts: for each order, how often its context and a beginning of the byte occur.

    keys: sorted, distinct; counts: of each in the training texts (zero for keys that are only asked for). For contexts of up
    to _SHARED bytes `low` has the distinct last bytes (context and byte) of the whole corpus and their counts.
    """

    def __init__(self, keys: np.ndarray, counts: np.ndarray, low: tuple[np.ndarray, np.ndarray]):
        self.keys, self.counts, self.at, self.sums = keys, counts, [], []
        for order in range(1, ORDERS + 1):
            v = keys & np.uint64((1 << 8 * (order + 1)) - 1)
            if order <= _SHARED:
                base, c = summed(low[0] & np.uint64((1 << 8 * (order + 1)) - 1), low[1])
                u = np.union1d(base, v)
                of = np.zeros(len(u), np.int64)
                of[np.searchsorted(u, base)] = c
                at = np.searchsorted(u, v)
            else:
                u, at = np.unique(v, return_inverse=True)
                of = np.zeros(len(u), np.int64)
                np.add.at(of, at, counts)
            total, sums = np.r_[0, np.cumsum(of)], np.empty((9, len(u)), np.float32)
            for bits in range(9):  # the low bits of the byte that are left open
                p = u >> np.uint64(bits)
                first = np.flatnonzero(np.r_[True, p[1:] != p[:-1]]) if len(u) else np.empty(0, np.int64)
                last = np.r_[first[1:], len(u)] if len(u) else first
                sums[bits] = np.repeat(total[last] - total[first], last - first)
            self.at.append(at)
            self.sums.append(sums)

    def inputs(self, which: np.ndarray, own: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of the keys `which`, by bit from the lowest: the orders' log-odds of the true bit, the gate, the bit, the node.

        own: 1 to leave one occurrence of the key itself out of all counters, as if it came after all others.
        """
        s = np.empty((ORDERS, 8, len(which)), np.float32)
        best, sure = np.zeros((8, len(which)), np.int64), np.zeros((8, len(which)), np.int64)
        for k in range(ORDERS):
            g = self.sums[k][:, self.at[k][which]] - np.float32(own)
            hit, n = g[:8], g[1:]
            s[k] = np.log((hit + _DELTA) / (n - hit + _DELTA))
            there = n > 0
            best[there] = k + 1
            level = there.astype(np.int64) + (n > 3) + (n > 30)
            sure[there] = level[there]
        byte = (self.keys[which] & np.uint64(255)).astype(np.int64)[None]
        return s, best * _LEVELS + sure, (byte >> _SHIFTS) & 1, (1 << (7 - _SHIFTS)) | (byte >> (_SHIFTS + 1))


def _chance(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -16, 16)))


def _cell(x: np.ndarray, node: np.ndarray) -> np.ndarray:
    """The refinement's cell: what is known of the byte, and the mixed log-odds that the bit is one."""
    return node * _BUCKETS + np.clip(np.rint(np.clip(x, -16, 16) * 2).astype(np.int64) + _BUCKETS // 2, 0, _BUCKETS - 1)


def learn(counters: Counters) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Mixing weights, how much each set was used, and the refinement's (seen, ones), learned online.

    The keys of the training texts come in the order of a hash, each with its number of occurrences. A step's keys are
    predicted, each by counters without itself, with the weights so far; then weights and refinement learn what came.
    """
    weights, seen, refine = np.full((_GATES, ORDERS), 0.3), np.zeros(_GATES), np.zeros((256 * _BUCKETS, 2))
    (there,) = np.nonzero(counters.counts > 0)
    there = there[np.argsort(_mixed(counters.keys[there]), kind="stable")]
    for block in range(0, len(there), _BLOCK):
        which = there[block : block + _BLOCK]
        s, gate, bit, node = counters.inputs(which, 1)
        times = counters.counts[which].astype(np.float64)
        for a in range(0, len(which), _STEP):
            z = slice(a, a + _STEP)
            x = s[:, :, z].reshape(ORDERS, -1)
            g, ones, n = gate[:, z].ravel(), bit[:, z].ravel(), np.broadcast_to(times[z], gate[:, z].shape).ravel()
            odds = np.einsum("kn,nk->n", x, weights[g])
            error = n * (1 - _chance(odds))
            mass = np.bincount(g, n, _GATES)
            pull = np.stack([np.bincount(g, error * k, _GATES) for k in x], 1) / np.maximum(mass, 1)[:, None]
            power = np.bincount(g, n * (x * x).sum(0), _GATES) / np.maximum(mass, 1)
            seen += mass
            rate = 0.8 / (1 + np.sqrt(seen / np.maximum(mass, 1)) / 8)
            weights = np.clip(weights + (rate / (1 + 0.25 * power))[:, None] * pull, -1, 2)
            cell = _cell(odds * (2 * ones - 1), node[:, z].ravel())
            refine[:, 0] += np.bincount(cell, n, len(refine))
            refine[:, 1] += np.bincount(cell, n * ones, len(refine))
    return weights, seen, refine


class Mixer:
    """Mixing weights and the refinement of all shards."""

    def __init__(self, parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
        self.weights, self.refine = np.full((_GATES, ORDERS), 0.3), np.zeros((256 * _BUCKETS, 2))
        if parts:
            seen = sum(p[1] for p in parts)[:, None]
            self.weights = np.where(seen > 0, sum(p[0] * p[1][:, None] for p in parts) / np.maximum(seen, 1e-9), self.weights)
            self.refine = sum(p[2] for p in parts)

    def bits(self, counters: Counters) -> np.ndarray:
        """Log2 probability of each key's last byte after the five before it."""
        out = np.empty(len(counters.keys))
        for a in range(0, len(out), _BLOCK):
            s, gate, bit, node = counters.inputs(np.arange(a, min(a + _BLOCK, len(out))), 0)
            x = np.einsum("ksn,snk->sn", s, self.weights[gate])
            p = _chance(x)
            n, ones = self.refine[_cell(x * (2 * bit - 1), node)].transpose(2, 0, 1)
            hits = np.where(bit == 1, ones, n - ones)
            out[a : a + _BLOCK] = np.log2(np.clip((p + (hits + 4 * p) / (n + 4)) / 2, 2.0**-18, 1 - 2.0**-18)).sum(0)
        return out


class Lookup:
    """Values of 64-bit keys that are all known: most by one look at a table, the others by search."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.values = keys[order], values[order]
        bits = max(10, min(24, int(2 * len(keys)).bit_length()))
        self.shift, self.table = np.uint64(64 - bits), np.zeros(1 << bits, np.int32)
        self.table[self.place(self.keys)] = np.arange(len(keys), dtype=np.int32)

    def place(self, keys: np.ndarray) -> np.ndarray:
        return (keys * np.uint64(0xD6E8FEB86659FD93)) >> self.shift

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        at = self.table[self.place(keys)]
        (miss,) = np.nonzero(self.keys[at] != keys)
        at[miss] = np.searchsorted(self.keys, keys[miss])
        return self.values[at]


def _is_held(c, of: int, at: int):
    return F.coalesce(F.pmod(F.crc32(c.cast("string").cast("binary")), F.lit(of)) == at, F.lit(False))


def _segments(d: DataFrame, segment_bytes: int) -> Table:
    """The texts, each with the number of its segment, and each segment's distinct keys with their training counts."""
    schema = pa.schema([("segment", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("text", pa.string()), ("keys", pa.binary()), ("counts", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment, size, held = TaskContext.get().partitionId() << 32, 0, []

        def closed() -> pa.RecordBatch:
            keys, counts = summed(np.concatenate([x[0] for x in held]), np.concatenate([x[1] for x in held]))
            return batch(schema, [segment], [None], [None], [None], [_packed(keys)], [zlib.compress(counts.tobytes(), 1)])

        for b in batches:
            rows = list(zip(b.column(0).to_pylist(), texts(b.column(1)), b.column(2).to_pylist()))
            for part in chunks(rows, 1, 4 << 20):
                key, starts = keys_of([r[1] for r in part])
                out = np.repeat(np.array([r[2] for r in part], bool), np.diff(starts))
                held.append(np.unique(key[~out], return_counts=True))
                if out.any():
                    asked = np.unique(key[out])
                    held.append((asked, np.zeros(len(asked), np.int64)))
                none = [None] * len(part)
                yield batch(schema, [segment] * len(part), [r[0] for r in part], [r[2] for r in part], pa.array([r[1] for r in part], pa.binary()).cast(pa.string()), none, none)
                size += len(key)
                if size >= segment_bytes:
                    yield closed()
                    segment, size, held = segment + 1, 0, []
        if held:
            yield closed()

    return Table(map_batches(d.select("doc_id", "text", "held_out"), run, "segment long, doc_id long, held_out boolean, text string, keys binary, counts binary"), "segments")


def _sizes(blobs: DataFrame, of: int = 512) -> tuple[int, int]:
    """About how many distinct keys there are, and how many all segments ask for: those of one hash value in `of` are counted."""
    schema = pa.schema([("key", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for raw in b.column(0).to_pylist():
                keys = _unpacked(raw)
                yield batch(schema, keys[_mixed(keys) % np.uint64(of) == 0].view(np.int64))

    asked = map_batches(blobs, run, "key long").groupBy("key").agg(F.count("*").alias("n"))
    distinct, all_of = asked.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    return of * distinct, of * all_of


def _model_bits(blobs: DataFrame, shard_keys: int) -> Table:
    """(segment, keys, bits) for each segment and shard: the model's log2 probabilities of the segment's keys."""
    spark = blobs.sparkSession
    distinct, asked = _sizes(blobs.select("keys"))
    shards = max(1, -(-distinct // shard_keys), -(-asked // (32 * shard_keys)))
    r_schema = pa.schema([("shard", pa.int64()), ("segment", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for segment, raw, times in zip(*(c.to_pylist() for c in b.columns)):
                keys, counts = _unpacked(raw), np.frombuffer(zlib.decompress(times), np.int64)
                of = shard_of(keys, shards)
                order = np.argsort(of, kind="stable")
                at = np.searchsorted(of[order], np.arange(shards + 1))
                for k in range(shards):
                    own = order[at[k] : at[k + 1]]
                    if len(own):
                        yield batch(r_schema, [k], [segment], [_packed(keys[own])], [zlib.compress(counts[own].tobytes(), 1)])

    requests = Table(map_batches(blobs, dealt, "shard long, segment long, keys binary, counts binary"), "requests")
    m_schema = pa.schema([("shard", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary()), ("low", pa.binary()), ("low_counts", pa.binary())])

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held, size = None, [], 0

        def closed() -> pa.RecordBatch:
            keys, counts = summed(np.concatenate([x[0] for x in held]), np.concatenate([x[1] for x in held]))
            low, times = summed(keys & np.uint64((1 << 8 * (_SHARED + 1)) - 1), counts)
            low, times = low[times > 0], times[times > 0]
            return batch(m_schema, [current], [_packed(keys)], [zlib.compress(counts.tobytes(), 1)], [_packed(low)], [times.tobytes()])

        for b in batches:
            for shard, raw, times in zip(*(c.to_pylist() for c in b.columns)):
                if shard != current:
                    if held:
                        yield closed()
                    current, held, size = shard, [], 0
                held.append((_unpacked(raw), np.frombuffer(zlib.decompress(times), np.int64)))
                size += len(held[-1][0])
                if size > 4_000_000:
                    held = [summed(np.concatenate([x[0] for x in held]), np.concatenate([x[1] for x in held]))]
                    size = len(held[0][0])
        if held:
            yield closed()

    by_shard = requests.df.select("shard", "keys", "counts").repartition(shards, "shard").sortWithinPartitions("shard")
    whole = Table(map_batches(by_shard, merged, "shard long, keys binary, counts binary, low binary, low_counts binary"), "merged")
    low = (np.empty(0, np.uint64), np.empty(0, np.int64))
    for r in whole.df.select("low", "low_counts").toLocalIterator():  # 2 to the 24th distinct numbers at most, whatever the corpus
        low = summed(np.r_[low[0], _unpacked(r.low)], np.r_[low[1], np.frombuffer(r.low_counts, np.int64)])
    shared = spark.sparkContext.broadcast(low)

    def counters(keys: bytes, counts: bytes) -> Counters:
        return Counters(_unpacked(keys), np.frombuffer(zlib.decompress(counts), np.int64), shared.value)

    l_schema = pa.schema([("part", pa.binary())])

    def learned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [learn(counters(*r)) for b in batches for r in zip(*(c.to_pylist() for c in b.columns))]
        if parts:  # of a fixed size for each task
            seen = sum(p[1] for p in parts)
            yield batch(l_schema, [zlib.compress(np.concatenate([sum(p[0] * p[1][:, None] for p in parts).ravel(), seen, sum(p[2] for p in parts).ravel()]).tobytes(), 1)])

    a, z = _GATES * ORDERS, _GATES * (ORDERS + 1)
    parts = []
    for r in map_batches(whole.df.select("keys", "counts"), learned, "part binary").toLocalIterator():
        x = np.frombuffer(zlib.decompress(r.part))
        parts.append((x[:a].reshape(_GATES, ORDERS) / np.maximum(x[a:z], 1e-9)[:, None], x[a:z], x[z:].reshape(-1, 2)))
        if len(parts) == 16:
            parts = [_one(parts)]
    mixer = spark.sparkContext.broadcast(Mixer(parts))
    b_schema = pa.schema([("segment", pa.int64()), ("keys", pa.binary()), ("bits", pa.binary())])

    def answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = None
        for b in batches:
            for segment, keys, counts in zip(*(c.to_pylist() for c in b.columns)):
                if segment is None:
                    c = counters(keys, counts)
                    found = c.keys, mixer.value.bits(c).astype(np.float32)
                else:
                    yield batch(b_schema, [segment], [keys], [found[1][np.searchsorted(found[0], _unpacked(keys))].tobytes()])

    # a shard's own row goes first, as a null segment sorts first
    both = whole.df.select("shard", F.lit(None).cast("long").alias("segment"), "keys", "counts").unionByName(requests.df.select("shard", "segment", "keys", F.lit(None).cast("binary").alias("counts")))
    both = both.repartition(shards, "shard").sortWithinPartitions("shard", "segment").select("segment", "keys", "counts")
    out = Table(map_batches(both, answered, "segment long, keys binary, bits binary"), "bits")
    requests.drop()
    whole.drop()
    return out


def _one(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return Mixer(parts).weights, sum(p[1] for p in parts), sum(p[2] for p in parts)


def score(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    held_out_of: int = 10,
    held_out_is: int = 0,
    head_words: int = 400_000,
    fold_case: bool = False,
    segment_bytes: int = 24 << 20,
    shard_keys: int = 256_000,
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte.

    Training texts are those whose crc32 of the id as text, mod `held_out_of`, is not `held_out_is`.

    Model. A text is its UTF-8 bytes and an end. Each bit of a byte is predicted by counters of the one to five bytes
    before and the bits known of this byte. A gate picks a set of weights by the longest context that was seen and how
    often; the weights mix the predictors' log-odds, and an adaptive table maps what was predicted to what came.

    What a byte's probability depends on is a key of six bytes. Texts are read in segments of about `segment_bytes`, each
    of which asks for its distinct keys; keys are dealt into shards by a hash of the three bytes before the last, about
    `shard_keys` to each and 32 times as many requests, so shards become more as the corpus grows, every longer context is
    counted whole in one of them, and no two contexts share a counter. (Counts of up to three bytes, 2 to the 24th at most,
    go to all shards.) Counts are 64-bit sums over all training texts. Weights and refinement are learned online in each shard: keys come in the order
    of a hash, each is predicted by counters without itself and with the weights so far, then learned. That is the
    predict-then-update of sequential mixing with "before" meaning all other occurrences, so that it can be learned in any
    number of shards and doesn't depend on how the texts are partitioned. Shards' weights are averaged by use.

    Base. Words of training texts are counted exactly; with `fold_case` A-Z are lowered first, in training texts and in
    those that are scored (the model reads the bytes as they are). The up to `head_words` most frequent, a documented bound,
    go to all tasks; every other word of a text is joined with the counts by shuffle, so the sum is over the whole
    vocabulary.

    Nulls: a null text is an empty one, whose only token is the end. A null id is not held out. Repeated rows are scored
    each. An empty table gives no rows; without training texts the model predicts evenly. Other columns are ignored.
    """
    spark = docs.sparkSession
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), _is_held(F.col(id_col), held_out_of, held_out_is).alias("held_out"))
    segments = _segments(d, segment_bytes)
    rows = segments.df.where("text is not null").select("segment", "doc_id", "held_out", "text")
    train = rows.where(~F.col("held_out")).select("text")
    c_schema = pa.schema([("h", pa.int64()), ("c", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def merged() -> pa.RecordBatch:
            h, c = summed(np.concatenate([x[0] for x in held]), np.concatenate([x[1] for x in held]))
            return batch(c_schema, h.view(np.int64), c)

        for b in batches:
            for part in chunks([(t,) for t in texts(b.column(0))], 0):
                held.append(np.unique(hash_texts([r[0] for r in part], fold_case)[0], return_counts=True))
                size += len(held[-1][0])
                if size > 3_000_000:
                    yield merged()
                    held, size = [], 0
        if held:
            yield merged()

    vocabulary = Table(map_batches(train, count, "h long, c long").groupBy("h").agg(F.sum("c").alias("c")), "vocabulary")
    n_train = train.count()
    bins = vocabulary.df.groupBy(F.floor(F.log2("c") * 4).alias("bin")).agg(F.count("*").alias("v"), F.sum("c").alias("c"), F.min("c").alias("least")).orderBy(F.desc("bin")).collect()
    total = sum(r.c for r in bins) + n_train
    distinct = sum(r.v for r in bins) + (1 if n_train else 0)
    least, kept = None, 0
    for r in bins:
        if kept + r.v > head_words:
            break
        kept, least = kept + r.v, r.least
    head = vocabulary.df.where(F.col("c") >= least).toArrow() if least is not None else None
    hk = head.column(0).to_numpy().view(np.uint64) if head is not None else np.empty(0, np.uint64)
    order = np.argsort(hk)
    hv = head.column(1).to_numpy()[order] if head is not None else np.empty(0, np.int64)
    end_log = math.log10(n_train + 0.1)
    words = spark.sparkContext.broadcast((hk[order], np.log10(hv + 0.1)))  # head_words at most
    answers = _model_bits(segments.df.where("keys is not null").select("segment", "keys", "counts"), shard_keys)
    s_schema = pa.schema([("uid", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("known", pa.int64()), ("base", pa.float64()), ("bits", pa.float64()), ("n_bytes", pa.int64()), ("rest", pa.list_(pa.int64())), ("times", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, logs = words.value
        uid, current, asked, values, lookup = TaskContext.get().partitionId() << 33, None, [], [], None
        for b in batches:
            docs: list[tuple] = []
            for segment, doc_id, held_out, text, own, bits in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), texts(b.column(3)), b.column(4).to_pylist(), b.column(5).to_pylist()):
                if segment != current or own is None and lookup is None:
                    if docs:
                        yield from scored(docs, lookup, keys, logs, uid)
                        uid, docs = uid + len(docs), []
                    if segment != current:
                        current, asked, values, lookup = segment, [], [], None
                if own is not None:
                    asked.append(_unpacked(own))
                    values.append(np.frombuffer(bits, np.float32))
                else:
                    if lookup is None:
                        lookup, asked, values = Lookup(np.concatenate(asked), np.concatenate(values)), [], []
                    docs.append((doc_id, text, held_out))
            if docs:
                yield from scored(docs, lookup, keys, logs, uid)
                uid += len(docs)

    def scored(docs: list[tuple], lookup: Lookup, keys: np.ndarray, logs: np.ndarray, uid: int) -> Iterator[pa.RecordBatch]:
        for part in chunks(docs, 1, 2 << 20):
            key, starts = keys_of([r[1] for r in part])
            bits = np.add.reduceat(lookup(key).astype(np.float64), starts[:-1])
            h, at = hash_texts([r[1] for r in part], fold_case)
            hit, log = np.zeros(len(h), bool), np.zeros(len(h))
            if len(keys):
                place = np.searchsorted(keys, h)
                place[place == len(keys)] = 0
                hit = keys[place] == h
                log = np.where(hit, logs[place], 0.0)
            out = []
            for k, (doc_id, text, held_out) in enumerate(part):
                a, z = at[k], at[k + 1]
                rest, times = np.unique(h[a:z][~hit[a:z]].view(np.int64), return_counts=True)
                out.append((uid, doc_id, held_out, int(z - a) + 1, int(hit[a:z].sum()) + (n_train > 0), float(log[a:z].sum()) + end_log, float(bits[k]), len(text), rest, times.astype(np.int32)))
                uid += 1
            yield batch(s_schema, *([r[i] for r in out] for i in range(10)))

    # a segment's answers go first, as null texts sort first
    none = lambda kind: F.lit(None).cast(kind)
    both = answers.df.select("segment", none("long").alias("doc_id"), none("boolean").alias("held_out"), none("string").alias("text"), "keys", "bits")
    both = both.unionByName(rows.select("*", none("binary").alias("keys"), none("binary").alias("bits")))
    both = both.repartition("segment").sortWithinPartitions("segment", F.col("text").isNotNull())
    scored_rows = Table(map_batches(both, run, "uid long, doc_id long, held_out boolean, n_tokens long, known long, base double, bits double, n_bytes long, rest array<long>, times array<int>"), "scored")
    answers.drop()
    segments.drop()
    rare = scored_rows.df.select("uid", F.explode(F.arrays_zip("rest", "times")).alias("x")).select("uid", F.col("x.rest").alias("h"), F.col("x.times").alias("t"))
    tail = vocabulary.df.where(F.col("c") < least) if least is not None else vocabulary.df
    rare = rare.join(tail, "h", "left").groupBy("uid").agg(F.sum(F.when(F.col("c").isNotNull(), F.col("t")).otherwise(0)).alias("more"), F.sum(F.col("t") * F.log10(F.coalesce("c", F.lit(0)) + 0.1)).alias("log"))
    log_all = math.log10(total + 0.1 * (distinct + 1))
    out = scored_rows.df.drop("rest", "times").join(rare, "uid", "left")
    return out.select(
        "doc_id", "held_out", "n_tokens",
        (F.col("known") + F.coalesce("more", F.lit(0))).cast("long").alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("log", F.lit(0.0)) - F.col("n_tokens") * F.lit(log_all)).alias("base_score"),
        (F.col("bits") * F.lit(math.log10(2))).alias("score"),
        (-F.col("bits") / F.greatest(F.col("n_bytes"), F.lit(1))).alias("bits_per_byte"),
    )
