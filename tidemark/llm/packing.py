"""Lexical retrieval packing: BM25 neighbours of each seed document fill its window of tokens."""

from __future__ import annotations

import base64
import sys
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Table, batch, map_batches, texts
from .hashing import chunks, hash_spans

_SPECIAL = "<|endoftext|>"
_VOCABULARY = 1 << 16


def _bytes(ids: list[int]) -> bytes:
    """Little-endian, 16 bits each."""
    out = array("H", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


class Encoder:
    """Token ids of whole texts as little-endian 16-bit bytes, equal to those of the `tokenizers` file.

    Texts are cut at blanks: a pre-token of this vocabulary never runs from a non-blank into a blank. The pieces of many
    texts are told apart by 64-bit hashes, all at once, and each distinct one is encoded once, in one call of tiktoken's form
    of the same vocabulary; ids are then laid out piece by piece, without an object for any of them. Texts with odd runs of
    blanks, which show as pieces that are empty or end with white space, are encoded whole, and texts that spell the special
    token by `tokenizers` itself.
    """

    def __init__(self, tokenizer_json: str, ranks_file: str, pattern: str):
        import tiktoken

        with open(ranks_file, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.tokenizer_json = tokenizer_json
        self.sizes = np.zeros(_VOCABULARY, np.int64)
        for token, k in ranks.items():
            self.sizes[k] = len(token)

    def whole(self, text: str) -> bytes:
        if _SPECIAL in text:
            from tokenizers import Tokenizer

            return _bytes(Tokenizer.from_file(self.tokenizer_json).encode(text, add_special_tokens=False).ids)
        return _bytes(self.encoding.encode_ordinary(text))

    def __call__(self, text: str) -> bytes:
        return self.many([text.encode()])[0]

    def many(self, texts: list[bytes]) -> list[bytes]:
        raw = b" " + b" ".join(texts) + b" " + b"\0" * 8
        blanks = np.flatnonzero(np.frombuffer(raw, np.uint8)[:-8] == 32)
        first, size = blanks[:-1] + 1, np.diff(blanks) - 1
        heads = np.searchsorted(first, np.cumsum([1, *(len(t) + 1 for t in texts)])[:-1])  # each text's first piece
        _, at, piece = np.unique(hash_spans(raw, first, size), return_index=True, return_inverse=True)
        span = [raw[a : a + n] for a, n in zip(first[at].tolist(), size[at].tolist())]
        odd = np.array([not x or x[-1] <= 32 or x[-1] >= 128 and x.decode()[-1].isspace() for x in span], bool)
        whole = np.logical_or.reduceat(np.where(np.isin(np.arange(len(piece)), heads), False, odd[piece]), heads)
        whole |= np.fromiter((_SPECIAL.encode() in t for t in texts), bool, len(texts))
        pool, start, length = self._pieces(span, ~odd)
        # first pieces have no blank before them, so they are entries of their own
        opening = [self.whole(raw[a : a + n].decode()) if n and not w else b"" for a, n, w in zip(first[heads].tolist(), size[heads].tolist(), whole.tolist())]
        counts = np.array([len(x) // 2 for x in opening], np.int64)
        piece[heads] = len(span) + np.arange(len(texts))
        start, length = np.r_[start, len(pool) + np.cumsum(counts) - counts], np.r_[length, counts]
        pool = np.concatenate([pool, np.frombuffer(b"".join(opening), "<u2")])
        n = length[piece]
        upto = np.cumsum(n)
        place = np.repeat((start[piece] - (upto - n)).astype(np.int32), n)
        place += np.arange(len(place), dtype=np.int32)
        ids = pool[place].tobytes()
        ends = 2 * upto[np.r_[heads[1:], len(piece)] - 1]
        out = [ids[a:z] for a, z in zip([0, *ends[:-1].tolist()], ends.tolist())]
        for k in np.flatnonzero(whole).tolist():
            out[k] = self.whole(texts[k].decode())
        return out

    def _pieces(self, span: list[bytes], wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of all wanted pieces, each after a blank, one after the other, and where each one's are."""
        asked = np.flatnonzero(wanted)
        start, length = np.zeros(len(span), np.int64), np.zeros(len(span), np.int64)
        if not len(asked):
            return np.empty(0, "<u2"), start, length
        mine = [span[k] for k in asked.tolist()]
        pool = np.frombuffer(_bytes(self.encoding.encode_ordinary(" " + b" ".join(mine).decode())), "<u2")
        stop = np.cumsum([len(x) + 1 for x in mine])
        reached = np.cumsum(self.sizes[pool])
        last = np.searchsorted(reached, stop)
        if not (reached[np.minimum(last, len(reached) - 1)] == stop).all():
            raise AssertionError("a token runs across a blank: this vocabulary's texts can't be cut there")
        start[asked], length[asked] = np.r_[0, last[:-1] + 1], np.diff(np.r_[-1, last])
        return pool, start, length


_encoders: dict[tuple, Encoder] = {}


def encoder(*args: str) -> Encoder:
    if args not in _encoders:
        _encoders[args] = Encoder(*args)
    return _encoders[args]


def tokenize(docs: DataFrame, id_col: str, text_col: str, vocabulary: tuple[str, str, str], end_id: int = 1) -> DataFrame:
    """(doc_id, ids as 16-bit bytes with the end id, n). A null text is an empty one."""
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("n", pa.int64())])
    end = int(end_id).to_bytes(2, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(*vocabulary)
        held: list[tuple] = []

        def closed() -> Iterator[pa.RecordBatch]:
            for part in chunks(held, 1, 5 << 20):
                found = encode.many([r[1] for r in part])
                for k in range(0, len(part), 500):
                    yield batch(schema, [r[0] for r in part[k : k + 500]], [x + end for x in found[k : k + 500]], [len(x) // 2 + 1 for x in found[k : k + 500]])
            held.clear()

        size = 0
        for b in batches:  # together, as pieces that come again are encoded once
            held += zip(b.column(0).to_pylist(), (t or b"" for t in texts(b.column(1))))
            size += b.nbytes
            if size > 5 << 20:
                yield from closed()
                size = 0
        yield from closed()

    return map_batches(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")), run, "doc_id long, ids binary, n long")


def document_frequency(tokens: DataFrame) -> np.ndarray:
    """Documents that hold each token id: at most 65,536 numbers, whatever the corpus holds."""
    schema = pa.schema([("token", pa.int32()), ("df", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(_VOCABULARY, np.int64)
        for b in batches:
            parts = b.column(0).to_pylist()
            toks = np.frombuffer(b"".join(parts), "<u2").astype(np.uint32)
            key = (np.repeat(np.arange(len(parts), dtype=np.uint32), [len(x) // 2 for x in parts]) << np.uint32(16)) | toks
            key.sort()
            if len(key):
                count += np.bincount(key[np.r_[True, key[1:] != key[:-1]]] & np.uint32(0xFFFF), minlength=_VOCABULARY)
        (there,) = np.nonzero(count)
        yield batch(schema, there.astype(np.int32), count[there])

    out = np.zeros(_VOCABULARY, np.int64)
    for r in map_batches(tokens.select("ids"), run, "token int, df long").groupBy("token").agg(F.sum("df").alias("df")).collect():
        out[r.token] = r.df
    return out


class Block:
    """The inverted index of one bounded block of documents, and those that are still unused."""

    def __init__(self, parts: list[np.ndarray], idf: np.ndarray, mean: float, query_terms: int, candidates: int, k1: float = 1.2, b: float = 0.75):
        n = len(parts)
        lengths = np.array([len(p) for p in parts], np.int64)
        key = (np.repeat(np.arange(n, dtype=np.uint32), lengths) << np.uint32(16)) | np.concatenate(parts).astype(np.uint32)
        key.sort()
        starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        tf = np.diff(np.r_[starts, len(key)]).astype(np.float32)
        key = key[starts]
        doc, tok = (key >> np.uint32(16)).astype(np.int32), (key & np.uint32(0xFFFF)).astype(np.int32)
        known = idf[tok] > 0
        doc, tok, tf = doc[known], tok[known], tf[known]
        weight = idf[tok] * (tf * np.float32(k1 + 1) / (tf + (k1 * (1 - b + b * lengths / mean)).astype(np.float32)[doc]))
        self.doc_at = np.searchsorted(doc, np.arange(n + 1))
        self.tok, self.weight = tok, weight
        order = np.argsort(tok, kind="stable")
        self.post_doc, self.post_weight = doc[order], weight[order]
        self.post_at = np.searchsorted(tok[order], np.arange(_VOCABULARY + 1))
        self.unused, self.query_terms, self.candidates, self.n = np.ones(n, bool), query_terms, candidates, n
        self.asked = np.zeros(_VOCABULARY, bool)

    def neighbours(self, seed: int) -> np.ndarray:
        """BM25 of the unused documents for the seed's terms.

        The seed's `query_terms` most telling terms find the `candidates` best documents, which are then scored by all
        terms. The others keep the score by the first terms, which is never more than their own.
        """
        a, z = self.doc_at[seed], self.doc_at[seed + 1]
        terms, weight = self.tok[a:z], self.weight[a:z]
        if not len(terms):
            return np.zeros(self.n)
        telling = terms
        if len(terms) > self.query_terms:
            telling = terms[np.argpartition(-weight, self.query_terms)[: self.query_terms]]
        spans = [slice(self.post_at[t], self.post_at[t + 1]) for t in telling]
        scores = np.bincount(np.concatenate([self.post_doc[s] for s in spans]), np.concatenate([self.post_weight[s] for s in spans]), self.n)
        scores[~self.unused] = 0
        if len(terms) > self.query_terms:
            best = np.argpartition(-scores, self.candidates)[: self.candidates] if self.n > self.candidates else np.arange(self.n)
            best = best[scores[best] > 0]
            sizes = self.doc_at[best + 1] - self.doc_at[best]
            first = np.r_[0, np.cumsum(sizes)]
            if len(best):
                entry = np.arange(first[-1]) + np.repeat(self.doc_at[best] - first[:-1], sizes)
                self.asked[terms] = True
                scores[best] = np.add.reduceat(np.where(self.asked[self.tok[entry]], self.weight[entry], np.float32(0)), first[:-1], dtype=np.float64)
                self.asked[terms] = False
        return scores


def pack(
    docs: DataFrame,
    vocabulary: tuple[str, str, str],
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = 2048,
    end_id: int = 1,
    shard_tokens: int = 8_000_000,
    block_tokens: int = 2_000_000,
    block_docs: int = 4096,
    query_terms: int = 48,
    candidates: int = 64,
) -> DataFrame:
    """Packs every token of every document into windows of `window` tokens and returns a row for each piece.

    vocabulary: the tokenizer's json, the same vocabulary as tiktoken ranks, and its pattern. Columns: doc_id, start (its
    document's ids before the piece), length, ids_crc32, doc_tokens, sequence_id, offset, ids (the piece's ids as
    little-endian 16-bit bytes).

    The index is sharded: documents are range-partitioned by their rarest token that another document shares, so that
    lexical neighbours and copies meet, and by doc_id within, so that no key can overfill a shard. Each shard is read as a
    stream of blocks of bounded size, each with its own inverted index (document frequencies and the mean length are those
    of the whole corpus). A seed's BM25 ranks the block's unused documents, which fill its window in that order; the one that
    overruns it is cut, and its rest seeds the next window. Ranking goes in two steps: the seed's `query_terms` most telling
    terms name `candidates` documents, all its terms score them. Neighbours in other blocks are out of reach: a search of
    the whole corpus for every document grows with its square. A shard's last window is cut at powers of two, so nothing is
    padded there either.

    Null texts are empty (one end token). Rows with a null doc_id are packed as any other; repeated rows are packed each.
    An empty table gives no rows. Other columns are ignored.
    """
    spark = docs.sparkSession
    tokens = Table(tokenize(docs, id_col, text_col, vocabulary, end_id), "tokens")
    total, n_docs = tokens.df.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    df = document_frequency(tokens.df)
    mean = max(1.0, total / max(1, n_docs))
    idf = np.where(df >= 2, np.log1p((n_docs - df + 0.5) / (df + 0.5)), 0).astype(np.float32)
    shared_df = np.where(df >= 2, df, np.iinfo(np.int64).max)
    const = spark.sparkContext.broadcast((idf, shared_df))  # two arrays of 65,536 numbers

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rare = const.value[1]
        schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("n", pa.int64()), ("sign", pa.int32())])
        for b in batches:
            signs = [int(t[np.argmin(rare[t])]) for t in (np.frombuffer(x, "<u2") for x in b.column(1).to_pylist())]
            yield batch(schema, b.column(0), b.column(1), b.column(2), signs)

    piece_schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary())])

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf = const.value[0]
        sequence, space = TaskContext.get().partitionId() << 32, window
        rows: list[tuple] = []
        opened: list[tuple] = []  # pieces of the window that isn't full yet

        def place(doc, start: int, length: int) -> None:
            nonlocal sequence, space, opened
            opened.append((doc, start, length, window - space))
            space -= length
            if not space:
                close()

        def close() -> None:
            nonlocal sequence, space, opened
            for (doc_id, ids), start, length, offset in opened:
                part = ids[start : start + length]
                rows.append((doc_id, start, length, zlib.crc32(part.astype("<u4").tobytes()), len(ids), sequence, offset, part.tobytes()))
            opened, space, sequence = [], window, sequence + 1

        def put(doc, start: int) -> None:
            """Lays a document's rest into windows; the last of them stays open."""
            while start < len(doc[1]):
                length = min(space, len(doc[1]) - start)
                place(doc, start, length)
                start += length

        def block(docs: list[tuple]) -> None:
            index = Block([d[1] for d in docs], idf, mean, query_terms, candidates)
            for seed in range(index.n):
                while seed is not None and index.unused[seed]:
                    index.unused[seed] = False
                    put(docs[seed], 0)
                    scores = index.neighbours(seed)
                    seed = None
                    # fill what is left of the window with the best neighbours; the one that is cut seeds the next
                    while space < window:
                        best = int(scores.argmax())
                        if scores[best] <= 0:
                            break
                        scores[best] = 0
                        if len(docs[best][1]) > space:
                            seed = best
                            break
                        index.unused[best] = False
                        put(docs[best], 0)

        def flushed() -> pa.RecordBatch:
            out = batch(piece_schema, *([r[i] for r in rows] for i in range(8)))
            rows.clear()
            return out

        held, size = [], 0
        for b in batches:
            for doc_id, ids in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                held.append((doc_id, np.frombuffer(ids, "<u2")))
                size += len(ids) // 2
                if size >= block_tokens or len(held) >= block_docs:
                    block(held)
                    held, size = [], 0
                    yield flushed()
        if held:
            block(held)
        rest, opened, space = opened, [], window
        left = sum(r[2] for r in rest)
        while left:  # the last window, at powers of two
            room = 1 << (left.bit_length() - 1)
            left -= room
            at = 0
            while room:
                doc, start, length, _ = rest.pop(0)
                take = min(length, room)
                opened.append((doc, start, take, at))
                at += take
                room -= take
                if take < length:
                    rest.insert(0, (doc, start + take, length - take, 0))
            close()
        yield flushed()

    shards = max(1, -(-int(total) // shard_tokens))
    signed = map_batches(tokens.df, sign, "doc_id long, ids binary, n long, sign int")
    dealt = signed.repartitionByRange(shards, "sign", "doc_id").sortWithinPartitions("sign", "doc_id").select("doc_id", "ids")
    return map_batches(dealt, fill, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary")
