"""Cross-tokenizer alignment: where two vocabularies cut a text at the same byte, and which of their ids stand together."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Table, batch, map_batches, texts
from .hashing import chunks, hash_spans

#: Bytes of text that are aligned at once (each takes some fifty bytes meanwhile), and that share a dictionary of id pairs.
PART, BLOCK = 1 << 20, 24 << 20

#: The last bytes of UTF-8 white space beyond ASCII, by the byte that it starts with.
_WIDE = {0xC2: (0x85, 0xA0), 0xE1: (0x80,), 0xE2: (*range(0x80, 0x8B), 0xA8, 0xA9, 0xAF, 0x9F), 0xE3: (0x80,)}
_ENDS = np.zeros((256, 256), bool)
for _lead, _last in _WIDE.items():
    _ENDS[_lead, list(_last)] = True
_ASCII = np.zeros(256, bool)
_ASCII[[*range(9, 14), *range(28, 33)]] = True

_DIGITS = np.array([list(str(k).ljust(6).encode()) for k in range(1 << 16)], np.uint8)
_LENGTHS = np.array([len(str(k)) for k in range(1 << 16)], np.int64)


def safe_cuts(flat: np.ndarray) -> np.ndarray:
    """Places of blanks after anything but white space: neither vocabulary has a token that runs into such a blank.

    White space is told by its last byte and the byte that can start it, which may take a letter for white space, never the
    other way round.
    """
    at = np.flatnonzero(flat == 32)
    at = at[at > 0]
    white = _ASCII[flat[at - 1]] | _ENDS[flat[np.maximum(at - 2, 0)], flat[at - 1]] | _ENDS[flat[np.maximum(at - 3, 0)], flat[at - 1]]
    return at[~white]


class Aligner:
    """Tokens of a batch of texts by both vocabularies, and where their ends meet.

    Each text is read with a blank before it. It is cut at safe blanks; the distinct spans of a batch are encoded once.
    """

    def __init__(self, ranks_file: str, pattern: str, piece_file: str):
        import sentencepiece
        import tiktoken

        with open(ranks_file, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.first = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.second = sentencepiece.SentencePieceProcessor(model_file=piece_file)
        self.first_bytes = [b""] * (1 + max(ranks.values()))
        for token, k in ranks.items():
            self.first_bytes[k] = token
        of = lambda k, p: bytes([int(p[3:-1], 16)]) if self.second.is_byte(k) else p.replace("▁", " ").encode()
        self.second_bytes = [of(k, self.second.id_to_piece(k)) for k in range(self.second.vocab_size())]
        if max(len(self.first_bytes), len(self.second_bytes)) > 1 << 16:
            raise ValueError("ids beyond 65535: digests are made for smaller vocabularies")
        if any("▁" in p.lstrip("▁") or p.startswith("▁") and "▁" in p.lstrip("▁") for p in map(self.second.id_to_piece, range(self.second.vocab_size()))):
            raise ValueError("a piece runs across a blank: texts can't be cut there")
        self.sizes = tuple(np.array([len(x) for x in table], np.int64) for table in (self.first_bytes, self.second_bytes))

    def _encoded(self, spans: list[bytes]) -> tuple[list[tuple[np.ndarray, np.ndarray, np.ndarray]], np.ndarray]:
        """Of both vocabularies (all ids, where each span's begin, how many), and which spans both give back byte by byte.

        Spans come without the blank before them.
        """
        words = [s.decode() for s in spans]
        first: list[list[int]] = [[]] * len(spans)
        plain = [k for k, w in enumerate(words) if w and not w[-1].isspace()]
        ids = np.array(self.first.encode_ordinary("".join(" " + words[k] for k in plain)), np.int64)
        stop = np.cumsum([len(spans[k]) + 1 for k in plain])
        reached = np.cumsum(self.sizes[0][ids]) if len(ids) else np.empty(0, np.int64)
        last = np.searchsorted(reached, stop)
        if len(stop) and not (reached[np.minimum(last, len(reached) - 1)] == stop).all():
            raise AssertionError("a token runs across a blank: this vocabulary's texts can't be cut there")
        begin = 0
        flat = ids.tolist()
        for k, end in zip(plain, (last + 1).tolist()):
            first[k] = flat[begin:end]
            begin = end
        for k, w in enumerate(words):
            if not w or w[-1].isspace():
                first[k] = self.first.encode_ordinary(" " + w)
        second = self.second.encode(words, num_threads=1) if words else []
        a, b = self.first_bytes.__getitem__, self.second_bytes.__getitem__
        good = np.fromiter((b"".join(map(a, x)) == (whole := b" " + s) == b"".join(map(b, y)) for s, x, y in zip(spans, first, second)), bool, len(spans))
        out = []
        for rows in (first, second):
            n = np.fromiter(map(len, rows), np.int64, len(rows))
            pool = np.fromiter((x for r in rows for x in r), np.int64, int(n.sum()))
            out.append((pool, np.cumsum(n) - n, n))
        return out, good

    def __call__(self, texts: list[bytes]) -> Aligned:
        raw = b"".join(b" " + t for t in texts) + b"\0" * 8
        flat = np.frombuffer(raw, np.uint8)[:-8]
        sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
        begins = np.cumsum(sizes) - sizes
        cuts = safe_cuts(flat)
        start = np.union1d(begins, np.setdiff1d(cuts, begins + sizes - 1))  # a text's last blank stays with what is before it
        size = np.diff(np.r_[start, len(flat)])
        _, at, span = np.unique(hash_spans(raw, start, size), return_index=True, return_inverse=True)
        tokens, good = self._encoded([raw[a + 1 : a + n] for a, n in zip(start[at].tolist(), size[at].tolist())])
        heads = np.searchsorted(start, begins)
        valid = (np.logical_and.reduceat(good[span], heads) if len(heads) else np.empty(0, bool)) & (sizes > 1)
        span = span[np.repeat(valid, np.diff(np.r_[heads, len(span)]))]
        ids, ends = [], []
        for (pool, where, count), width in zip(tokens, self.sizes):
            n = count[span]
            upto = np.cumsum(n)
            ids.append(pool[np.repeat(where[span] - (upto - n), n) + np.arange(int(upto[-1]) if len(upto) else 0)])
            ends.append(np.cumsum(width[ids[-1]]))
        return Aligned.of(np.where(valid, sizes, 0), ids, ends)


class Aligned(NamedTuple):
    """What texts of a batch have, one entry a text but for `pairs`: all linked ids, a << 16 | b in 32 bits, cut by `n_links`."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    groups: list[bytes]
    pairs: np.ndarray

    @classmethod
    def of(cls, sizes: np.ndarray, ids: list[np.ndarray], ends: list[np.ndarray]) -> Aligned:
        """Both vocabularies' ids and byte ends over all texts, laid end to end; `sizes`: each text's bytes.

        Tokens have a byte at least, so at one offset one token of each ends at most, and a cut is a link.
        """
        total = int(sizes.sum())
        stop = np.cumsum(sizes)
        counts = [np.bincount(e, minlength=total + 1).astype(np.int32) for e in ends]
        cut = (counts[0] > 0) & (counts[1] > 0)
        upto = [np.cumsum(c, dtype=np.int32) for c in counts]  # prefix sums over bytes: a text's figures are differences
        cuts = np.cumsum(cut, dtype=np.int32)
        links = np.cumsum(counts[0] * counts[1] * cut, dtype=np.int32)
        per = lambda x: np.diff(x[np.r_[0, stop]]).astype(np.int64)
        at = np.flatnonzero(cut)
        pairs = (ids[0][upto[0][at] - 1] << 16 | ids[1][upto[1][at] - 1]).astype(np.uint32)
        # the digest's text: within a group the first vocabulary's ids, then the second's
        group = [cuts[e - 1] for e in ends]
        before = np.r_[0, upto[1][at]]
        place = [np.arange(len(ids[0])) + before[group[0]], np.arange(len(ids[1])) + upto[0][at][group[1]]]
        n = len(ids[0]) + len(ids[1])
        number, mark = np.empty(n, np.int64), np.empty(n, np.uint8)
        number[place[0]], number[place[1]] = ids
        last = np.zeros(total + 1, bool)
        last[stop] = True
        mark[place[0]] = np.where(cut[ends[0]], ord("|"), ord(","))
        mark[place[1]] = np.where(last[ends[1]], 0, np.where(cut[ends[1]], ord(";"), ord(",")))
        length = _LENGTHS[number]
        letters = _DIGITS[number]
        letters[np.arange(n), length] = mark
        length += mark > 0
        written = letters[np.arange(6) < length[:, None]].tobytes()
        bound = np.cumsum(np.r_[0, length])[(upto[0] + upto[1])[np.r_[0, stop]]].tolist()
        return cls(per(upto[0]), per(upto[1]), per(cuts), per(links), [written[a:z] for a, z in zip(bound, bound[1:])], pairs)


_aligners: dict[tuple, Aligner] = {}


def aligner(*files: str) -> Aligner:
    if files not in _aligners:
        _aligners[files] = Aligner(*files)
    return _aligners[files]


def parts_of(text: bytes, limit: int) -> list[bytes]:
    """A very long text in parts of about `limit` bytes, cut at safe blanks, which the parts leave out."""
    if len(text) <= limit:
        return [text]
    cuts = safe_cuts(np.frombuffer(text, np.uint8))
    cuts = cuts[cuts < len(text) - 1]
    out, begin = [], 0
    while len(text) - begin > limit:
        k = np.searchsorted(cuts, begin + limit, "right") - 1
        if k < 0 or cuts[k] <= begin:  # no blank within the limit: the part is longer
            k += 1
            while k < len(cuts) and cuts[k] <= begin:
                k += 1
            if k >= len(cuts):
                break
        out.append(text[begin : cuts[k]])
        begin = int(cuts[k]) + 1
    return [*out, text[begin:]]


def _measured(docs: DataFrame, vocabularies: tuple[str, str, str], part: int, block: int) -> DataFrame:
    """A row a text with its links as places in its block's dictionary, and a row a block with the dictionary."""
    schema = pa.schema([("block", pa.int64()), ("doc_id", pa.int64()), *((c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")), ("groups_sha256", pa.string()), ("links", pa.binary()), ("pairs", pa.binary()), ("times", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align = aligner(*vocabularies)
        number = TaskContext.get().partitionId() << 32
        waiting: list[tuple] = []  # (row, part of its text, whether it is the last)
        rows: list[tuple] = []
        size = held = 0

        def measured() -> None:
            for some in chunks(waiting, 1, part):
                got = align([r[1] for r in some])
                bound = np.cumsum(np.r_[0, got.n_links])
                for k, (row, text, end) in enumerate(some):
                    if text and not got.n_a[k]:
                        row["bad"] = True
                    if not row["bad"] and text:
                        if row["n"].any():
                            row["sha"].update(b";")
                        row["sha"].update(got.groups[k])
                        row["n"] += (got.n_a[k], got.n_b[k], got.n_groups[k], got.n_links[k])
                        row["pairs"].append(got.pairs[bound[k] : bound[k + 1]])
                    if end:
                        n = row["n"] * 0 if row["bad"] else row["n"]
                        pairs = np.concatenate([np.empty(0, np.uint32), *([] if row["bad"] else row["pairs"])])
                        rows.append((row["doc_id"], n.tolist(), row["sha"].hexdigest() if n[0] else "", pairs))
            waiting.clear()

        def closed() -> Iterator[pa.RecordBatch]:
            nonlocal number
            pairs, times = np.unique(np.concatenate([np.empty(0, np.uint32), *(r[3] for r in rows)]), return_counts=True)
            order = np.argsort(-times, kind="stable")
            place = np.empty(len(order), np.uint32)
            place[order] = np.arange(len(order), dtype=np.uint32)
            for k in range(0, len(rows), 500):
                some = rows[k : k + 500]
                links = [place[np.searchsorted(pairs, r[3])].tobytes() for r in some]  # looked up row by row: no place of a whole block's links is held
                none = pa.nulls(len(some), pa.binary())
                yield batch(schema, [number] * len(some), [r[0] for r in some], *([r[1][i] for r in some] for i in range(4)), [r[2] for r in some], links, none, none)
            yield batch(schema, [number], *([None] for _ in range(7)), [pairs[order].astype(np.int64).tobytes()], [times[order].astype(np.int64).tobytes()])
            rows.clear()
            number += 1

        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), texts(b.column(1))):
                row = {"doc_id": doc_id, "n": np.zeros(4, np.int64), "sha": hashlib.sha256(), "pairs": [], "bad": not text}
                some = parts_of(text or b"", part)
                waiting += [(row, x, k == len(some) - 1) for k, x in enumerate(some)]
                size += len(text or b"")
                held += len(text or b"")
                if size > part:
                    measured()
                    size = 0
            if held > block:
                measured()
                size = held = 0
                yield from closed()
        measured()
        if rows:
            yield from closed()

    fields = "block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links binary, pairs binary, times binary"
    return map_batches(docs, run, fields)


def _exploded(dictionaries: DataFrame) -> DataFrame:
    schema = pa.schema([("block", pa.int64()), ("place", pa.int32()), ("pair", pa.int64()), ("times", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for block, pairs, times in zip(*(c.to_pylist() for c in b.columns)):
                pairs, times = np.frombuffer(pairs, np.int64), np.frombuffer(times, np.int64)
                for k in range(0, len(pairs), 100_000):
                    n = len(pairs[k : k + 100_000])
                    yield batch(schema, pa.array(np.full(n, block)), pa.array(np.arange(k, k + n, dtype=np.int32)), pa.array(pairs[k : k + n]), pa.array(times[k : k + n]))

    return map_batches(dictionaries, run, "block long, place int, pair long, times long")


class Alignment(NamedTuple):
    docs: DataFrame
    pairs: DataFrame


def align(docs: DataFrame, vocabularies: tuple[str, str, str], id_col: str = "doc_id", text_col: str = "text", part: int = PART, block: int = BLOCK) -> Alignment:
    """Aligns the tokens of a byte-level BPE and of a sentencepiece model over every whole text.

    vocabularies: the first one's ranks, its pattern, the second one's model file. Texts are read with a blank before them.
    Returns `docs` (doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), a row for each row, and
    `pairs` (a, b, count, best): how many links of all texts hold the two ids, and whether no other first id has more with b.

    A batch's texts lie end to end; the token ends of either vocabulary are counted by byte once, a group ends where both
    have one, and a text's figures are differences of prefix sums at its bounds. Links are kept as places in a dictionary
    of their block (24 MB of text); only dictionaries, summed by block, are shuffled by id pair, and their counts go back
    to the blocks. A pair that every block holds is one row a block: sums are combined before the shuffle, and the join back
    has one row on its other side, so that a skewed part can be split.

    Null and empty texts, and texts whose tokens don't spell them (U+2581 in the text is one case), have zeros and an empty
    digest. Null ids, repeated rows and other columns do no harm: rows are never joined by id. An empty table gives empty
    tables. Very long texts are aligned in parts cut at blanks; only one without a blank is held as a whole.
    """
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    measured = Table(_measured(d, vocabularies, part, block), "alignment")
    entries = _exploded(measured.df.where("pairs is not null").select("block", "pairs", "times"))
    sums = Table(entries.groupBy("pair").agg(F.sum("times").alias("count")), "alignment-pairs")
    b = F.col("pair").bitwiseAND(F.lit(0xFFFF)).cast("int")
    most = sums.df.groupBy(b.alias("b")).agg(F.max("count").alias("most"))
    # a row for each id of the second vocabulary: 65,536 at most
    counted = sums.df.withColumn("b", b).join(F.broadcast(most), "b").select("pair", F.shiftright("pair", 16).cast("int").alias("a"), "b", "count", (F.col("count") == F.col("most")).alias("best"))
    answers = entries.select("block", "place", "pair").join(counted.select("pair", "count", "best"), "pair").select("block", "place", "count", "best")
    rows = measured.df.where("pairs is null").drop("pairs", "times")
    schema = pa.schema([("doc_id", pa.int64()), *((c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")), ("groups_sha256", pa.string())])

    def told(left: pa.Table, right: pa.Table) -> pa.Table:
        n = right.num_rows
        count, best = np.zeros(n + 1, np.int64), np.zeros(n + 1, np.int64)
        place = right.column("place").to_numpy()
        count[place], best[place] = right.column("count").to_numpy(), right.column("best").to_numpy(zero_copy_only=False)
        n_best, total = [], []
        for x in left.column("links").to_pylist():
            at = np.frombuffer(x, np.uint32)
            n_best.append(int(best[at].sum()))
            total.append(int(count[at].sum()))
        added = {"n_best": pa.array(n_best, pa.int64()), "count_sum": pa.array(total, pa.int64())}
        return pa.Table.from_arrays([added[f.name] if f.name in added else left.column(f.name) for f in schema], schema=schema)

    out = rows.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(told, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
    return Alignment(out, counted.drop("pair"))
