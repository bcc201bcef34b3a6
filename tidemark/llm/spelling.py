"""Spelling variants: words one edit apart, by an inverted index of positional q-grams, and the form each one stands for."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Table, batch, map_batches, texts

#: Letters of a word: a-z and U+00C0 to U+00FF, coded 1 to 90; 0 stands before and after a word.
_RUN = re.compile("[a-zÀ-ÿ]+")
LETTERS = 91
_CODE = np.zeros(256, np.uint8)
_CODE[97:123] = np.arange(1, 27)
_CODE[0xC0:0x100] = np.arange(27, 91)

#: Letters of a gram. A word of n letters, padded, has n + Q - 1; one edit spoils Q at most, so near words share
#: max(n) - 1 at least, and each one's Q + 1 rarest grams hold one that is shared.
Q = 3
#: Letters that are looked at together: of words, and of candidate pairs.
_CELLS = 1 << 24


def slips(docs: DataFrame, every: int = 97) -> DataFrame:
    """(word, n): runs of letters of all whole texts, A-Z lowered, counted; some with a letter lost.

    A run loses the letter h % length if `every` divides h, the CRC of "doc_id:run" (a null id is an empty name). Null texts
    have no runs. Words are counted in each task before they are shuffled.
    """
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()

        def out() -> Iterator[pa.RecordBatch]:
            words = list(total)
            for k in range(0, len(words), 50_000):
                some = words[k : k + 50_000]
                yield batch(schema, some, [total[w] for w in some])
            total.clear()

        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), texts(b.column(1))):
                if not text:
                    continue
                seed = zlib.crc32(b"%s:" % (b"" if doc_id is None else str(doc_id).encode()))
                found = Counter(_RUN.findall(text.lower().decode()))
                for w in [w for w in found if not zlib.crc32(w.encode(), seed) % every]:
                    k = zlib.crc32(w.encode(), seed) % len(w)
                    if len(w) > 1:
                        total[w[:k] + w[k + 1 :]] += found[w]
                    del found[w]
                for w, n in found.items():
                    total[w] += n
                if len(total) > 400_000:
                    yield from out()
        yield from out()

    return map_batches(docs, run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Coded(NamedTuple):
    """Words as rows of letter codes, with Q - 1 zeros before and at least as many after; their lengths; their grams."""

    code: np.ndarray
    length: np.ndarray
    gram: np.ndarray


def coded(words: list[str]) -> Coded:
    length = np.fromiter(map(len, words), np.int64, len(words))
    widest = int(length.max(initial=0))
    code = np.zeros((len(words), widest + 2 * (Q - 1)), np.uint8)
    inner = code[:, Q - 1 : Q - 1 + widest]
    inner[np.arange(widest) < length[:, None]] = _CODE[np.frombuffer("".join(words).encode("latin-1"), np.uint8)]
    gram = np.zeros((len(words), widest + Q - 1), np.int32)
    for k in range(Q):
        gram = gram * LETTERS + code[:, k : k + widest + Q - 1]
    return Coded(code, length, gram)


def _by_width(length: np.ndarray) -> Iterator[np.ndarray]:
    """Rows of like length, as many as may be looked at together: one very long word widens no others."""
    kind = np.frexp(length.astype(np.float64))[1]
    kind = np.maximum(kind, 5)
    for k in np.unique(kind).tolist():
        at = np.flatnonzero(kind == k)
        n = max(1, (_CELLS >> 3) >> k)
        for a in range(0, len(at), n):
            yield at[a : a + n]


def _first(c: Coded, rank: np.ndarray, n: int) -> np.ndarray:
    """Places of each word's `n` rarest grams, by (rank, place): an order that all words share. -1 where a word has fewer."""
    width = c.gram.shape[1]
    there = np.arange(width) < (c.length + Q - 1)[:, None]
    order = np.where(there, rank[c.gram].astype(np.int64) << 32 | np.arange(width), np.iinfo(np.int64).max)
    n = min(n, width)
    at = np.argsort(order, axis=1, kind="stable")[:, :n]
    return np.where(np.take_along_axis(there, at, 1), at, -1)


def _stir(*parts: np.ndarray | int) -> np.ndarray:
    h = np.uint64(0x9E3779B97F4A7C15)
    for p in parts:
        h = (h ^ np.asarray(p).astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
        h = h ^ (h >> np.uint64(31))
    return np.asarray(h).view(np.int64)


def _tokens(c: Coded, at: np.ndarray, row: np.ndarray, side: np.ndarray, shift: int) -> np.ndarray:
    """Names of grams at places, as the shorter word of a pair has them: the longer's stand one place later, or not."""
    return _stir(c.gram[row, at], at - np.where(side == 1, shift, 0), c.length[row] - side)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in _by_width(np.array([len(w) for w in b.column("word").to_pylist()], np.int64)):
            yield b.take(pa.array(at))


def _listed(words: DataFrame, rank) -> DataFrame:
    """The postings of every word's Q + 1 rarest grams: (list, side, word, n).

    A list has one gram at one place and one length. Words of that length are on side 0; words one letter longer are on side 1
    where the gram has that place or the next.
    """
    schema = pa.schema([("list", pa.int64()), ("side", pa.int8()), ("word", pa.string()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _cut(batches):
            words = b.column(0).to_pylist()
            c = coded(words)
            at = _first(c, rank.value, Q + 1)
            row = np.repeat(np.arange(len(words)), at.shape[1])
            place = at.ravel()
            row, place = row[place >= 0], place[place >= 0]
            zero = np.zeros(len(row), np.int8)
            name = np.concatenate([_tokens(c, place, row, zero, 0), _tokens(c, place, row, zero + 1, 0), _tokens(c, place, row, zero + 1, 1)])
            side = np.concatenate([zero, zero + 1, zero + 1])
            yield from _posted(schema, b, name, side, np.tile(row, 3))

    return map_batches(words.select("word", "n"), run, "list long, side byte, word string, n long")


def _posted(schema: pa.Schema, b: pa.RecordBatch, name: np.ndarray, side: np.ndarray, row: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Each (list, side, word) once."""
    order = np.lexsort((row, side, name))
    name, side, row = name[order], side[order], row[order]
    new = np.r_[True, (name[1:] != name[:-1]) | (side[1:] != side[:-1]) | (row[1:] != row[:-1])]
    name, side, row = name[new], side[new], row[new]
    yield pa.RecordBatch.from_arrays([pa.array(name), pa.array(side), b.column("word").take(pa.array(row)), b.column("n").take(pa.array(row))], schema=schema)


def _split(lists: DataFrame, rank, level: int) -> DataFrame:
    """Long lists as shorter ones: words that stay together share another of their Q + `level` rarest grams.

    Near words share `level` of those, so one at least that no earlier name has used up. Names are chained, so a word's
    gram may be the one used before; that only makes pairs meet twice.
    """
    schema = pa.schema([("root", pa.int64()), ("list", pa.int64()), ("side", pa.int8()), ("word", pa.string()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _cut(batches):
            words = b.column("word").to_pylist()
            root, old = b.column("root").to_numpy(), b.column("list").to_numpy()
            side0 = b.column("side").to_numpy().astype(np.int64)
            c = coded(words)
            at = _first(c, rank.value, Q + level)
            row, place = np.repeat(np.arange(len(words)), at.shape[1]), at.ravel()
            row, place = row[place >= 0], place[place >= 0]
            again = row[side0[row] == 1], place[side0[row] == 1]
            names = [_stir(old[row], _tokens(c, place, row, side0[row], 0)), _stir(old[again[0]], _tokens(c, again[1], again[0], side0[again[0]], 1))]
            name, row = np.concatenate(names), np.r_[row, again[0]]
            order = np.lexsort((row, name))
            name, row = name[order], row[order]
            new = np.r_[True, (name[1:] != name[:-1]) | (row[1:] != row[:-1])]
            name, row = name[new], row[new]
            yield pa.RecordBatch.from_arrays([pa.array(root[row]), pa.array(name), pa.array(side0[row].astype(np.int8)), b.column("word").take(pa.array(row)), b.column("n").take(pa.array(row))], schema=schema)

    return map_batches(lists.select("root", "list", "side", "word", "n"), run, "root long, list long, side byte, word string, n long")


def _merged(lists: DataFrame, rank, tasks: int) -> DataFrame:
    """(word, n, near, near_n) of all pairs that meet in a list and are one edit apart, both ways round.

    Lists are dealt by name and come sorted, so a task merges them one after the other, as many at once as make a batch.
    """
    schema = pa.schema([("word", pa.string()), ("n", pa.int64()), ("near", pa.string()), ("near_n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0

        def pairs(t: pa.Table) -> Iterator[pa.RecordBatch]:
            """Lists of words of like length together, cut between lists."""
            name, side = t.column("list").to_numpy(), t.column("side").to_numpy()
            length = np.array([len(w) for w in t.column("word").to_pylist()], np.int64) - side  # of the list
            kind = np.maximum(np.frexp(length.astype(np.float64))[1], 5)
            for k in np.unique(kind).tolist():
                at = np.flatnonzero(kind == k)
                ends = np.r_[np.flatnonzero(np.diff(name[at])) + 1, len(at)]
                step, begin = max(1, (_CELLS >> 3) >> k), 0
                while begin < len(at):
                    fit = np.searchsorted(ends, begin + step, "right")
                    end = int(ends[fit - 1]) if fit and ends[fit - 1] > begin else int(ends[fit])
                    yield from alike(t.take(pa.array(at[begin:end])))
                    begin = end

        def alike(t: pa.Table) -> Iterator[pa.RecordBatch]:
            name, root, side = t.column("list").to_numpy(), t.column("root").to_numpy(), t.column("side").to_numpy()
            words, n = t.column("word").combine_chunks(), t.column("n").combine_chunks()
            c = coded(words.to_pylist())
            at = _first(c, rank.value, Q + 1)
            ends = np.r_[np.flatnonzero(name[1:] != name[:-1]) + 1, len(name)]
            end = ends[np.searchsorted(ends, np.arange(len(name)), "right")]
            partners = np.where(side == 0, end - np.arange(len(name)) - 1, 0)
            upto = np.cumsum(partners)
            total, step = int(upto[-1]), max(1, _CELLS // c.code.shape[1])
            for lo in range(0, total, step):  # the k-th row has the pairs numbered from upto - partners on
                k = np.arange(lo, min(lo + step, total))
                i = np.searchsorted(upto, k, "right")
                j = i + 1 + (k - (upto[i] - partners[i]))
                i, j = _near(c, side, i, j)
                i, j = _owned(c, at, root, side, i, j)
                if len(i):
                    both, other = pa.array(np.r_[i, j]), pa.array(np.r_[j, i])
                    yield pa.RecordBatch.from_arrays([words.take(both), n.take(both), words.take(other), n.take(other)], schema=schema)

        for b in batches:
            held.append(b)
            size += b.nbytes
            if size < 4 << 20:
                continue
            t = pa.Table.from_batches(held).combine_chunks()
            name = t.column("list").to_numpy()
            whole = int(np.searchsorted(name, name[-1], "left")) if name[-1] != name[0] else 0
            if whole:
                yield from pairs(t.slice(0, whole).combine_chunks())
            held = t.slice(whole).combine_chunks().to_batches()
            size = sum(x.nbytes for x in held)
        if held:
            yield from pairs(pa.Table.from_batches(held).combine_chunks())

    dealt = lists.repartition(tasks, "list").sortWithinPartitions("list", "side", "word")
    return map_batches(dealt, run, "word string, n long, near string, near_n long")


def _near(c: Coded, side: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of candidates (i on side 0) those one edit apart: first by the count of shared grams, then letter by letter."""
    out = []
    for longer in (0, 1):
        mine = side[j] == longer
        a, b = i[mine], j[mine]
        if not len(a):
            continue
        # letters that agree at the same place and, for a longer word, one place on; a gram agrees if Q letters do
        width = int(c.length[b].max()) + 2 * (Q - 1)
        x, y = c.code[a, :width], c.code[b, :width]
        same = x == y
        shared = same[:, : width - Q + 1].copy()
        for k in range(1, Q):
            shared &= same[:, k : width - Q + 1 + k]
        if longer:
            later = x[:, :-1] == y[:, 1:]
            moved = later[:, : width - Q].copy()
            for k in range(1, Q):
                moved &= later[:, k : width - Q + k]
            shared[:, :-1] |= moved
        shared &= np.arange(shared.shape[1]) < (c.length[a] + Q - 1)[:, None]
        enough = shared.sum(1, dtype=np.int16) >= c.length[b] - 1
        a, b = a[enough], b[enough]
        if longer:
            head = np.argmin(same[enough], axis=1)  # the first place where they differ: it is in b's end at least
            tail = np.where(np.arange(width - 1) >= head[:, None], later[enough], True)
            good = tail.all(1)
        else:
            good = (~same[enough]).sum(1) == 1
        out.append((a[good], b[good]))
    if not out:
        return i[:0], j[:0]
    return np.concatenate([x[0] for x in out]), np.concatenate([x[1] for x in out])


def _owned(c: Coded, at: np.ndarray, root: np.ndarray, side: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of pairs those whose first shared list is this one: each pair is told in one list, wherever else it meets."""
    if not len(i):
        return i, j
    mine = np.full(len(i), -1)
    for k in range(at.shape[1] - 1, -1, -1):
        p = at[i, k]
        g = np.where(p >= 0, c.gram[i, p], -1)
        hit = np.zeros(len(i), bool)
        for m in range(at.shape[1]):
            q = at[j, m]
            step = q - p
            hit |= (q >= 0) & (c.gram[j, q] == g) & ((step == 0) | (step == 1) & (side[j] == 1))
        mine = np.where(hit & (p >= 0), p, mine)
    own = _tokens(c, mine, i, np.zeros(len(i), np.int64), 0) == root[i]
    return i[own], j[own]


def gram_ranks(words: DataFrame) -> np.ndarray:
    """Each gram's count over all words; there are 91 cubed at most, whatever the corpus holds."""
    schema = pa.schema([("gram", pa.int32()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(LETTERS**Q, np.int64)
        for b in _cut(batches):
            c = coded(b.column(0).to_pylist())
            there = np.arange(c.gram.shape[1]) < (c.length + Q - 1)[:, None]
            total += np.bincount(c.gram[there], minlength=len(total))
        at = np.flatnonzero(total)
        yield batch(schema, pa.array(at.astype(np.int32)), pa.array(total[at]))

    got = map_batches(words.select("word"), run, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    count = np.zeros(LETTERS**Q, np.int64)
    count[got.column(0).to_numpy()] = got.column(1).to_numpy()
    rank = np.empty(len(count), np.int32)
    rank[np.argsort(count, kind="stable")] = np.arange(len(count), dtype=np.int32)
    return rank


def near_words(words: DataFrame, long_list: int = 10_000) -> DataFrame:
    """(word, n, near, near_n): all pairs of words one inserted, deleted or replaced letter apart, both ways round, each once.

    words: (word, n), distinct words of the letters a-z and U+00C0 to U+00FF. The inverted index is dealt over tasks by its
    lists. Of a word's grams only the Q + 1 rarest are posted: to share max(n) - 1 of n + Q - 1 grams, two words must share
    one of those. Within a list places are equal, or one apart where lengths are; candidates are counted by all their grams,
    and what has enough is compared. A list over `long_list` words (of 16 letters, or as many letters) is split by a second gram that near words must share
    among their Q + 2 rarest, and so on to the fourth: near words of five letters share no more for sure.
    """
    spark = words.sparkSession
    rank = spark.sparkContext.broadcast(gram_ranks(words))
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    lists = Table(_listed(words, rank).withColumn("root", F.col("list")), "postings")
    out = []
    for level in range(2, 6):
        size = lists.df.groupBy("list").agg(F.sum(F.greatest(F.char_length("word"), F.lit(16))).alias("size")).where(F.col("size") > 16 * long_list).select("list")
        if level == 5 or size.isEmpty():
            out.append(_merged(lists.df, rank, tasks))
            break
        long = Table(size, "long-lists")
        out.append(_merged(lists.df.join(long.df, "list", "left_anti"), rank, tasks))
        lists = Table(_split(lists.df.join(long.df, "list", "left_semi"), rank, level), "postings")
    if not out[1:]:
        return out[0]
    return out[0].unionByName(reduce(DataFrame.unionByName, out[1:]).distinct())  # words of a split list may meet in several of its parts


def variants(words: DataFrame, times: int = 2) -> DataFrame:
    """(word, n, form, form_n, root, n_near) of (word, n): the form is the near word of most occurrences, the first in
    code-point order among equals, if it has `times` those of the word or more. The root is what forms lead to at last.

    Counts at least double from form to form, so paths are short and have no rings; roots are found by doubling.
    """
    near = near_words(words)
    # the least of (-n, word) is the largest n and the first word; letters here sort by bytes as by code points
    best = near.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near"))).alias("best"))
    x = words.join(best, "word", "left")
    good = -F.col("best.less") >= times * F.col("n")
    known = Table(x.select("word", "n", F.when(good, F.col("best.near")).alias("form"), F.when(good, -F.col("best.less")).alias("form_n"), F.coalesce("n_near", F.lit(0)).alias("n_near")), "forms")
    hops = known.df.where("form is not null").select("word", F.col("form").alias("to"))
    table = Table(hops, "hops")
    while True:
        on = table.df.select(F.col("word").alias("to"), F.col("to").alias("further"))
        step = Table(table.df.join(on, "to", "left").select("word", F.coalesce("further", "to").alias("to"), F.col("further").isNotNull().alias("moved")), "hops")
        table.drop()
        table = step
        if table.df.where("moved").isEmpty():
            break
    return known.df.join(table.df.select("word", F.col("to").alias("root")), "word", "left").withColumn("root", F.coalesce("root", "word"))


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", every: int = 97, least_length: int = 5, least_n: int = 3, times: int = 2) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of all words of whole texts with `least_length` letters and `least_n` occurrences.

    Null and empty texts have no words; a null id is an empty name; repeated rows count as often as they stand; other columns
    are ignored; an empty table gives an empty result. least_length is 5 or more, as shorter words may share no gram.
    """
    if least_length < 2:
        raise ValueError("words of one letter share no gram with their near words")
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kept: Column = (F.char_length("word") >= least_length) & (F.col("n") >= least_n)
    words = Table(slips(d, every).where(kept), "words")
    return variants(words.df, times).select("word", "form", "root", "n", "n_near", "form_n")
