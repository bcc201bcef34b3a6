"""Substring deduplication: confirmed repeated passages, sharded Aho-Corasick automata, removal of later occurrences."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Table, batch, map_batches, texts
from .hashing import chunks, hash_texts, inside, owner, rolling, sliding_min


def _windows(rows: list[tuple], text_at: int, size: int, gram: int):
    """For a chunk: the words' hashes, document positions, which windows count, their anchors and the documents they are of."""
    h, at = hash_texts([r[text_at] for r in rows])
    if len(h) < size:
        none = np.empty(0, np.uint64)
        return h, at, np.empty(0, bool), none, np.empty(0, np.int64)
    anchors = sliding_min(rolling(h, gram), size - gram + 1)
    n = len(h) - size + 1
    return h, at, inside(at, size, n), anchors[:n], owner(at, n)


class Passages:
    """One shard's automaton. Words are single characters of it, so a state is a word, not a letter.

    A passage is cut into tiles of half a window, at multiples of that, so that every window of the passage holds a whole
    tile. Tiles are the automaton's patterns; where one is hit, the document's windows around it are looked up, all their words,
    among the passages' windows. A place of a document is looked up once, however many passages have the tile.
    """

    def __init__(self, passages: list[tuple[int, bytes]], size: int):
        self.size, self.tile, self.code = size, size // 2, {}
        self.first: dict[str, int] = {}  # the least document of each window
        tiles: set[str] = set()
        for first, raw in passages:
            s = "".join([self._char(w) for w in raw.split()])
            tiles.update(s[at : at + self.tile] for at in range(0, len(s) - self.tile + 1, self.tile))
            for at in range(len(s) - size + 1):
                w = s[at : at + size]
                if self.first.setdefault(w, first) > first:
                    self.first[w] = first
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
        for tile in tiles:
            self.automaton.add_word(tile)
        if tiles:
            self.automaton.make_automaton()
        self.empty = not tiles

    def _char(self, word: bytes) -> str:
        c = self.code.get(word)
        if c is None:
            n = len(self.code) + 1
            c = self.code[word] = chr(n if n < 0xD800 else n + 0x800)
        return c

    def occurrences(self, doc_id: int, raw: bytes) -> list[tuple[int, int]]:
        """Word intervals that repeat a passage first seen in a document with a smaller id."""
        if self.empty:
            return []
        get = self.code.get
        s = "".join([get(w, "\0") for w in raw.split()])
        out, first, size, next_ = [], self.first.get, self.size, 0
        for end, _ in self.automaton.iter(s):
            stop = min(end - self.tile + 1, len(s) - size) + 1
            for at in range(max(next_, end + 1 - size), stop):
                if first(s[at : at + size], doc_id) < doc_id:
                    if out and at <= out[-1][1]:
                        out[-1] = out[-1][0], at + size
                    else:
                        out.append((at, at + size))
            next_ = max(next_, stop)
        return out


def automata(passages: list[tuple[int, bytes]], size: int, most: int = 500_000) -> list[Passages]:
    """A shard's automata, of about `most` words each: a word is a character, and there are hardly more than a million.

    A passage that is longer is cut so that the parts share one word less than a window: every window is in one of them.
    """
    out, held, n = [], [], 0
    for first, raw in passages:
        words = raw.split()
        for a in range(0, max(1, len(words) - size + 1), most):
            part = words[a : a + most + size - 1]
            if held and n + len(part) > most:
                out.append(Passages(held, size))
                held, n = [], 0
            held.append((first, b" ".join(part)))
            n += len(part)
    if held:
        out.append(Passages(held, size))
    return out


def _kept(raw: bytes | None, spans: list[tuple[int, int]]) -> tuple[int, int, bytes]:
    """Words, removed words, and what is kept."""
    words = (raw or b"").split()
    if not spans:
        return len(words), 0, b" ".join(words)
    gone = np.zeros(len(words) + 1, np.int64)
    for a, b in spans:
        gone[a] += 1
        gone[b] -= 1
    gone = np.cumsum(gone)[:-1] > 0
    return len(words), int(gone.sum()), b" ".join([w for w, g in zip(words, gone) if not g])


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 50, gram: int = 20, shard_words: int = 200_000, cell_docs: int = 4000, with_text: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (and kept_text): without words of windows that start in a smaller doc_id.

    Confirming. Every window of `size` words chooses the least hash of its `gram`-word phrases, so equal windows choose
    alike; phrases chosen in one document only end there. Documents with phrases of two or more are kept aside, and their
    windows that chose such a phrase are counted by a 64-bit hash: those of two or more documents are repeated, and the
    least doc_id is where each is first. Consecutive windows of one first document make a passage.

    Locating. Passages are sharded by their first document, about `shard_words` words to a shard; a document goes to the
    shards whose passages it holds windows of. A shard with many documents is split into cells of about `cell_docs`, each
    with the shard's passages, so that a passage of a third of all documents has many tasks. A cell is read as a stream:
    its passages are compiled to an automaton, then its documents run through it one by one. Each occurrence is confirmed
    word by word. All minima are combined before they are shuffled.

    Nulls: a null text has no words; a row with a null doc_id is never first and loses nothing. Rows that repeat an id
    don't count as smaller, and each is answered. Texts of fewer words than a window stay whole. An empty table gives no
    rows. Other columns are ignored.
    """
    spark = docs.sparkSession
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    known = d.where("doc_id is not null and text is not null").withColumn("rid", F.xxhash64("doc_id", "text"))
    a_schema = pa.schema([("anchor", pa.int64()), ("rid", pa.int64()), ("doc_id", pa.int64())])

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = list(zip(b.column(0).to_pylist(), texts(b.column(1)), b.column(2).to_pylist()))
            for part in chunks(rows, 1):
                _, _, ok, anchor, own = _windows(part, 1, size, gram)
                anchor, own = anchor[ok], own[ok]
                new = np.r_[True, (anchor[1:] != anchor[:-1]) | (own[1:] != own[:-1])] if len(anchor) else ok
                anchor, own = anchor[new].view(np.int64), own[new]
                yield batch(a_schema, anchor, np.array([r[2] for r in part], np.int64)[own], np.array([r[0] for r in part], np.int64)[own])

    chosen = Table(map_batches(known, anchors, "anchor long, rid long, doc_id long"), "anchors")
    recurring = Table(chosen.df.groupBy("anchor").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi").select("anchor"), "recurring")
    of_doc = chosen.df.select("anchor", "rid").join(recurring.df, "anchor").groupBy("rid").agg(F.collect_set("anchor").alias("anchors"))
    aside = Table(known.join(of_doc, "rid"), "aside")
    chosen.drop()
    recurring.drop()

    w_schema = pa.schema([("w", pa.int64()), ("rid", pa.int64()), ("doc_id", pa.int64())])

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = list(zip(b.column(0).to_pylist(), texts(b.column(1)), b.column(2).to_pylist(), b.column(3).to_pylist()))
            for part in chunks(rows, 1):
                h, at, _, anchor, _ = _windows(part, 1, size, gram)
                w = rolling(h, size).view(np.int64)
                anchor = anchor.view(np.int64)
                for k, r in enumerate(part):
                    a, z = at[k], max(at[k], at[k + 1] - size + 1)
                    if z > a:
                        own_w = np.unique(w[a:z][np.isin(anchor[a:z], r[3])])
                        yield batch(w_schema, own_w, np.full(len(own_w), r[2]), np.full(len(own_w), r[0]))

    seen = Table(map_batches(aside.df.select("doc_id", "text", "rid", "anchors"), windows, "w long, rid long, doc_id long"), "windows")
    repeated = Table(seen.df.groupBy("w").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("hi")).where("first < hi").select("w", "first"), "repeated")

    p_schema = pa.schema([("first", pa.int64()), ("passage", pa.binary()), ("words", pa.int64())])

    def passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for first, raw, mine in zip(b.column(0).to_pylist(), texts(b.column(1)), b.column(2).to_pylist()):
                words = raw.split()
                h, _ = hash_texts([raw])
                there = np.isin(rolling(h, size).view(np.int64), mine)
                edge = np.diff(np.r_[False, there, False].astype(np.int8))
                for a, z in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()):
                    out.append((first, b" ".join(words[a : z - 1 + size]), z - 1 + size - a))
            yield batch(p_schema, *([r[i] for r in out] for i in range(3)))

    mine = repeated.df.groupBy(F.col("first").alias("doc_id")).agg(F.collect_list("w").alias("mine"))
    found = Table(map_batches(aside.df.select("doc_id", "text").join(mine, "doc_id"), passages, "first long, passage binary, words long"), "passages")
    total = found.df.agg(F.coalesce(F.sum("words"), F.lit(0))).first()[0]
    shards = max(1, -(-int(total) // shard_words))
    shard_of = lambda c: F.pmod(F.xxhash64(c), F.lit(shards))
    route = Table(seen.df.join(repeated.df, "w").where("doc_id > first").select("rid", shard_of("first").alias("shard")).distinct(), "route")
    # cells are numbered through, from one row for each shard, so that each is a task of its own and none waits for another
    cells = route.df.groupBy("shard").agg(F.ceil(F.count("*") / cell_docs).alias("cells"))
    cells = Table(cells.select("shard", "cells", (F.sum("cells").over(Window.orderBy("shard")) - F.col("cells")).alias("first_cell")), "cells")
    n_cells = cells.df.agg(F.coalesce(F.sum("cells"), F.lit(0))).first()[0]
    placed = route.df.join(cells.df, "shard").select("rid", (F.col("first_cell") + F.pmod(F.xxhash64("rid"), "cells")).alias("cell"))
    as_docs = aside.df.select("rid", "doc_id", "text").join(placed, "rid").select("cell", F.lit(1).alias("kind"), "rid", "doc_id", F.col("text").cast("binary").alias("body"))
    as_passages = found.df.withColumn("shard", shard_of("first")).join(cells.df, "shard").select(F.explode(F.sequence("first_cell", F.col("first_cell") + F.col("cells") - 1)).alias("cell"), F.lit(0).alias("kind"), F.lit(None).cast("long").alias("rid"), F.col("first").alias("doc_id"), F.col("passage").alias("body"))
    o_schema = pa.schema([("rid", pa.int64()), ("spans", pa.list_(pa.list_(pa.int64())))])

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, waiting, made = None, [], None
        for b in batches:
            out = []
            for cell, kind, rid, doc_id, body in zip(*(c.to_pylist() for c in b.columns)):
                if cell != current:
                    current, waiting, made = cell, [], None
                if kind == 0:
                    waiting.append((doc_id, body))
                    continue
                if made is None:
                    made, waiting = automata(waiting, size), []
                if spans := [list(s) for a in made for s in a.occurrences(doc_id, body)]:
                    out.append((rid, spans))
            yield batch(o_schema, *([r[i] for r in out] for i in range(2)))

    dealt = as_docs.unionByName(as_passages).repartitionById(max(1, int(n_cells)), F.col("cell").cast("int")).sortWithinPartitions("cell", "kind")
    hits = map_batches(dealt, locate, "rid long, spans array<array<long>>")
    hits = hits.groupBy("rid").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    r_schema = pa.schema([("rid", pa.int64()), ("n_removed", pa.int64()), ("sha", pa.string()), ("kept", pa.string())])

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for rid, raw, spans in zip(b.column(0).to_pylist(), texts(b.column(1)), b.column(2).to_pylist()):
                _, gone, kept = _kept(raw, spans)
                out.append((rid, gone, hashlib.sha256(kept).hexdigest(), kept.decode() if with_text else None))
            yield batch(r_schema, *([r[i] for r in out] for i in range(4)))

    removed = Table(map_batches(aside.df.select("rid", "text").dropDuplicates(["rid"]).join(hits, "rid"), remove, "rid long, n_removed long, sha string, kept string"), "removed")
    for t in (seen, repeated, found, route, cells, aside):
        t.drop()
    b_schema = pa.schema([("doc_id", pa.int64()), ("rid", pa.int64()), ("n_words", pa.int64()), ("whole", pa.string()), ("text", pa.string())])

    def base(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [_kept(t, []) for t in texts(b.column(1))]
            yield batch(b_schema, b.column(0), b.column(2), [x[0] for x in out], [hashlib.sha256(x[2]).hexdigest() for x in out], [x[2].decode() if with_text else None for x in out])

    rid = F.when(F.col("doc_id").isNotNull() & F.col("text").isNotNull(), F.xxhash64("doc_id", "text")).alias("rid")
    whole = map_batches(d.select("doc_id", "text", rid), base, "doc_id long, rid long, n_words long, whole string, text string")
    out = whole.join(removed.df, "rid", "left").select("doc_id", "n_words", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"), F.coalesce("sha", "whole").alias("kept_sha256"), F.coalesce("kept", "text").alias("kept_text"))
    return out if with_text else out.drop("kept_text")

