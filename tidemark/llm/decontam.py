"""Benchmark decontamination: an Aho-Corasick automaton over normalised test texts, matched in one scan of each document."""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Table, batch, map_batches, passed, texts

#: ASCII upper case becomes lower case, other ASCII that isn't a letter or digit a blank, bytes of longer characters stay.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words(text: bytes | None) -> list[bytes]:
    """Words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` of the text with A-Z lowered, as UTF-8."""
    return (text or b"").translate(_TABLE).split()


class Windows:
    """The automaton of some items' windows. Words are single characters of it, so a state is a word, not a letter.

    Documents run through it where enough words stand together that some window has. Equal windows are one pattern; each
    knows its number of words and its items. 300,000 windows of ten words, 2 MB of text, take about 190 MB at their peak, so
    callers bound them.
    """

    def __init__(self, items: list[tuple[object, bytes]], size: int):
        self.code: dict[bytes, str] = {}
        found: dict[str, set] = {}
        for item, text in items:
            s = "".join([self._char(w) for w in words(text)])
            for i in range(max(1, len(s) - size + 1) if s else 0):
                found.setdefault(s[i : i + size], set()).add(item)
        self.automaton = ahocorasick.Automaton() if found else None
        self.runs = re.compile("[^\0]{%d,}" % min(map(len, found), default=1))  # of words that a window may consist of
        while found:
            w, ids = found.popitem()
            self.automaton.add_word(w, (len(w), tuple(ids)))
        if self.automaton is not None:
            self.automaton.make_automaton()

    def _char(self, word: bytes) -> str:
        c = self.code.get(word)
        if c is None:
            n = len(self.code) + 1
            c = self.code[word] = chr(n if n < 0xD800 else n + 0x800)
        return c

    def scan(self, doc: list[bytes]) -> tuple[np.ndarray, np.ndarray, set]:
        """First and one-past-last word of each occurrence, and the items with one."""
        none = np.empty(0, np.int64)
        if self.automaton is None or not doc:
            return none, none, set()
        get = self.code.get
        stops, sizes, items = [], [], set()
        for run in self.runs.finditer("".join([get(w, "\0") for w in doc])):
            for end, (n, ids) in self.automaton.iter(run.group()):
                stops.append(run.start() + end + 1)
                sizes.append(n)
                items.update(ids)
        if not stops:
            return none, none, items
        stop = np.array(stops, np.int64)
        return stop - np.array(sizes), stop, items


def char_spans(text: str, first: list[int], last: list[int]) -> list[tuple[int, int]]:
    """Code-point spans, in the original text, of runs of words."""
    raw = text.encode()
    norm = np.frombuffer(raw.translate(_TABLE), np.uint8) != 32
    edge = np.diff(np.r_[False, norm, False].astype(np.int8))
    starts, stops = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    at = np.r_[0, np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)]
    return [(int(at[starts[a]]), int(at[stops[b - 1]])) for a, b in zip(first, last)]


def _blocks(benchmark: DataFrame, item_col: str, item_text_col: str, block_bytes: int) -> list[DataFrame]:
    """The benchmark's (item, text), dealt into blocks of about `block_bytes`."""
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(item_text_col).cast("string").alias("text")).where("text is not null")
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n = max(1, -(-int(total) // block_bytes))
    return [items] if n == 1 else [items.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k) for k in range(n)]


def _rows(block: DataFrame) -> list[tuple[object, bytes]]:
    return [(r.item, r.text.encode()) for r in block.collect()]


def keep_clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", size: int = 10, block_bytes: int = 2 << 20) -> DataFrame:
    """The rows of `docs` that `decontaminate` finds clean, with all their columns.

    The text goes through one automaton, and nothing is written or shuffled. A benchmark of several blocks filters one
    after the other, each of what the last one has left, written between. Null and empty texts stay; repeated rows stay or
    go together; ids aren't looked at. An empty benchmark keeps all rows, an empty table gives none.
    """
    spark, at, previous = docs.sparkSession, docs.columns.index(text_col), None
    blocks = _blocks(benchmark, item_col, item_text_col, block_bytes)
    for k, block in enumerate(blocks):
        sent = spark.sparkContext.broadcast(_rows(block))
        made: list[Windows] = []  # by the task that uses it

        def clean(b: pa.RecordBatch, sent=sent, made=made) -> pa.RecordBatch:
            if not made:
                made.append(Windows(sent.value, size))
            return b.filter(pa.array([not len(made[0].scan(words(t))[0]) for t in texts(b.column(at))], pa.bool_()))

        docs = passed(docs, clean)
        if k < len(blocks) - 1:
            table = Table(docs, "decontaminated")
            docs = table.df
            if previous is not None:
                previous.drop()
            previous = table
    return docs


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    size: int = 10,
    block_bytes: int = 2 << 20,
) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, items, hit_spans (code points in the original text).

    The benchmark's bytes are summed first; they bound its windows, as each begins with a word and a blank. Up to
    `block_bytes` one automaton goes to every task and one scan answers. The block is what a Python worker holds in memory:
    a larger benchmark, which no worker could hold, is dealt into blocks of about that many bytes by a hash of its id and
    text; documents are written once with a number for each row and scanned once for each block, and a row's hits are merged
    by its number. The text is never shuffled.

    Nulls: a null text has no words; a benchmark row with a null text or no words has no window; one with a null item_id
    still marks words but is in no list of items. Rows of documents are answered each, whatever the benchmark's size, so
    null and repeated ids come back once for each row. Empty tables give no rows, or rows without hits. Other columns are
    ignored.
    """
    spark = docs.sparkSession
    blocks = _blocks(benchmark, item_col, item_text_col, block_bytes)
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    if len(blocks) == 1:
        d = d.withColumn("row", F.lit(0).cast("long"))
    else:
        d = Table(d.withColumn("row", F.monotonically_increasing_id()), "numbered").df  # written, as numbers may change when made anew
    hit_schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()), ("first", pa.list_(pa.int64())), ("last", pa.list_(pa.int64())), ("items", pa.list_(pa.string())), ("hit_spans", pa.list_(pa.list_(pa.int64())))])

    hit_columns = "row long, doc_id long, n_words long, first array<long>, last array<long>, items array<string>, hit_spans array<array<long>>"

    def matcher(rows: list[tuple[object, bytes]]):
        sent = spark.sparkContext.broadcast(rows)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            a = Windows(sent.value, size)
            for b in batches:
                out = []
                for row, doc_id, raw in zip(b.column(2).to_pylist(), b.column(0).to_pylist(), texts(b.column(1))):
                    doc = words(raw)
                    first, last, found = a.scan(doc)
                    f, z = merge(first, last)
                    out.append((row, doc_id, len(doc), f, z, sorted(x for x in found if x is not None), [list(s) for s in char_spans(raw.decode(), f, z)] if f else []))
                yield batch(hit_schema, *([r[i] for r in out] for i in range(7)))

        return map_batches(d, run, hit_columns)

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The blocks' hits of each row as one block would give them."""
        for b in batches:
            out = []
            for row, doc_id, n_words, first, last, found, spans in zip(*(c.to_pylist() for c in b.columns)):
                f, z = merge(np.array(first, np.int64), np.array(last, np.int64))
                starts, stops = dict(zip(first, (s[0] for s in spans))), dict(zip(last, (s[1] for s in spans)))
                out.append((row, doc_id, n_words, f, z, sorted(set(found)), [[starts[a], stops[b]] for a, b in zip(f, z)]))
            yield batch(hit_schema, *([r[i] for r in out] for i in range(7)))

    hits = None
    for block in blocks:
        part = matcher(_rows(block))
        hits = part if hits is None else hits.unionByName(part)
    if len(blocks) > 1:
        parts = hits.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"), *(F.flatten(F.collect_list(c)).alias(c) for c in ("first", "last", "items", "hit_spans")))
        hits = map_batches(parts, merged, hit_columns)
    covered = F.aggregate(F.arrays_zip("first", "last"), F.lit(0).cast("long"), lambda acc, x: acc + x["last"] - x["first"])
    out = hits.select("doc_id", "n_words", covered.cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "items", "hit_spans")
    return out.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", (F.col("n_hit") > 0).alias("contaminated"), "items", "hit_spans")


def merge(first: np.ndarray, last: np.ndarray) -> tuple[list[int], list[int]]:
    """The union of word intervals, as disjoint ones in order."""
    out: list[list[int]] = []
    for a, b in sorted(zip(first.tolist(), last.tolist())):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [x[0] for x in out], [x[1] for x in out]
