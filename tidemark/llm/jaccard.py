"""Exact Jaccard join of documents' shingle sets as a metric-space join, and the components of its links."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Table, batch, components, map_batches, may_be_among, texts
from .hashing import chunks, hash_texts, rolling

_LEAF = 24
_CELLS = 256  # of a histogram, at least
_SLACK = 1e-9


def shingle_sets(docs: list[bytes | None], size: int) -> list[np.ndarray]:
    """Sorted 64-bit hashes of each text's distinct shingles; of a text with fewer words, of the whole sequence."""
    h, at = hash_texts(docs, lower=True)
    grams, out = rolling(h, size), []
    for k in range(len(docs)):
        n = int(at[k + 1] - at[k])
        if n == 0:
            out.append(np.empty(0, np.uint64))
        elif n < size:
            out.append(np.array([xxhash.xxh64_intdigest(h[at[k] : at[k + 1]].tobytes(), seed=n)], np.uint64))
        else:
            out.append(np.unique(grams[at[k] : at[k + 1] - size + 1]))
    return out


def node_of(s: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh64_intdigest(s.tobytes())).view(np.int64))


def histogram(s: np.ndarray) -> bytes:
    """How many members fall into each cell by hash, modulo 16, two cells a byte. Larger sets have more cells."""
    cells = max(_CELLS, 1 << max(0, len(s).bit_length() - 1))
    x = (np.bincount(((s >> np.uint64(16)) & np.uint64(cells - 1)).astype(np.int64), minlength=cells) & 15).astype(np.uint8)
    return (x[: cells // 2] | (x[cells // 2 :] << 4)).tobytes()


def unpacked(packed: list[bytes]) -> np.ndarray:
    """Histograms of one length as rows of int8."""
    x = np.frombuffer(b"".join(packed), np.uint8).reshape(len(packed), -1)
    return np.concatenate([x & 15, x >> 4], axis=1).astype(np.int8)


def folded(rows: np.ndarray, cells: int) -> np.ndarray:
    """The same histograms with fewer cells."""
    while rows.shape[-1] > cells:
        half = rows.shape[-1] // 2
        rows = (rows[..., :half] + rows[..., half:]) & 15
    return rows


def lower_bound(rows: np.ndarray, other: np.ndarray) -> np.ndarray:
    """L1 of counts known modulo 16: never more than the symmetric difference."""
    d = np.abs(rows - other)
    return np.minimum(d, 16 - d).sum(-1, dtype=np.int32)


def reach(n: np.ndarray, cells: np.ndarray, t: float) -> tuple[np.ndarray, np.ndarray]:
    """How near a pivot must be to be a home, and how near to be joined, for sets of n members.

    Linked sets differ in at most b = n (1 - t) / t members, n being either's size. A home is within rho * b. A set joins
    every pivot within b + rho * b / t: that reaches the home of each set it can link with, by the triangle inequality.
    rho is smaller for sizes at which unrelated sets could come as near as that. It falls with n and rises with the cells, so
    what is joined goes by the largest that a linked set can have: it has n * t members or more, and twice the cells at most.
    """

    def rho(n: np.ndarray, cells: np.ndarray) -> np.ndarray:
        apart = 0.8 * cells * np.minimum(4, (2 / np.sqrt(np.pi)) * np.sqrt(n / cells))
        return np.where(n * (1 - t) / t * (1 + 1 / t) <= apart, 1.0, 0.25)

    b = n * (1 - t) / t
    return rho(n, cells) * b + 1e-6, b + rho(n * t, 2 * cells) * b / t + 1e-6


class Region:
    """The pivots of one region, among sets that arrive by size.

    A set without a home becomes a pivot. Linked sets always have a pivot in common, since a set joins the home of every
    earlier set it can link with. Pivots that one set joins are connected; of each connected kind only one is named, so
    edges are as many as sets, not as pairs. Sizes bound distances too, so pivots that are too small aren't looked at.
    """

    def __init__(self, t: float):
        self.t, self.count = t, 0
        self.rows: dict[int, tuple[np.ndarray, list[int]]] = {}  # by the number of cells: histograms, and whose
        self.names, self.kind, self.size = (np.zeros(16, np.int64) for _ in range(3))

    def place(self, node: int, n: int, home: float, near: float, hist: np.ndarray) -> np.ndarray:
        """One pivot of each kind that is joined; the node itself isn't among them."""
        first = int(np.searchsorted(self.size[: self.count], np.floor(n * self.t)))
        joined, at_home = [], False
        for cells, (rows, whose) in self.rows.items():
            lo = int(np.searchsorted(whose, first))
            if cells <= len(hist) and lo < len(whose):
                who = np.array(whose[lo:])
                d = np.maximum(lower_bound(rows[lo : len(whose)], folded(hist, cells)), n - self.size[who])
                joined.append(who[d <= near])
                at_home |= bool((d <= home).any())
        joined = np.concatenate(joined) if joined else np.empty(0, np.int64)
        kinds, at = np.unique(self.kind[joined], return_index=True)
        out = self.names[joined[at]]
        k = self.count
        if len(kinds) > 1:
            self.kind[:k][np.isin(self.kind[:k], kinds)] = kinds[0]
        if not at_home:
            if k == len(self.names):
                self.names, self.kind, self.size = (np.concatenate([x, np.zeros_like(x)]) for x in (self.names, self.kind, self.size))
            self.names[k], self.size[k], self.kind[k] = node, n, kinds[0] if len(kinds) else k
            rows, whose = self.rows.get(len(hist), (np.zeros((4, len(hist)), np.int8), []))
            if len(whose) == len(rows):
                rows = np.concatenate([rows, np.zeros_like(rows)])
            rows[len(whose)] = hist
            whose.append(k)
            self.rows[len(hist)] = rows, whose
            self.count += 1
        return out


class Links:
    """Exact links among sets held in memory, by recursion over Voronoi regions. Members are numbered, 32 bits each."""

    def __init__(self, sets: list[np.ndarray], num: int, den: int):
        self.num, self.den, self.eps = num, den, 1 - num / den
        self.size = np.array([len(s) for s in sets], np.int64)
        self.at = np.r_[0, np.cumsum(self.size)]
        flat = np.concatenate(sets)
        sets.clear()
        values, inverse = np.unique(flat, return_inverse=True)
        self.flat, self.mark = inverse.astype(np.int32), np.zeros(len(values), bool)
        del flat, values, inverse
        self.parent = list(range(len(self.size)))
        self.union(range(len(self.size)))

    def find(self, x: int) -> int:
        p = self.parent
        while p[x] != x:
            p[x] = p[p[x]]
            x = p[x]
        return x

    def join(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)

    def members(self, x: int) -> np.ndarray:
        return self.flat[self.at[x] : self.at[x + 1]]

    def overlaps(self, pivot: int, group: np.ndarray) -> np.ndarray:
        """Intersection sizes of the pivot with each set of the group."""
        own = self.members(pivot)
        self.mark[own] = True
        starts = np.r_[0, np.cumsum(self.size[group])]
        there = np.empty(starts[-1], bool)
        for k, x in enumerate(group.tolist()):
            there[starts[k] : starts[k + 1]] = self.mark[self.members(x)]
        self.mark[own] = False
        return np.add.reduceat(there, starts[:-1], dtype=np.int64)

    def distances(self, pivot: int, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        inter = self.overlaps(pivot, group)
        union = self.size[pivot] + self.size[group] - inter
        return 1 - inter / union, self.den * inter >= self.num * union

    def union(self, members) -> None:
        work = [np.array(list(members), np.int64)]
        while work:
            g = work.pop()
            if len(g) <= _LEAF:
                self.leaf(g)
                continue
            # a ball: what links to the pivot is one component; what can only link inside the ball is done
            pivot = int(g[np.argsort(self.size[g], kind="stable")[len(g) // 2]])
            dist, linked = self.distances(pivot, g)
            for x in g[linked]:
                self.join(pivot, int(x))
            shell = ~linked & (dist <= 2 * self.eps + _SLACK)
            if shell.any():
                inner = linked & (dist >= dist[shell].min() - self.eps - _SLACK)
            else:
                inner = np.zeros(len(g), bool)
            g, dist = g[~linked | inner], dist[~linked | inner]
            if len(g) <= _LEAF:
                self.leaf(g)
                continue
            # Voronoi regions of a few pivots, boundaries replicated by the triangle inequality
            count = min(8, 2 + len(g) // 64)
            pivots = [int(g[int(np.argmax(np.where(dist <= 1 - _SLACK, dist, -1)))])]
            all_dist = [self.distances(pivots[0], g)[0]]
            while len(pivots) < count:
                near = np.min(all_dist, 0)
                pivots.append(int(g[int(near.argmax())]))
                all_dist.append(self.distances(pivots[-1], g)[0])
            d = np.stack(all_dist)
            best = d.min(0)
            regions = [g[d[j] <= best + 2 * self.eps + _SLACK] for j in range(count)]
            if max(len(r) for r in regions) > 0.8 * len(g):
                self.far(g)
            else:
                work += [r for r in regions if len(r) > 1]

    def leaf(self, g: np.ndarray) -> None:
        for i in range(len(g) - 1):
            self.against(int(g[i]), g[i + 1 :])

    def against(self, a: int, rest: np.ndarray) -> None:
        """Links of one set with others that it isn't connected with yet."""
        small, large = np.minimum(self.size[a], self.size[rest]), np.maximum(self.size[a], self.size[rest])
        rest, mine = rest[self.den * small >= self.num * large], self.find(a)
        rest = np.array([x for x in rest.tolist() if self.find(x) != mine], np.int64)
        if len(rest):
            for x in rest[self.distances(a, rest)[1]].tolist():
                self.join(a, x)

    def far(self, g: np.ndarray) -> None:
        """For sets too far from any pivot to be told apart: they meet at the rare members of their prefixes."""
        counts = np.bincount(np.concatenate([self.members(x) for x in g]), minlength=len(self.mark))
        index: dict[int, list[int]] = {}
        for x in g.tolist():
            own, n = self.members(x), int(self.size[x])
            p = n - -(-self.num * n // self.den) + 1
            mates: set[int] = set()
            for m in own[np.lexsort((own, counts[own]))[:p]].tolist():
                if counts[m] > 1:
                    lst = index.setdefault(m, [])
                    mates.update(lst)
                    lst.append(x)
            if mates:
                self.against(x, np.array(sorted(mates), np.int64))


def _set_rows(shingle: int, heavy_min: int, heavy_share: float, heavy_block: int = 3_000_000):
    schema = pa.schema([("doc_id", pa.int64()), ("node", pa.int64()), ("n", pa.int64()), ("hist", pa.binary()), ("heavy", pa.int64()), ("c", pa.int64())])

    def often(parts: list[np.ndarray]) -> pa.RecordBatch:
        flat = np.sort(np.concatenate(parts))
        starts = np.flatnonzero(np.r_[True, flat[1:] != flat[:-1]])
        counts = np.diff(np.r_[starts, len(flat)])
        many = counts >= max(heavy_min, heavy_share * len(parts))
        none = [None] * int(many.sum())
        return batch(schema, none, none, none, none, flat[starts[many]].view(np.int64), counts[many])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in batches:
            rows = list(zip(b.column(0).to_pylist(), texts(b.column(1))))
            for part in chunks(rows, 1):
                sets = shingle_sets([r[1] for r in part], shingle)
                none = [None] * len(part)
                yield batch(schema, [r[0] for r in part], [node_of(s) if len(s) else None for s in sets], [len(s) for s in sets], [histogram(s) for s in sets], none, none)
                held += [s for s in sets if len(s)]
                size += sum(map(len, sets))
                if size > heavy_block:
                    yield often(held)
                    held, size = [], 0
        if held:
            yield often(held)

    return run


def jaccard_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, num: int = 80, den: int = 100, heavy_rows: int = 200_000, region_docs: int = 20_000, region_shingles: int = 3_000_000, run_nodes: int = 20_000
) -> DataFrame:
    """doc_id, n_shingles, component_id: the least doc_id that links of Jaccard similarity num/den or more reach.

    Equal sets are one node from the start, so exact copies cost one row each. Jaccard distance and the symmetric
    difference are metrics; these are the pivots and regions:

    1. Single shingles make the first regions. A set links only with sets that share one of its first n - ceil(n * t) + 1
       shingles in any fixed order, so it goes to the regions of those. (Distances between documents are near 1, so
       documents as first pivots would, by the triangle inequality alone, send every set to every region.) The order puts
       shingles that are frequent anywhere last; the list of them is bounded by `heavy_rows`, and it decides the order
       only, never which links are found.
    2. The empty set is the pivot inside each: distances to it are sizes, and linked sets' sizes differ by at most the
       factor t. Sets in order of size fall into runs, a run ending where the next set is larger by more than that.
       Of two linked sets the first shingle in common is among the first n - ceil(2 n t / (1 + t)) + 1 of the smaller one, so
       only a set that leads, by having the region's shingle there, can be followed. Sets alone in their run are gone here,
       before anything but (shingle, size, node) has been moved.
    3. Inside a run, sets are pivots, by a lower bound of the symmetric difference: see Region. No pairs are emitted: an
       edge is a set and a pivot, and what edges connect is a region of the next step. A run of more than `run_nodes` sets
       is dealt into blocks, and every pair of blocks is a run.
    4. A region of up to `region_docs` sets and `region_shingles` members is joined exactly in memory: balls around
       pivots are united at once, what could only link inside them is done, Voronoi regions with replicated boundaries
       recurse, and small ones are compared. Larger regions are split first, by many tasks: see _split.

    Texts without words, null texts and their sets are linked with nothing. A row with a null doc_id gets its component,
    which no null counts in; it is null if there is no other id. Repeated rows are answered each. An empty table gives no
    rows. Other columns are ignored.
    """
    spark = docs.sparkSession
    t = num / den
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    table = Table(map_batches(d, _set_rows(shingle, 8, 0.0005), "doc_id long, node long, n long, hist binary, heavy long, c long"), "sets")
    sets = table.df.where("heavy is null").select("doc_id", "node", "n")
    often = table.df.where("heavy is not null").groupBy("heavy").agg(F.sum("c").alias("c")).orderBy(F.desc("c"), "heavy").limit(heavy_rows).toArrow()
    key = often.column(0).to_numpy().view(np.uint64)
    order = np.argsort(key)
    heavy = spark.sparkContext.broadcast((key[order], often.column(1).to_numpy()[order]))  # heavy_rows at most
    p_schema = pa.schema([("s", pa.int64()), ("n", pa.int32()), ("node", pa.int64()), ("leads", pa.bool_())])

    def postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = heavy.value
        for b in batches:
            done: set[int] = set()
            for part in chunks([(t,) for t in texts(b.column(0))], 0):
                out = []
                for s in shingle_sets([r[0] for r in part], shingle):
                    if not len(s) or (node := node_of(s)) in done:
                        continue
                    done.add(node)
                    n = len(s)
                    p = n - -(-num * n // den) + 1
                    if len(keys):
                        at = np.searchsorted(keys, s)
                        at[at == len(keys)] = 0
                        rank = np.where(keys[at] == s, counts[at], 0)
                        if rank.any():
                            s = s[np.lexsort((s, rank))]
                    leads = np.arange(p) <= n - -(-2 * num * n // (num + den))
                    out.append((s[:p], np.full(p, n, np.int32), np.full(p, node, np.int64), leads))
                if out:
                    yield batch(p_schema, np.concatenate([x[0] for x in out]).view(np.int64), *(np.concatenate([x[i] for x in out]) for i in (1, 2, 3)))

    r_schema = pa.schema([("run", pa.int64()), ("node", pa.int64()), ("lo", pa.int64())])

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of rows in order of (s, n, node): the runs of two nodes or more, each node once, with the run's first."""
        before, last, lo, told = None, None, 0, True  # the last row; the last leading one, its run's first, and whether that is told
        for b in batches:
            if not b.num_rows:
                continue
            s, n, node, leads = (b.column(k).to_numpy(zero_copy_only=False) for k in range(4))
            new = np.r_[True, (s[1:] != s[:-1]) | (node[1:] != node[:-1])]
            new[0] = (s[0], node[0]) != before
            before = (s[-1], node[-1])
            s, n, node, leads = s[new], n[new].astype(np.int64), node[new], leads[new]
            if last is not None:
                s, n, node, leads = np.r_[last[0], s], np.r_[last[1], n], np.r_[last[2], node], np.r_[True, leads]
            if not len(s):
                continue
            at = np.maximum.accumulate(np.where(leads, np.arange(len(s)), -1))
            leader = np.r_[-1, at[:-1]]  # of each row the last leading one before it
            follows = (leader >= 0) & (s[leader] == s) & (den * n[leader] >= num * n)
            start = np.maximum.accumulate(np.where(follows, 0, np.arange(len(s))))
            first = node[start]
            if last is not None:
                first[start == 0] = lo
            head = ~follows & np.r_[follows[1:], False]  # a run's first row that another follows
            emit = follows | head
            if last is not None:
                emit[0] = head[0] and not told
            k = int(at[-1])
            if k >= 0:
                told = bool(emit[k] or (k == 0 and last is not None and told))
                last, lo = (s[k], n[k], node[k]), first[k]
            run = (s[emit] * np.int64(-7046029254386353131)) ^ first[emit]
            yield batch(r_schema, run, node[emit], first[emit])

    posted = map_batches(d.select("text"), postings, "s long, n int, node long, leads boolean").repartition("s").sortWithinPartitions("s", "n", "node")
    live = Table(map_batches(posted, runs, "run long, node long, lo long"), "live")
    nodes = Table(table.df.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("rep"), F.max("n").alias("n"), F.max("hist").alias("hist")), "nodes")
    # first against the first node of each run, a pair once: most near copies have their home there
    pairs = live.df.where("node <> lo").select("node", "lo").distinct()
    known = nodes.df.select("node", "n", "hist")
    pairs = pairs.join(known, "node").join(nodes.df.select(F.col("node").alias("lo"), F.col("n").alias("lo_n"), F.col("hist").alias("lo_hist")), "lo").select("node", "lo", "n", "hist", "lo_hist", "lo_n")
    near_schema = pa.schema([("node", pa.int64()), ("lo", pa.int64()), ("near", pa.bool_()), ("home", pa.bool_())])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                one, two = b.column(3).to_pylist(), b.column(4).to_pylist()
                cells = 2 * np.array([[len(x), len(y)] for x, y in zip(one, two)])
                dist = np.abs(b.column(2).to_numpy() - b.column(5).to_numpy())
                for x, y in np.unique(cells, axis=0).tolist():
                    (at,) = np.nonzero((cells == [x, y]).all(1))
                    least = min(x, y)
                    found = lower_bound(folded(unpacked([one[k] for k in at]), least), folded(unpacked([two[k] for k in at]), least))
                    dist[at] = np.maximum(dist[at], found)
                home, near = reach(b.column(2).to_numpy(), cells[:, 0], t)
                yield batch(near_schema, b.column(0), b.column(1), dist <= near, dist <= home)

    first = Table(map_batches(pairs, compare, "node long, lo long, near boolean, home boolean"), "first-pivots")
    # the others among themselves, run by run
    rest = live.df.where("node <> lo").join(first.df.where("not home").select("node", "lo"), ["node", "lo"]).select("run", "node")
    several = rest.groupBy("run").agg(F.count("*").alias("c")).where("c > 1")
    rest = Table(_dealt_runs(rest.join(several, "run"), run_nodes), "others")
    e_schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, region = None, None
        for b in batches:
            if not b.num_rows:
                continue
            packed = b.column(3).to_pylist()
            n = b.column(2).to_numpy()
            home, near = reach(n, np.array([2 * len(x) for x in packed]), t)
            out_a, out_b = [], []
            for k, (run, node) in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist())):
                if run != current:
                    current, region = run, Region(t)
                pivots = region.place(node, int(n[k]), home[k], near[k], unpacked(packed[k : k + 1])[0])
                out_a.append(np.full(len(pivots), node, np.int64))
                out_b.append(pivots)
            pair = np.unique(np.stack([np.concatenate(out_a), np.concatenate(out_b)]), axis=1)
            yield batch(e_schema, pair[0], pair[1])

    dealt = rest.df.join(known, "node").select("run", "node", "n", "hist").repartition("run").sortWithinPartitions("run", "n", "node")
    met = map_batches(dealt, meet, "a long, b long").unionByName(first.df.where("near").select(F.col("node").alias("a"), F.col("lo").alias("b")))
    edges = Table(met.distinct(), "candidates")
    for x in (live, first, rest):
        x.drop()
    reps = nodes.df.select("node", "rep", "n")
    wanted = Table(reps.join(components(edges.df, "regions").withColumnRenamed("component", "region"), "node"), "wanted")
    edges.drop()
    # the texts of nodes are asked for by an id that has them, and those that no id has by their sets
    asked = d.where("doc_id is not null").where(may_be_among(F.col("doc_id"), wanted.df.where("rep is not null").select("rep")))
    by_id = asked.join(wanted.df, asked["doc_id"] == wanted.df["rep"]).select("region", "node", "n", "text")
    members = by_id
    if wanted.df.where("rep is null").take(1):
        members = by_id.unionByName(_without_ids(d, wanted.df.where("rep is null"), shingle))
    members = Table(members, "members")
    wanted.drop()
    members, links = _split(members, shingle, num, den, region_docs, region_shingles)
    l_schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def closed(region: dict[int, np.ndarray]) -> pa.RecordBatch:
            ids = sorted(region)
            sets = [region.pop(i) for i in ids]
            found = Links(sets, num, den)
            roots = [found.find(k) for k in range(len(ids))]
            return batch(l_schema, [i for i, r in zip(ids, roots) if ids[r] != i], [ids[r] for i, r in zip(ids, roots) if ids[r] != i])

        current, held = None, {}
        for b in batches:
            rows = list(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), texts(b.column(2))))
            for part in chunks(rows, 2, 1 << 20):
                for (region, node, _), s in zip(part, shingle_sets([r[2] for r in part], shingle)):
                    if region != current:
                        if len(held) > 1:
                            yield closed(held)
                        current, held = region, {}
                    if node_of(s) == node:  # a repeated id can bring another text
                        held[node] = s
        if len(held) > 1:
            yield closed(held)

    inside = map_batches(members.df.repartition("region").sortWithinPartitions("region").select("region", "node", "text"), solve, "a long, b long")
    linked = Table(inside if links is None else inside.unionByName(links.df), "links")
    members.drop()
    if links is None:  # every region was joined whole: its links are stars already
        joined = linked.df.select(F.col("a").alias("node"), F.col("b").alias("component"))
        joined = joined.unionByName(linked.df.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
    else:
        links.drop()
        joined = components(linked.df, "links")
    least = Table(joined.join(reps, "node").select("node", "component", "rep"), "components")
    of_component = least.df.groupBy("component").agg(F.min("rep").alias("least"))
    result = Table(reps.join(least.df.select("node", "component").join(of_component, "component"), "node", "left").select("node", F.coalesce("least", "rep").alias("component_id")), "classes")
    for x in (least, linked, nodes):
        x.drop()
    return sets.join(result.df, "node", "left").select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def _dealt_runs(rest: DataFrame, run_nodes: int) -> DataFrame:
    """(run, node) from (run, node, c): runs of more than `run_nodes` as pairs of blocks, so that any two of their nodes meet."""
    k = F.when(F.col("c") > run_nodes, F.ceil(2 * F.col("c") / run_nodes)).otherwise(1).cast("int")
    own = F.pmod(F.xxhash64("node", F.lit("run")), "k")
    each = rest.withColumn("k", k).withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
    pair = F.xxhash64("run", F.least("own", "other"), F.greatest("own", "other"))
    return each.select(F.when(F.col("k") > 1, pair).otherwise(F.col("run")).alias("run"), "node")


def _without_ids(docs: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """region, node, n and a text of nodes that only rows with a null doc_id have."""
    schema = pa.schema([("node", pa.int64()), ("text", pa.string())])

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in chunks([(t,) for t in texts(b.column(0))], 0):
                sets = shingle_sets([r[0] for r in part], shingle)
                rows = [(node_of(s), r[0].decode()) for s, r in zip(sets, part) if len(s)]
                yield batch(schema, *([r[i] for r in rows] for i in range(2)))

    nameless = map_batches(docs.where("doc_id is null").select("text"), named, "node long, text string")
    return nameless.groupBy("node").agg(F.min("text").alias("text")).join(wanted, "node").select("region", "node", "n", "text")


def _split(members: Table, shingle: int, num: int, den: int, region_docs: int, region_shingles: int, pivots: int = 16) -> tuple[Table, Table | None]:
    """Splits regions that are too large for one task; returns the members of regions that aren't, and links found.

    One round: about `pivots` nodes of each large region, chosen by hash, go ahead of its members in each of the cells
    that the members are dealt into, so any number of tasks work at one region. A member links with pivots within the
    radius, and goes to the Voronoi regions of all pivots that are at most twice the radius further than its nearest.
    Components of the links so far then settle most of it: in a region, members of the pivot's component matter only if a
    member of another is within the radius of them, as seen from the pivot; the rest is gone, and a region of one
    component is done. What is left are the regions of the next round. A region that a round hardly shrinks (less than a
    third is gone) is dealt into blocks instead, and every pair of blocks is a region: as many as it takes, exact, and
    each bounded.
    """
    eps, links, level = 1 - num / den, None, 0
    schema = pa.schema([("region", pa.int64()), ("node", pa.int64()), ("n", pa.int64()), ("text", pa.string()), ("cell", pa.int64()), ("pivot", pa.int64()), ("dist", pa.float64()), ("link", pa.bool_())])

    def large_of(t: DataFrame) -> DataFrame:
        sums = t.groupBy("region").agg(F.count("*").alias("docs"), F.sum("n").alias("total"))
        return sums.where((F.col("docs") > region_docs) | (F.col("total") > region_shingles))

    def blocks(t: DataFrame, sizes: DataFrame) -> DataFrame:
        k = F.ceil(F.greatest(2 * F.col("docs") / region_docs, 2 * F.col("total") / region_shingles)).cast("int")
        own = F.pmod(F.xxhash64("node", F.lit("block")), "k")
        each = t.join(sizes.withColumn("k", k), "region").withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
        return each.select(F.xxhash64("region", F.lit("pair"), F.least("own", "other"), F.greatest("own", "other")).alias("region"), "node", "n", "text")

    while True:
        sizes = large_of(members.df)
        before = sizes.agg(F.coalesce(F.sum("total"), F.lit(0))).first()[0]
        if not before:
            return members, links
        sizes = Table(sizes, "large")
        big = members.df.join(sizes.df, "region")
        salts = F.ceil(F.greatest(F.col("docs") / region_docs, F.col("total") / region_shingles)).cast("int")
        chosen = big.where(F.pmod(F.xxhash64("node", F.lit(level)), F.greatest(F.lit(1), F.floor(F.col("docs") / pivots))) == 0)
        ahead = chosen.select("region", F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"), F.lit(0).alias("kind"), "node", "n", "text")
        rest = big.select("region", F.pmod(F.xxhash64("node"), salts).cast("int").alias("salt"), F.lit(1).alias("kind"), "node", "n", "text")

        def assign(batches: Iterator[pa.RecordBatch], level=level) -> Iterator[pa.RecordBatch]:
            cell, names, sets, table, there = None, [], [], None, None
            for b in batches:
                rows = list(zip(*(b.column(k).to_pylist() for k in range(5)), texts(b.column(5))))
                for part in chunks(rows, 5, 1 << 20):
                    out = []
                    for (region, salt, kind, node, n, text), s in zip(part, shingle_sets([r[5] for r in part], shingle)):
                        if (region, salt) != cell:
                            cell, names, sets, table = (region, salt), [], [], None
                        if kind == 0 and node_of(s) != node:  # a repeated id can bring another text
                            continue
                        if kind == 0:
                            names.append(node)
                            sets.append(s)
                            continue
                        if node_of(s) != node:
                            continue
                        text = text.decode()
                        if not names:  # no node was chosen: the region stays as it is
                            out.append((region, node, n, text, region, None, None, False))
                            continue
                        if table is None:
                            table = np.unique(np.concatenate(sets))
                            there = np.zeros((len(table) + 1, len(sets)), np.float32)
                            for k, p in enumerate(sets):
                                there[np.searchsorted(table, p), k] = 1
                        at = np.searchsorted(table, s)
                        at[at == len(table)] = 0
                        inter = there[at[table[at] == s]].sum(0).astype(np.int64)
                        union = len(s) + np.array([len(p) for p in sets]) - inter
                        dist, link = 1 - inter / union, den * inter >= num * union
                        inside = dist <= dist.min() + 2 * eps + _SLACK
                        for j in np.flatnonzero(inside | link).tolist():
                            name = int(np.uint64(xxhash.xxh64_intdigest(f"{region},{level},{names[j]}")).view(np.int64))
                            out.append((region, node, n, text if inside[j] else None, name if inside[j] else None, names[j], float(dist[j]), bool(link[j])))
                    yield batch(schema, *([r[i] for r in out] for i in range(8)))

        dealt = rest.unionByName(ahead).repartition("region", "salt").sortWithinPartitions("region", "salt", "kind").select("region", "salt", "kind", "node", "n", "text")
        split = Table(map_batches(dealt, assign, "region long, node long, n long, text string, cell long, pivot long, dist double, link boolean"), "split")
        new = split.df.where("link and node <> pivot").select(F.col("node").alias("a"), F.col("pivot").alias("b"))
        found = Table(new if links is None else new.unionByName(links.df), "pivot-links")
        if links is not None:
            links.drop()
        links = found
        label = Table(components(links.df, "split"), "labels")
        cells = split.df.where("cell is not null").join(label.df, "node", "left").withColumn("label", F.coalesce("component", "node")).drop("component")
        own = cells.where("node = pivot").groupBy("cell").agg(F.first("label").alias("own"))
        cells = Table(cells.join(own, "cell", "left").withColumn("stranger", F.col("own").isNull() | (F.col("label") != F.col("own"))), "cells")
        bands = cells.df.where("stranger").groupBy("cell").agg(F.min("dist").alias("lo"), F.max("dist").alias("hi"))
        left = cells.df.join(bands, "cell").where(F.col("stranger") | F.col("dist").between(F.col("lo") - eps - _SLACK, F.col("hi") + eps + _SLACK))
        left = Table(left.select(F.col("cell").alias("region"), "node", "n", "text"), "left")
        small = members.df.join(sizes.df, "region", "left_anti")
        again = large_of(left.df)
        after = again.agg(F.coalesce(F.sum("total"), F.lit(0))).first()[0]
        if 3 * after > 2 * before:
            again = Table(again, "again")
            done = Table(small.unionByName(left.df.join(again.df, "region", "left_anti")).unionByName(blocks(left.df, again.df)), "members")
            again.drop()
        else:
            done = Table(small.unionByName(left.df), "members")
        for x in (split, label, cells, left, sizes, members):
            x.drop()
        members, level = done, level + 1
        if 3 * after > 2 * before:
            return members, links
