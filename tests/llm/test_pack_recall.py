"""What the packing index finds against exact BM25, and how far a block's best neighbours are from the corpus's."""

import math

import numpy as np

from tidemark.llm import packing
from tidemark.llm.queries import PACK_VOCABULARY

SF = "/root/testdata/sf0.1"


def plain_bm25(docs, query, idf, mean, k1=1.2, b=0.75):
    """Scores of all documents for the distinct terms of one, term by term."""
    out = []
    for ids in docs:
        times = {}
        for t in ids.tolist():
            times[t] = times.get(t, 0) + 1
        out.append(sum(idf[t] * times[t] * (k1 + 1) / (times[t] + k1 * (1 - b + b * len(ids) / mean)) for t in query if t in times))
    return out


def test_recall(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 100000").orderBy("doc_id").select("doc_id", "text").collect()
    encode = packing.encoder(*PACK_VOCABULARY)
    docs = [np.frombuffer(encode(r.text or "") + b"\1\0", "<u2") for r in rows]
    n, mean = len(docs), sum(map(len, docs)) / len(docs)
    df = np.zeros(1 << 16, np.int64)
    for d in docs:
        df[np.unique(d)] += 1
    idf = np.where(df >= 2, np.log1p((n - df + 0.5) / (df + 0.5)), 0).astype(np.float32)
    size = 2000  # about what 2 million tokens are
    found = wanted = 0
    for start in range(0, n - size + 1, size):
        part = docs[start : start + size]
        index = packing.Block(part, idf, mean, 48, 64)
        full = packing.Block(part, idf, mean, 1 << 16, 64)
        for k in range(size):
            if rows[start + k].doc_id % 100 == 0:
                got, exact = index.neighbours(k), full.neighbours(k)
                got[k] = exact[k] = 0
                best = [x for x in np.argsort(-exact, kind="stable")[:10].tolist() if exact[x] > 0]
                found += len({*np.argsort(-got, kind="stable")[:10].tolist()} & {*best})
                wanted += len(best)
                if rows[start + k].doc_id % 2500 == 0:  # and exact means exact
                    plain = np.array(plain_bm25(part, [t for t in set(part[k].tolist()) if idf[t] > 0], idf, mean))
                    plain[k] = 0
                    assert np.allclose(plain, exact, rtol=1e-4)
    assert wanted > 500 and found >= 0.9 * wanted, found / wanted
    print("recall at 10:", found / wanted, math.floor(wanted / 10), "queries")
