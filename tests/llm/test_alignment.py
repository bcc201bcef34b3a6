"""Cross-tokenizer alignment against the tokenizers themselves, text by text."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest

from tests.conftest import SF
from tests.llm.test_llm import ODD, docs, odd, pairs  # noqa: F401
from tidemark.llm import alignment
from tidemark.llm.queries import ALIGNED_VOCABULARIES, QUERIES

HARD = [
    "a  b", " lead", "trail ", "  ", " ", "a\n\nb\tc \n d", " x ﬁ ①", "<s> </s> <unk> <|endoftext|>", "x ▁y", "　 é é    z", "don't 'll  'x \r\n\r\n  12 345678 \U0001f600 \U0001f600",
    "ein   langer    Text     mit   Lücken", "藩 一二 \u0085 end", "é ​ x  y",
]


def byte_letters():
    """The printable stand-ins of byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(256 + k): b for k, b in enumerate(rest)}}


@pytest.fixture(scope="module")
def tools():
    import sentencepiece
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model")), byte_letters()


def tokens(tools, text):
    t, sp, letters = tools
    whole = (" " + (text or "")).encode()
    if not text:
        return [], []
    a = [(i, bytes(letters[c] for c in t.id_to_token(i))) for i in t.encode(" " + text, add_special_tokens=False).ids]
    piece = lambda p: bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode()
    b = [(i, piece(sp.id_to_piece(i))) for i in sp.encode(text)]
    return (a, b) if b"".join(x for _, x in a) == whole == b"".join(x for _, x in b) else ([], [])


def ends(row):
    out, at = [], 0
    for i, raw in row:
        at += len(raw)
        out.append((i, at))
    return out


def brute(tools, rows):
    found, count = [], Counter()
    for d, text in rows:
        a, b = (ends(x) for x in tokens(tools, text))
        both = sorted({e for _, e in a} & {e for _, e in b})
        links = linked(a, b, both)
        groups = []
        ia = ib = 0
        for e in both:
            ga, gb = [], []
            while ia < len(a) and a[ia][1] <= e:
                ga.append(str(a[ia][0]))
                ia += 1
            while ib < len(b) and b[ib][1] <= e:
                gb.append(str(b[ib][0]))
                ib += 1
            groups.append(",".join(ga) + "|" + ",".join(gb))
        count.update(links)
        found.append((d, len(a), len(b), len(both), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""))
    most = Counter()
    for (_, j), n in count.items():
        most[j] = max(most[j], n)
    return sorted(((d, na, nb, ng, len(ls), sum(count[x] == most[x[1]] for x in ls), sum(count[x] for x in ls), sha) for d, na, nb, ng, ls, sha in found), key=str), count


def linked(a, b, both):
    at_a, at_b = {e: i for i, e in a}, {e: i for i, e in b}
    assert len(at_a) == len(a) and len(at_b) == len(b)  # every token has bytes, so one of each ends at a place at most
    return [(at_a[e], at_b[e]) for e in both]


COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


def test_query_equals_the_tokenizers(spark, docs, tools):  # noqa: F811
    assert rows_of(QUERIES["op13_alignment"](spark, SF)) == brute(tools, pairs(docs))[0]


def test_odd_and_hard_texts_in_small_parts_and_blocks(spark, odd, tools):  # noqa: F811
    r = random.Random(1)
    hard = [(100 + k, t) for k, t in enumerate(HARD)] + [(200 + k, "".join(r.choice(["a", "é", " ", " ", "\n", "　", "Wort", "1", "'s", "▁" if k % 3 == 0 else "x", "\U0001f600"]) for _ in range(60))) for k in range(60)]
    df = odd.select("doc_id", "text").union(spark.createDataFrame(hard, "doc_id long, text string"))
    want, count = brute(tools, [*ODD, *hard])
    for part, block in ((alignment.PART, alignment.BLOCK), (300, 2000)):
        got = alignment.align(df, ALIGNED_VOCABULARIES, part=part, block=block)
        assert rows_of(got.docs) == want
        assert {(x.a, x.b): x["count"] for x in got.pairs.collect()} == dict(count)


def test_empty_table(spark, odd):  # noqa: F811
    got = alignment.align(odd.limit(0), ALIGNED_VOCABULARIES)
    assert got.docs.count() == 0 and got.pairs.count() == 0


def test_parts_lose_nothing():
    text = ("wort  und " * 50 + "x" * 300 + " ende  hier").encode()
    for limit in (1, 7, 64, 5000):
        parts = alignment.parts_of(text, limit)
        assert b" ".join(parts) == text
