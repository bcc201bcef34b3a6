"""PNG columns: every colour type, depth, filter and interlace against a plain reader; damage; the query's digests."""

from __future__ import annotations

import base64
import hashlib
import random
import struct
import zlib

import numpy as np
import pytest

from tests.conftest import SF
from tests.llm.test_llm import ODD, docs, odd, pairs  # noqa: F401
from tidemark.llm import media
from tidemark.llm.queries import QUERIES


def plain_png(pixels, width, depth, colour, kinds, interlaced=False, palette=b"", cut=97):
    """Rows of sample tuples as a PNG, filtered byte by byte with the given filters in turn."""
    n = media.CHANNELS[colour]
    step, out = max(1, depth * n // 8), b""
    grids = [(0, 0, 1, 1)] if not interlaced else media.PASSES
    count = 0
    for x0, y0, dx, dy in grids:
        above = None
        for row in pixels[y0::dy]:
            row = row[x0::dx]
            if not row:
                continue
            bits = "".join(format(s, f"0{depth}b") for p in row for s in p)
            line = int(bits.ljust(-(-len(bits) // 8) * 8, "0"), 2).to_bytes(-(-len(bits) // 8), "big")
            above = above or bytes(len(line))
            kind, coded = kinds[count % len(kinds)], bytearray()
            count += 1
            for i, v in enumerate(line):
                a = line[i - step] if i >= step else 0
                b, c = above[i], above[i - step] if i >= step else 0
                guess = [0, a, b, (a + b) // 2, min((abs(a + b - c - x), k, x) for k, x in enumerate((a, b, c)))[2]][kind]
                coded.append((v - guess) % 256)
            out += bytes([kind]) + bytes(coded)
            above = line
    data = zlib.compress(out)
    body = b"".join(media.chunk(b"IDAT", data[k : k + cut]) for k in range(0, len(data), cut))
    head = media.chunk(b"IHDR", struct.pack(">IIBBBBB", width, len(pixels), depth, colour, 0, 0, int(interlaced)))
    extra = media.chunk(b"PLTE", palette) if palette else b""
    return media.SIGNATURE + head + media.chunk(b"tEXt", b"k\0v") + extra + body + media.chunk(b"IEND", b"")


def image(r, width, height, depth, colour):
    return [[tuple(r.randrange(1 << depth) for _ in range(media.CHANNELS[colour])) for _ in range(width)] for _ in range(height)]


def test_every_kind_of_png():
    r = random.Random(5)
    files, want = [], []
    for colour, depths in media.DEPTHS.items():
        for depth in depths:
            for interlaced in (False, True):
                for width, height in ((1, 1), (7, 9), (3, 20), (16, 5)):
                    pixels = image(r, width, height, depth, colour)
                    kinds = [r.randrange(5) for _ in range(11)]
                    files.append(plain_png(pixels, width, depth, colour, kinds, interlaced, palette=bytes(3 << depth) if colour == 3 else b""))
                    want.append(np.array(pixels))
    got = media.decode_many([media.parse(f) for f in files])
    for g, w in zip(got, want):
        assert g.shape == w.shape and (g == w).all()


@pytest.mark.parametrize("kind", range(5))
def test_long_chains_go_band_by_band(kind):
    r = random.Random(kind)
    pixels = image(r, 5, 700, 8, 2)
    got = media.decode_many([media.parse(plain_png(pixels, 5, 8, 2, [kind]))])[0]
    assert (got == np.array(pixels)).all()


def test_writer_filters_pictures_and_leaves_texts():
    smooth = b"".join(bytes((x + y) % 256 for x in range(64)) for y in range(40))
    text = (b"some words of an ordinary text, and more of them. " * 20)[:640]
    files = media.encode_gray([smooth, text, bytes(64)], 64, idat=50)
    kinds = [media.parse(f).packed[::65] for f in files]
    assert set(kinds[0][1:]) & {1, 2, 3, 4} and set(kinds[1]) == {0}
    assert [x.tobytes() for x in media.decode_many([media.parse(f) for f in files])] == [smooth, text, bytes(64)]


def test_damage_is_told_and_hurts_no_other(spark):
    good = media.encode_gray([b"abcd" * 32], 64)[0]
    zipped = zlib.compress(b"\7" + b"x" * 64)
    head = media.chunk(b"IHDR", struct.pack(">IIBBBBB", 64, 1, 8, 0, 0, 0, 0))
    no_filter = media.SIGNATURE + head + media.chunk(b"IDAT", zipped) + media.chunk(b"IEND", b"")
    bomb = media.SIGNATURE + head + media.chunk(b"IDAT", zlib.compress(bytes(1 << 20))) + media.chunk(b"IEND", b"")
    bad = [good[:-1], good + b"x", good[:20] + b"\1" + good[21:], b"", b"GIF89a", no_filter, bomb, media.SIGNATURE + media.chunk(b"IEND", b""), None, good[:8] + head + good[8:]]
    flipped = bytearray(good)
    flipped[45] ^= 1
    bad.append(bytes(flipped))
    rows = [(k, 7, x) for k, x in enumerate([good, *bad, good])]
    got = media.read_png(spark.createDataFrame(rows, "k long, width long, media binary").coalesce(1), samples=True).orderBy("k").collect()
    assert [r.error is None for r in got] == [True, *[False] * len(bad), True]
    assert got[0].samples == got[-1].samples == b"abcd" * 32 and got[0].width == 64
    assert all(r.hash is None and r.samples is None for r in got[1:-1])


def brute_hash(samples: bytes) -> str:
    """Cells and cosines by plain loops over whole numbers."""
    h = len(samples) // 64
    cells = [[0] * 32 for _ in range(32)]
    for y in range(h):
        for cy in range(32 * y // h, min(31, (32 * y + 31) // h) + 1):
            part = min((cy + 1) * h, 32 * (y + 1)) - max(cy * h, 32 * y)
            if part > 0:
                for x in range(64):
                    cells[cy][x // 2] += part * 32 * samples[64 * y + x]
    cells = [[v * 64 // (h * 64) for v in row] for row in cells]
    cos = [[round(float(np.cos(np.pi * (2 * i + 1) * f / 64)) * (1 << 14)) for i in range(32)] for f in range(8)]
    half = [[sum(cos[f][i] * cells[i][x] for i in range(32)) for x in range(32)] for f in range(8)]
    low = [sum(half[f][x] * cos[g][x] for x in range(32)) for f in range(8) for g in range(8)]
    mid = sorted(low[1:])[31]
    return "".join(f"{int(''.join(str(int(v > mid and (k + i) > 0)) for i, v in enumerate(low[k : k + 8])), 2):02x}" for k in range(0, 64, 8))


def check(df, rows, hashes=40):
    got = sorted(map(tuple, df.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32").collect()), key=str)
    want = []
    for d, t in rows:
        raw = (t or "").encode()
        p = raw + bytes((-len(raw)) % 64 or (0 if raw else 64))
        want.append((d, len(raw), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:])))
    assert got == sorted(want, key=str)


def test_digests_of_test_tables(spark, docs):  # noqa: F811
    df = QUERIES["op11_media"](spark, SF)
    rows = pairs(docs)
    check(df, rows)
    by = {r.doc_id: r for r in df.collect()}
    for d, t in rows[:25]:
        r = by[d]
        assert r.feature == brute_hash(media.padded((t or "").encode(), 64))
    same = {}
    for d, t in rows:
        r = by[d]
        assert same.setdefault(t, (r.media_bytes, r.media_sha256, r.feature)) == (r.media_bytes, r.media_sha256, r.feature)


def test_odd_rows_and_empty(spark, odd):  # noqa: F811
    m = media.text_media(odd)
    got = m.selectExpr("doc_id", "n_bytes", "samples_bytes as payload_bytes", "samples_sha256 as payload_sha256", "tail_crc32")
    check(got, ODD)
    assert m.where("error is not null").count() == 0
    assert media.text_media(odd.limit(0)).count() == 0


def test_media_digest_is_of_what_is_stored(spark, odd):  # noqa: F811
    stored = media.to_png(odd.select("doc_id", "text"), odd["text"])
    rows = media.read_png(stored).collect()
    assert all(r.media_sha256 == hashlib.sha256(r.media).hexdigest() and r.media_bytes == len(r.media) and len(r.hash) == 8 for r in rows)
    assert base64.b16encode(rows[0].hash)
