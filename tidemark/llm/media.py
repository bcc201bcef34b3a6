"""Media columns: images as PNG in binary columns, read back chunk by chunk, and hashes of their low frequencies."""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Table, batch, map_batches
from .hashing import chunks

#: Fixed values of the format: signature, samples a pixel by colour type, and the passes of interlaced images
#: (first column, first row, step of columns, step of rows).
SIGNATURE = b"\x89PNG\r\n\x1a\n"
CHANNELS = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}
DEPTHS = {0: (1, 2, 4, 8, 16), 2: (8, 16), 3: (1, 2, 4, 8), 4: (8, 16), 6: (8, 16)}
PASSES = ((0, 0, 8, 8), (4, 0, 8, 8), (0, 4, 4, 8), (2, 0, 4, 4), (0, 2, 2, 4), (1, 0, 2, 2), (0, 1, 1, 2))
NONE, SUB, UP, AVERAGE, PAETH = range(5)

#: Pixels a side that an image is shrunk to, and frequencies a side that its hash keeps.
GRID, LOW = 32, 8


class Damaged(ValueError):
    """Bytes that aren't a whole PNG."""


class Image(NamedTuple):
    width: int
    height: int
    depth: int
    colour: int
    interlaced: bool
    palette: bytes
    packed: bytes  # the inflated samples, filtered


def chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(data, zlib.crc32(kind)))


def parse(raw: bytes) -> Image:
    """Header, palette and inflated samples of a PNG. Every chunk's checksum is tested, as are order, lengths and sizes.

    Inflating stops one byte beyond what the header promises, so a small file can't grow without bound.
    """
    if raw[:8] != SIGNATURE:
        raise Damaged("no PNG signature")
    at, head, palette, data, over, ended = 8, None, b"", [], False, False
    while at < len(raw):
        if at + 12 > len(raw):
            raise Damaged("a chunk is cut short")
        (size,) = struct.unpack_from(">I", raw, at)
        kind, end = raw[at + 4 : at + 8], at + 8 + size
        if end + 4 > len(raw):
            raise Damaged("a chunk is cut short")
        if zlib.crc32(memoryview(raw)[at + 4 : end]) != struct.unpack_from(">I", raw, end)[0]:
            raise Damaged(f"checksum of {kind!r}")
        if (head is None) != (kind == b"IHDR"):
            raise Damaged("the header isn't the first chunk, or comes twice")
        if kind == b"IHDR":
            if size != 13:
                raise Damaged("header size")
            head = struct.unpack_from(">IIBBBBB", raw, at + 8)
        elif kind == b"PLTE":
            palette = raw[at + 8 : end]
        elif kind == b"IDAT":
            if over:
                raise Damaged("data chunks aren't consecutive")
            data.append(raw[at + 8 : end])
        elif kind == b"IEND":
            ended = True
            at = end + 4
            break
        elif not kind[0] & 32:
            raise Damaged(f"unknown critical chunk {kind!r}")
        over = bool(data) and kind != b"IDAT"
        at = end + 4
    if head is None or not ended or at != len(raw):
        raise Damaged("no header, no end, or bytes after the end")
    width, height, depth, colour, compression, filtering, interlace = head
    if not width or not height or depth not in DEPTHS.get(colour, ()) or compression or filtering or interlace > 1:
        raise Damaged("header values")
    if colour == 3 and not (palette and len(palette) % 3 == 0 and len(palette) <= 3 << depth):
        raise Damaged("palette")
    want = sum(h * (1 + line(w, depth, colour)) for w, h in sizes(width, height, bool(interlace)))
    z = zlib.decompressobj()
    try:
        packed = z.decompress(b"".join(data), want + 1)
    except zlib.error as e:
        raise Damaged(str(e)) from e
    if len(packed) != want or not z.eof:
        raise Damaged("samples are too few or too many")
    return Image(width, height, depth, colour, bool(interlace), palette, packed)


def line(width: int, depth: int, colour: int) -> int:
    """Bytes of a row, without the filter's."""
    return (width * depth * CHANNELS[colour] + 7) // 8


def sizes(width: int, height: int, interlaced: bool) -> list[tuple[int, int]]:
    """Width and height of each pass that has pixels."""
    if not interlaced:
        return [(width, height)]
    found = [((width - x + dx - 1) // dx, (height - y + dy - 1) // dy) for x, y, dx, dy in PASSES]
    return [(w, h) if w > 0 and h > 0 else (0, 0) for w, h in found]


def unfilter(rows: np.ndarray, kinds: np.ndarray, first: np.ndarray, step: int, band: int = 256) -> np.ndarray:
    """The samples behind filtered rows of many images of one width, all at once.

    rows: (n, bytes); kinds: each row's filter; first: which rows begin an image; step: bytes of a pixel. Rows that don't
    look up begin a chain. Chains are undone side by side, each along its own diagonal: at one step the k-th row of a chain is
    k pixels behind the first, so all that a pixel needs (left, above, above left) is what the last two steps left in the
    row's own place and the one before it. Chains longer than `band` rows go on band by band.
    """
    if kinds.size and kinds.max() > PAETH:
        raise Damaged("filter type")
    n, width = rows.shape
    if not n or not width:
        return rows.copy()
    pixels = -(-width // step)
    if pixels * step != width:  # never so for whole bytes a pixel; pixels below a byte have a step of one
        raise ValueError("rows aren't whole pixels")
    out = np.where((kinds == NONE)[:, None], rows, 0).astype(np.uint8)
    sub = np.flatnonzero((kinds == SUB) | first & (kinds == PAETH))  # above an image all is zero: there the predictor is the left pixel
    if len(sub):
        out[sub] = np.cumsum(rows[sub].reshape(-1, pixels, step), axis=1, dtype=np.uint8).reshape(-1, width)
    above_none = first & (kinds == UP)
    out[above_none] = rows[above_none]
    done = (kinds <= SUB) | first & (kinds != AVERAGE)
    head = done | first
    at = np.arange(n)
    depth = at - np.maximum.accumulate(np.where(head, at, 0))  # rows since the chain's first
    todo = ~done
    for low in range(0, int(depth.max(initial=0)) + 1, band):
        mine = np.flatnonzero(todo & (depth >= low) & (depth < low + band))
        if len(mine):
            _diagonals(rows, out, kinds, first, mine, depth[mine] - low, pixels, step)
    return out


def _diagonals(rows, out, kinds, first, mine, lag, pixels: int, step: int) -> None:
    """Undoes rows `mine`, each `lag` pixels behind; what stands above them in `out` is done or is undone here, a step before."""
    order = np.argsort(lag, kind="stable")
    mine, lag = mine[order], lag[order]
    kind, top = kinds[mine][:, None], first[mine]
    src, dst = rows.reshape(-1, pixels, step), out.reshape(-1, pixels, step)
    up = np.where(top, 0, mine - 1)
    zero = top[:, None]
    avg, paeth = kind == AVERAGE, kind == PAETH
    for t in range(int(lag[-1]) + pixels):
        a, z = np.searchsorted(lag, [t - pixels + 1, t + 1])  # rows whose column lies inside: neighbours, as they are sorted
        x = t - lag[a:z]
        r, u, none = mine[a:z], up[a:z], zero[a:z]
        edge = (x == 0)[:, None]
        left = np.where(edge, 0, dst[r, x - 1]).astype(np.int16)
        above = np.where(none, 0, dst[u, x]).astype(np.int16)
        corner = np.where(none | edge, 0, dst[u, x - 1]).astype(np.int16)
        da, db = np.abs(above - corner), np.abs(left - corner)
        dc = np.abs(left + above - 2 * corner)
        guess = np.where((da <= db) & (da <= dc), left, np.where(db <= dc, above, corner))
        guess = np.where(avg[a:z], (left + above) >> 1, np.where(paeth[a:z], guess, above))
        dst[r, x] = src[r, x] + guess.astype(np.uint8)


def _samples(raw: np.ndarray, width: int, depth: int, colour: int) -> np.ndarray:
    """(height, width, samples) of unfiltered rows: 8 or 16 bits each, smaller ones as they are."""
    n = CHANNELS[colour]
    if depth == 16:
        return raw.view(">u2").reshape(len(raw), width, n).astype(np.uint16)
    if depth < 8:
        bits = np.unpackbits(raw, axis=1).reshape(len(raw), -1, depth)
        raw = bits.dot((1 << np.arange(depth - 1, -1, -1)).astype(np.uint8))[:, :width]
    return raw.reshape(len(raw), width, n)


def decode_many(images: list[Image | None]) -> list[np.ndarray | None]:
    """Samples (height, width, channels) of many images; rows of all images of one width are unfiltered together."""
    parts: dict[tuple[int, int], list] = {}
    for k, im in enumerate(images):
        if im is None:
            continue
        at, step = 0, max(1, im.depth * CHANNELS[im.colour] // 8)
        for p, (w, h) in enumerate(sizes(im.width, im.height, im.interlaced)):
            n = line(w, im.depth, im.colour)
            if w:
                parts.setdefault((n, step), []).append((k, p, w, np.frombuffer(im.packed, np.uint8, h * (n + 1), at).reshape(h, n + 1)))
                at += h * (n + 1)
    out: list[np.ndarray | None] = [None] * len(images)
    for (n, step), those in parts.items():
        rows = np.concatenate([x[3] for x in those])
        first = np.zeros(len(rows), bool)
        first[np.cumsum([0, *(len(x[3]) for x in those[:-1])])] = True
        plain, at = unfilter(rows[:, 1:], rows[:, 0], first, step), 0
        for k, p, w, x in those:
            im = images[k]
            got = _samples(plain[at : at + len(x)], w, im.depth, im.colour)
            at += len(x)
            if not im.interlaced:
                out[k] = got
                continue
            if out[k] is None:
                out[k] = np.zeros((im.height, im.width, got.shape[2]), got.dtype)
            x0, y0, dx, dy = PASSES[p]
            out[k][y0::dy, x0::dx] = got
    return out


def filtered(rows: np.ndarray, first: np.ndarray, step: int, kinds: tuple[int, ...] = (NONE, SUB, UP, AVERAGE, PAETH), gain: int = 8) -> np.ndarray:
    """Filtered rows with their filter byte in front: of `kinds` that whose signed differences have the least sum of sizes.

    A row is left as it is unless a filter brings its sum to less than 1 / `gain`. Smooth rows and rows like the one above
    do so by far; samples that are text are halved only, and deflate to 1.8 times the size if they are filtered for that.
    """
    n, width = rows.shape
    above = np.zeros_like(rows)
    above[1:] = np.where(first[1:, None], 0, rows[:-1])
    left, corner = np.zeros_like(rows), np.zeros_like(rows)
    left[:, step:], corner[:, step:] = rows[:, :-step], above[:, :-step]
    out, least = np.zeros((n, width + 1), np.uint8), np.full(n, np.iinfo(np.int64).max)
    for kind in kinds:
        if kind == AVERAGE:
            guess = ((left.astype(np.uint16) + above) >> 1).astype(np.uint8)
        elif kind == PAETH:
            a, b, c = (x.astype(np.int16) for x in (left, above, corner))
            pa_, pb, pc = np.abs(b - c), np.abs(a - c), np.abs(a + b - 2 * c)
            guess = np.where((pa_ <= pb) & (pa_ <= pc), left, np.where(pb <= pc, above, corner))
        else:
            guess = {NONE: np.uint8(0), SUB: left, UP: above}[kind]
        found = rows - guess
        cost = np.abs(found.view(np.int8).astype(np.int16)).sum(1, dtype=np.int64) * (1 if kind == NONE else gain)
        better = cost < least
        least[better] = cost[better]
        out[better, 0] = kind
        out[better, 1:] = found[better]
    return out


def encode_gray(payloads: list[bytes], width: int, kinds: tuple[int, ...] = (NONE, SUB, UP, AVERAGE, PAETH), level: int = 6, idat: int = 1 << 20) -> list[bytes]:
    """8-bit grey PNGs, `width` pixels wide, whose samples are the payloads: whole rows, one at least."""
    heights = [len(p) // width for p in payloads]
    if any(not h or h * width != len(p) for h, p in zip(heights, payloads)):
        raise ValueError("a payload isn't whole rows")
    if not payloads:
        return []
    rows = np.frombuffer(b"".join(payloads), np.uint8).reshape(-1, width)
    starts = np.cumsum([0, *heights])
    first = np.zeros(len(rows), bool)
    first[starts[:-1]] = True
    lines = filtered(rows, first, 1, kinds)
    out = []
    for h, a, z in zip(heights, starts, starts[1:]):
        data = zlib.compress(lines[a:z].tobytes(), level)
        body = b"".join(chunk(b"IDAT", data[k : k + idat]) for k in range(0, len(data), idat))
        out.append(SIGNATURE + chunk(b"IHDR", struct.pack(">IIBBBBB", width, h, 8, 0, 0, 0, 0)) + body + chunk(b"IEND", b""))
    return out


def _shares(size: int, cells: int) -> tuple[np.ndarray, np.ndarray]:
    return np.divmod(np.arange(cells + 1, dtype=np.int64) * size, cells)


def shrink(image: np.ndarray, cells: int = GRID) -> np.ndarray:
    """Sums over cells by cells equal areas of an image, in units of 1 / (cells * cells) pixel: whole numbers, so exact."""
    x = image
    for axis in (0, 1):
        size = x.shape[axis]
        whole, rest = _shares(size, cells)
        x = np.moveaxis(x, axis, 0)
        if axis == 0 and size >= cells:  # rows can be very many: summed between bounds, never all kept as wide integers
            upto = np.zeros((cells + 1, *x.shape[1:]), np.int64)
            np.cumsum(np.add.reduceat(x, whole[:-1], axis=0, dtype=np.int64), axis=0, out=upto[1:])
        else:
            run = np.zeros((size + 1, *x.shape[1:]), np.int64)
            np.cumsum(x, axis=0, dtype=np.int64, out=run[1:])
            upto = run[whole]
        edge = x[np.minimum(whole, size - 1)].astype(np.int64) * rest.reshape(-1, *[1] * (x.ndim - 1))
        x = np.moveaxis(np.diff(upto * cells + edge, axis=0), 0, axis)
    return x


#: Cosines of the transform as whole numbers, so that equal images have equal hashes whatever batch they are in.
_COSINES = np.round(np.cos(np.pi * (2 * np.arange(GRID)[None, :] + 1) * np.arange(LOW)[:, None] / (2 * GRID)) * (1 << 14)).astype(np.int64)


def hash_image(image: np.ndarray) -> bytes:
    """64 bits of an image: which of its 8 by 8 lowest cosine frequencies exceed their median (the mean grey isn't compared)."""
    grey = image if image.ndim == 2 else image[..., : 3 if image.shape[2] >= 3 else 1]
    if grey.ndim == 3:  # integer weights of red, green and blue
        grey = grey[..., 0] if grey.shape[2] == 1 else (299 * grey[..., 0].astype(np.int64) + 587 * grey[..., 1] + 114 * grey[..., 2]) // 1000
    cells = shrink(grey)
    cells = cells * 64 // max(1, grey.shape[0] * grey.shape[1])  # grey in 1/64 steps: a cell has height * width units
    low = _COSINES @ cells @ _COSINES.T
    flat = low.ravel()
    bits = flat > np.sort(flat[1:])[31]
    bits[0] = False
    return np.packbits(bits).tobytes()


def padded(text: bytes, width: int) -> bytes:
    return text + b"\0" * (max(width, -(-len(text) // width) * width) - len(text))


def to_png(df: DataFrame, payload: Column, width: int = 64, kinds: tuple[int, ...] = (NONE, SUB, UP, AVERAGE, PAETH), level: int = 6) -> DataFrame:
    """(doc_id, n_bytes, media): payloads as rows of grey samples, filled with zeros to whole rows, one row at least.

    df must have doc_id; a null payload is an empty one. Rows that repeat are stored as often; an empty table gives none.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("media", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = list(zip(b.column(0).to_pylist(), (x or b"" for x in b.column(1).to_pylist())))
            for some in chunks(rows, 1, 4 << 20):
                yield batch(schema, [r[0] for r in some], [len(r[1]) for r in some], encode_gray([padded(r[1], width) for r in some], width, kinds, level))

    return map_batches(df.select(F.col("doc_id").cast("long"), payload.cast("binary").alias("payload")), run, "doc_id long, n_bytes long, media binary")


def read_png(df: DataFrame, samples: bool = False) -> DataFrame:
    """df with a binary column `media` and these: width, height, depth, colour, samples_bytes, samples_sha256, tail_crc32 (of
    the last 64 bytes of samples), media_bytes, media_sha256, hash (binary), error, and the samples themselves if asked.

    Samples are 8-bit or big-endian 16-bit; a palette's are its colours. Bytes that aren't a whole PNG are a row with
    `error` and null figures, and hurt no other; a null is an error too. All columns of df come back but those named here.
    """
    added = ["width int", "height int", "depth int", "colour int", "samples_bytes long", "samples_sha256 string", "tail_crc32 long", "media_bytes long", "media_sha256 string", "hash binary", "error string", *["samples binary"] * samples]
    own = [x.split()[0] for x in added]
    kept = df.select("media", *(c for c in df.columns if c != "media" and c not in own))
    types = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(k, x) for k, x in enumerate(b.column(0).to_pylist())]
            for some in chunks(rows, 1, 2 << 20):
                found = _features([x for _, x in some], samples)
                part = b.slice(some[0][0], len(some))
                names, arrays = list(part.schema.names), list(part.columns)
                for i, x in enumerate(added):
                    names.append(own[i])
                    arrays.append(pa.array([f[i] for f in found], types[x.split()[1]]))
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema), *added])
    return map_batches(kept, run, schema)


def _features(media: list[bytes | None], samples: bool) -> list[tuple]:
    images: list[Image | None] = []
    errors: list[str | None] = []
    for raw in media:
        try:
            if raw is None:
                raise Damaged("null")
            images.append(parse(raw))
            errors.append(None)
        except Damaged as e:
            images.append(None)
            errors.append(str(e))
    try:
        decoded = decode_many(images)
    except Damaged:  # a filter type that doesn't exist: each image by itself
        decoded = []
        for k, im in enumerate(images):
            try:
                decoded += decode_many([im])
            except Damaged as e:
                decoded.append(None)
                images[k], errors[k] = None, str(e)
    out = []
    for raw, im, x, error in zip(media, images, decoded, errors):
        size = (None, None) if raw is None else (len(raw), hashlib.sha256(raw).hexdigest())
        if im is None:
            out.append((*[None] * 7, *size, None, error, *[None] * samples))
            continue
        if im.colour == 3:
            if x.max() >= len(im.palette) // 3:
                out.append((*[None] * 7, *size, None, "a colour beyond the palette", *[None] * samples))
                continue
            x = np.frombuffer(im.palette, np.uint8).reshape(-1, 3)[x[..., 0]]
        plain = x.tobytes() if x.dtype == np.uint8 else x.astype(">u2").tobytes()
        out.append((im.width, im.height, im.depth, im.colour, len(plain), hashlib.sha256(plain).hexdigest(), zlib.crc32(plain[-64:]), *size, hash_image(x), None, *[plain] * samples))
    return out


def text_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 64, level: int = 6) -> DataFrame:
    """Every whole text as the samples of a PNG in a binary column of a table, read back: read_png of (doc_id, n_bytes, media).

    The text's UTF-8 bytes are filled with zeros to whole rows, one at least; a null text is an empty one. Each row is stored
    and read by itself, so null and repeated ids, repeated rows and other columns do no harm; equal texts give equal values,
    as cells and cosines are whole numbers. An empty table gives an empty one. The table is dropped by `release()`.
    """
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    stored = Table(to_png(d, F.col("text"), width, level=level), "media", compression="uncompressed")
    return read_png(stored.df)
