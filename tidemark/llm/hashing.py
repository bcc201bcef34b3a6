"""Word sequences as arrays: 64-bit word hashes of whole batches, and rolling hashes of their windows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash

#: Odd bases of the rolling hashes.
BASE = 0x9E3779B97F4A7C15
_CHUNK = 6 << 20


_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
_LONG = 64  # bytes from which a word is hashed by itself


def _stir(h: np.ndarray) -> np.ndarray:
    h *= np.uint64(BASE)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def hash_spans(raw: bytes, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """64-bit hashes of spans of bytes, after which eight more bytes stand at least."""
    loads = np.ndarray((len(raw) - 7,), "<u8", raw, 0, (1,))  # the eight bytes from every place on
    h = _stir(size.astype(np.uint64) + np.uint64(1))
    at, off = np.flatnonzero(size > 0), 0
    while len(at) and off < _LONG:
        v = loads[first[at] + off] & _MASKS[np.minimum(size[at] - off, 8)]
        h[at] = _stir(h[at] ^ v)
        off += 8
        at = at[size[at] > off]
    for k in at.tolist():
        h[k] = xxhash.xxh64_intdigest(raw[first[k] : first[k] + size[k]])
    return h


def hash_texts(texts: list[bytes | None], lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts, one after the other, and each text's first position (and the end).

    Words are read eight bytes at a time, all words at once, so there is no object and no cache for a word. `lower` lowers
    A-Z. Words of up to eight bytes have distinct hashes if they are of one length; others are as good as random.
    """
    texts = [t or b"" for t in texts]
    raw = b"\n".join([*texts, b"\0" * 8])
    if lower:
        raw = raw.lower()
    n = len(raw) - 8
    flat = np.frombuffer(raw, np.uint8)
    inner = ~_BLANK[flat[:n]]
    edges = np.flatnonzero(inner[1:] != inner[:-1]) + 1
    if n and inner[0]:
        edges = np.r_[0, edges]
    first, size = edges[::2], edges[1::2] - edges[::2]
    h = hash_spans(raw, first, size)
    begins = np.cumsum([0, *(len(t) + 1 for t in texts)])
    return h, np.searchsorted(first, begins)


def chunks(rows: list, text_at: int, limit: int = _CHUNK) -> Iterator[list]:
    """Consecutive rows of about `limit` bytes of text, or of one longer text."""
    out, size = [], 0
    for r in rows:
        n = len(r[text_at] or b"")
        if out and size + n > limit:
            yield out
            out, size = [], 0
        out.append(r)
        size += n
    if out:
        yield out


def rolling(h: np.ndarray, size: int) -> np.ndarray:
    """A hash of every `size` consecutive entries (across documents too): two steps mix what a plain polynomial leaves."""
    n = len(h) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    # windows by doubling: the hash of 2k entries from those of k
    out, have, powers = None, 0, h.copy()
    width, factor, rest, done = 1, BASE, size, 0
    while rest:
        if rest & 1:
            part = powers[done : done + n]
            out = part.copy() if out is None else out * np.uint64(factor) + part
            done += width
        rest >>= 1
        if rest:
            powers = powers[: len(powers) - width] * np.uint64(factor) + powers[width:]
            width *= 2
            factor = (factor * factor + 2 * width) % 2**64 | 1
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(32)
    return out


def inside(at: np.ndarray, size: int, n: int) -> np.ndarray:
    """Which of the n windows of `size` entries lie in one document."""
    ok = np.ones(n, bool)
    for end in at[1:-1]:
        ok[max(0, end - size + 1) : end] = False
    return ok


def owner(at: np.ndarray, n: int) -> np.ndarray:
    """The document of each of the first n positions."""
    return np.repeat(np.arange(len(at) - 1), np.diff(at))[:n]


def sliding_min(x: np.ndarray, size: int) -> np.ndarray:
    """The least of every `size` consecutive entries."""
    n, width = len(x) - size + 1, 1
    if n <= 0:
        return x[:0]
    while width * 2 <= size:
        x = np.minimum(x[: len(x) - width], x[width:])
        width *= 2
    return np.minimum(x[:n], x[size - width : size - width + n])
