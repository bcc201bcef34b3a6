"""Text functions: Column builders where Spark has the parts, Arrow UDFs for NFKC, case folding and sequence matching."""

from __future__ import annotations

import difflib
import hashlib
import re
import unicodedata
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NOT_WORD = re.compile(r"[\W_]+")
CLIP = 8000


def normalized(value: str | None) -> str:
    """NFKC, case folding, every run of characters that are no letters or digits one blank, trimmed."""
    return _NOT_WORD.sub(" ", unicodedata.normalize("NFKC", value or "").casefold()).strip()


@F.pandas_udf(T.StringType())
def normalize_text(s: pd.Series) -> pd.Series:
    return s.map(normalized, na_action=None)


def collapse_ws(c: Column) -> Column:
    """Words joined by one blank; null stays null."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def inline_text(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"[\r\n]+", " "))


def clip(c: Column, n: int = CLIP) -> Column:
    return F.substring(c, 1, n)


def features(c: Column) -> Column:
    """Tokens and character trigrams of normalised text (the whole of it, if shorter)."""
    grams = F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(c) - 2)), lambda i: F.substr(c, i.cast("int"), F.lit(3)))
    return F.when(F.length(c) == 0, F.array().cast("array<string>")).otherwise(F.concat(F.split(c, " "), grams))


def simhash64(normal: Column) -> Column:
    """SimHash of normalised text as 16 hexadecimal digits: each feature votes with the first 64 bits of its SHA-256.

    An expression that never leaves the JVM, for short texts; the Arrow form is faster on long ones.
    """
    hashes = F.transform(features(normal), lambda x: F.sha2(x.cast("binary"), 256))

    def nibble(q: int):
        return lambda h: F.conv(F.substring(h, q + 1, 1), 16, 10).cast("int")

    def vote(b: int):
        return lambda acc, x: acc + F.shiftrightunsigned(x, 3 - b).bitwiseAND(F.lit(1)) * 2 - 1

    digits = []
    for q in range(16):
        nibbles = F.transform(hashes, nibble(q))
        bits = [F.when(F.aggregate(nibbles, F.lit(0), vote(b)) > 0, F.lit(8 >> b)).otherwise(F.lit(0)) for b in range(4)]
        digits.append(F.lower(F.conv((bits[0] + bits[1] + bits[2] + bits[3]).cast("string"), 10, 16)))
    return F.concat(*digits)


class _Votes:
    """The 64 bits of features, kept for those that come again: a row of sixteen words, in each four counters of sixteen bits.

    Rows are added as they are, up to 65,535 of them. Trigrams are looked up by a table of slots; what has no slot by name.
    """

    SLOTS = 20

    def __init__(self, most: int = 200_000):
        self.most, self.place = most, {}
        self.table = np.empty((most, 16), np.uint64)
        self._forget()

    def _forget(self) -> None:
        self.place.clear()
        self.held, self.at = np.full(1 << self.SLOTS, -1, np.int64), np.zeros(1 << self.SLOTS, np.int32)

    def room(self, more: int) -> None:
        """For so many that may be new; before their rows are asked for."""
        if len(self.place) + more > self.most:
            self._forget()
            if more > self.most:
                self.most = 2 * more
                self.table = np.empty((self.most, 16), np.uint64)

    def rows(self, keys: list, feature: Callable) -> np.ndarray:
        place, n = self.place, len(self.place)
        if new := [k for k in dict.fromkeys(keys) if k not in place]:
            digests = b"".join([hashlib.sha256(feature(k).encode()).digest()[:8] for k in new])
            self.table[n : n + len(new)] = np.unpackbits(np.frombuffer(digests, np.uint8)).astype("<u2").view("<u8").reshape(-1, 16)
            place.update(zip(new, range(n, n + len(new))))
        return np.array([place[k] for k in keys], np.int64)

    def grams(self, keys: np.ndarray) -> np.ndarray:
        slot = ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.SLOTS)).astype(np.int64)
        rows, other = self.at[slot].astype(np.int64), self.held[slot] != keys
        if other.any():
            part, left, at = (1 << 21) - 1, keys[other], slot[other]
            rows[other] = found = self.rows(left.tolist(), lambda g: chr(g >> 42) + chr(g >> 21 & part) + chr(g & part))
            empty = self.held[at] < 0
            at, first = np.unique(at[empty], return_index=True)  # one for each slot
            self.held[at], self.at[at] = left[empty][first], found[empty][first]
        return rows

    def ones(self, rows: np.ndarray) -> np.ndarray:
        """How many of the features have each bit."""
        total = np.zeros(64, np.int64)
        for start in range(0, len(rows), 65_535):
            total += self.table[rows[start : start + 65_535]].sum(0).view("<u2")
        return total


_word_votes, _gram_votes = _Votes(), _Votes()


def simhash_py(normal: str) -> str:
    """Words and character trigrams (the whole text, if shorter) vote with the first 64 bits of their SHA-256."""
    if not normal:
        return "0" * 16
    words = normal.split(" ")
    code = np.frombuffer(normal.encode("utf-32-le"), np.uint32).astype(np.int64)
    if len(code) < 3:
        words, grams = [*words, normal], np.empty(0, np.int64)
    else:
        grams = code[:-2] << 42 | code[1:-1] << 21 | code[2:]
    _word_votes.room(len(words))
    _gram_votes.room(len(grams))
    ones = _word_votes.ones(_word_votes.rows(words, str)) + _gram_votes.ones(_gram_votes.grams(grams))
    return np.packbits(2 * ones > len(words) + len(grams)).tobytes().hex()


@F.pandas_udf(T.StringType())
def simhash64_arrow(s: pd.Series) -> pd.Series:
    """For long texts: the same digest, one Arrow batch at a time."""
    return s.map(lambda x: simhash_py(x or ""))


def hamming(a: Column, b: Column) -> Column:
    signed = lambda h: F.conv(h, 16, -10).cast("bigint")
    return F.bit_count(signed(a).bitwiseXOR(signed(b)))


def ratio(candidate: str, existing: str) -> float:
    """Asymmetric similarity of normalised texts: the candidate is the first sequence."""
    if not candidate or not existing:
        return 0.0
    return 1.0 if candidate == existing else difflib.SequenceMatcher(None, candidate, existing).ratio()


# ---- fixed values: phone numbers, 18-character identity numbers with a date of birth, both bounded by digits only ----
PHONE = r"(?<!\d)(?:\+?86[-\s]?)?1[3-9]\d{9}(?!\d)"
IDENTITY = r"(?<!\d)\d{6}(?:19|20)\d{2}(?:0[1-9]|1[0-2])(?:[0-2]\d|3[01])\d{3}[\dXx](?!\d)"
PHONE_MARK, IDENTITY_MARK = "[手机号]", "[身份证号]"
# ---- end of fixed values ----


def redact_pii(c: Column) -> Column:
    """Mainland mobile numbers and identity numbers become placeholders, beside letters too."""
    return F.regexp_replace(F.regexp_replace(c, PHONE, PHONE_MARK), IDENTITY, IDENTITY_MARK)


_PHONE, _IDENTITY = re.compile(PHONE, re.A), re.compile(IDENTITY, re.A)
_OWNER = re.compile(r"user.?id|author.?id", re.I)


def redact_value(value, key: str = ""):
    """The same for nested values of a payload; what stands under a user's or author's id is masked."""
    if isinstance(value, dict):
        return {k: redact_value(v, str(k)) for k, v in value.items()}
    if isinstance(value, list):
        return [redact_value(v, key) for v in value]
    if not isinstance(value, str):
        return value
    return "***" if _OWNER.search(key) else _IDENTITY.sub(IDENTITY_MARK, _PHONE.sub(PHONE_MARK, value))
