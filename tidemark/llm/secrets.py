"""Secret scan: credential patterns, and random strings that a token vocabulary compresses badly."""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch, map_batches, passed, replaced

#: The base patterns.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex", "random")

#: Lengths of hexadecimal digests that are published on purpose (MD5, SHA-1, SHA-2 family).
DIGESTS = {32, 40, 56, 64, 96, 128}
_UUID = re.compile(r"[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}\Z")
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
_PARTS = re.compile(r"[A-Z]?[a-z]{2,}|[A-Z]{2,}(?![a-z])|[0-9]{1,4}(?![0-9])|[+/_=-]+")
_WORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")

#: Characters from which on what a base span leaves of a long run is judged.
REST = 8

_encodings: dict[str, object] = {}


def encoding(ranks_file: str, pattern: str):
    if ranks_file not in _encodings:
        import tiktoken

        with open(ranks_file, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _encodings[ranks_file] = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _encodings[ranks_file]


def known(s: str) -> bool:
    """Digests, UUIDs, words, numbers and identifiers made of them."""
    core = s.strip("+/_=-")
    if not core or core.isdigit() or (core.isalpha() and (core.islower() or core.isupper() or core[1:].islower())):
        return True
    if re.fullmatch("[0-9a-f]+|[0-9A-F]+", core):
        return len(core) in DIGESTS
    if _UUID.match(core):
        return True
    numbers = len(re.findall("[0-9]+", core))
    if numbers and (numbers > 3 or not re.search("[_/=+-]", core)):  # words and numbers without a seam: their tokens tell
        return False
    return len(_PARTS.sub("", core)) <= 0.1 * len(core)


def one_case(s: str) -> bool:
    """Letters of one case, or with one leading capital: a word or a random key, which only its tokens tell."""
    core = s.strip("+/_=-")
    return core.isalpha() and (core.islower() or core.isupper() or core[1:].islower())


def scan(text: str, encode, min_ratio: float) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of every span, in order; code points, end exclusive."""
    spans = []
    low = text.lower()
    if any(w in low for w in _WORDS):
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    base = sorted(spans)
    for m in _CANDIDATE.finditer(text):
        at = m.start()
        # what base spans leave of a run is judged too: it stands beside a secret, so a shorter piece will do
        cuts = [(a, z) for a, _, z in base if a < m.end() and m.start() < z]
        for a, z in [*cuts, (m.end(), m.end())]:
            s = text[at:a]
            if len(s) >= (REST if cuts else 1) and (one_case(s) or not known(s)) and len(s) < min_ratio * len(encode(s)):
                spans.append((at, 3, a))
            at = max(at, z)
    return sorted(spans)


def _replaced(text: str | None, spans: list[tuple[int, int, int]], mark: str) -> str | None:
    """The text with every run of spans that overlap or touch replaced once."""
    if not text or not spans:
        return text
    parts, at = [], 0
    for a, _, z in spans:
        if a > at or not parts:
            parts += [text[at:a], mark]
        at = max(at, z)
    return "".join([*parts, text[at:]])


def redact(docs: DataFrame, vocabulary: tuple[str, str], text_col: str = "text", length_col: str | None = None, min_ratio: float = 2.0, mark: str = "[SECRET]") -> DataFrame:
    """All rows and columns of `docs`, with the spans of `find_secrets` replaced by `mark` in the text.

    `length_col`, where it is given and there, becomes the text's number of code points in the rows that change. Null and
    empty texts stay as they are, ids aren't looked at, repeated rows change alike, and an empty table gives no rows.
    """
    names = docs.columns
    at = names.index(text_col)
    length_at = names.index(length_col) if length_col in names else None

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        encode = encoding(*vocabulary).encode_ordinary
        before = b.column(at).to_pylist()
        after = [_replaced(t, scan(t, encode, min_ratio), mark) if t else t for t in before]
        new = {text_col: after}
        if length_at is not None:
            new[length_col] = [n if x == y else len(y) for n, x, y in zip(b.column(length_at).to_pylist(), before, after)]
        return replaced(b, **new)

    return passed(docs, run)


def find_secrets(docs: DataFrame, vocabulary: tuple[str, str], id_col: str = "doc_id", text_col: str = "text", min_ratio: float = 2.0, redact: str | None = None) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random; with `redact`, also the text with spans replaced.

    vocabulary: the file of tiktoken ranks and its pattern. A run of 20 or more base-64 characters with fewer than
    `min_ratio` characters per token is random, unless it is a known digest, UUID, number or identifier. Of a run that holds
    base spans, what they leave is judged in pieces of 8 or more. Runs of letters in one case are judged by their tokens
    alone. Base spans always stay.

    A null text is an empty one (redacted, it stays null). Null ids and repeated rows are answered each. An empty table
    gives no rows. Other columns are ignored.
    """
    schema = pa.schema([("doc_id", pa.int64()), *((n, pa.int64()) for n in ("n_assign", "n_access", "n_hex")), ("base_sha256", pa.string()), ("spans", pa.string()), ("n_random", pa.int64()), ("redacted", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoding(*vocabulary).encode_ordinary
        for b in batches:
            out = []
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                spans = scan(text or "", encode, min_ratio)
                n = [sum(k == x for _, k, _ in spans) for x in range(4)]
                named = [f"{KINDS[k]}:{a}:{z}" for a, k, z in spans]
                base = ",".join(x for x, (_, k, _) in zip(named, spans) if k < 3)
                clean = _replaced(text, spans, redact) if redact is not None else None
                out.append((doc_id, *n[:3], hashlib.sha256(base.encode()).hexdigest(), ",".join(named), n[3], clean))
            yield batch(schema, *([r[i] for r in out] for i in range(8)))

    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    found = map_batches(d, run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_random long, redacted string")
    return found if redact is not None else found.drop("redacted")
