"""Random runs of letters in one case are secrets, long words are not."""

import random

from tidemark.llm import secrets
from tidemark.llm.queries import SCAN_VOCABULARY


def test_one_case_keys():
    encode = secrets.encoding(*SCAN_VOCABULARY).encode_ordinary
    r = random.Random(7)
    for letters, least in (("abcdefghijklmnopqrstuvwxyz", 85), ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", 95)):
        keys = ["".join(r.choice(letters) for _ in range(32)) for _ in range(100)]
        found = [secrets.scan(f"use {k} here", encode, 2.0) for k in keys]
        assert sum(f == [(4, 3, 36)] for f in found) >= least
    for word in ("averyveryverylongordinaryword", "internationalizationspecification", "-" * 40):
        assert secrets.scan(f"the {word} is", encode, 2.0) == []
