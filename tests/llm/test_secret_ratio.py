"""How many random strings the token ratio finds, and how many ordinary ones it leaves alone."""

import random
import string

from tidemark.llm import secrets
from tidemark.llm.queries import SCAN_VOCABULARY


def test_random_strings_are_found_and_ordinary_ones_are_not():
    encode = secrets.encoding(*SCAN_VOCABULARY).encode_ordinary
    r = random.Random(11)
    for letters, size, least in ((string.ascii_letters + string.digits, 32, 0.97), (string.ascii_letters + string.digits + "+/", 40, 0.97), (string.ascii_uppercase + string.digits, 24, 0.95), (string.ascii_lowercase + string.digits, 28, 0.9)):
        keys = ["".join(r.choice(letters) for _ in range(size)) for _ in range(300)]
        found = sum(any(k == 3 for _, k, _ in secrets.scan(f"see {x} there", encode, 2.0)) for x in keys)
        assert found >= least * len(keys), (letters, found)
    words = ["account", "settings", "user", "profile", "update", "handler", "request", "response", "index", "value", "north", "river", "market", "family"]
    plain = []
    for _ in range(300):
        w = [r.choice(words) for _ in range(4)]
        plain += ["_".join(w), "-".join(w), w[0] + "".join(x.title() for x in w[1:]), "/".join(w), "".join(w)]
    wrong = [x for x in plain if len(x) >= 20 and secrets.scan(f"the {x} is", encode, 2.0)]
    assert len(wrong) <= 0.01 * len(plain), wrong[:5]
