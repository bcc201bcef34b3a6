"""Lexicons of a smaller language, silent in every other row, are not outweighed by those of a larger one."""

import random

import numpy as np

from tidemark.llm import toxicity


def test_a_smaller_language_is_learned_too():
    r = random.Random(4)
    common = {k: [f"{k}word{a}{b}" for a in "abcdefgh" for b in "klmnopqr"] for k in ("la", "mo")}
    bad = {"la": [x + "grim" for x in "bcdfghjklm"], "mo": ["zuror" + x for x in "abcdefgh"]}
    texts, y, lang = [], [], []
    for _ in range(2000):
        k = "la" if r.random() < 0.8 else "mo"
        toxic = r.random() < 0.12
        said = r.choices(common[k], k=40) + (r.sample(bad[k], r.randint(4, 7)) if toxic else [])
        r.shuffle(said)
        texts.append(" ".join(said))
        y.append(float(toxic))
        lang.append(k)
    found = [toxicity.features_of(t) for t in texts]
    weights, bias = toxicity.train(np.concatenate([x[0] for x in found]), np.array([len(x[0]) for x in found]), np.array([x[1] for x in found]), np.array(y))
    caught = [bias + sum(weights.get(int(f) & 0xFFFFFFFF, 0.0) for f in x[0]) > np.log(0.3 / 0.7) for x in found]
    for k in common:
        assert np.mean([c for c, t, of in zip(caught, y, lang) if t and of == k]) > 0.95
        assert np.mean([c for c, t, of in zip(caught, y, lang) if not t and of == k]) < 0.02
