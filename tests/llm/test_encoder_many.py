"""Many texts at once give the ids of the tokenizer's file, text by text."""

import random

from tests.llm.test_llm import ODD
from tidemark.llm import packing
from tidemark.llm.queries import PACK_VOCABULARY


def test_many():
    from tokenizers import Tokenizer

    plain, encode = Tokenizer.from_file(PACK_VOCABULARY[0]), packing.encoder(*PACK_VOCABULARY)
    r = random.Random(1)
    parts = ["a", "b", " ", "  ", "\n", "\t", "é", "1", ".", "'s", " \n", "\xa0", "　", "word", "\x1c", "\0", "<|endoftext|>"]
    lists = [["".join(r.choice(parts[: 17 if r.random() < 0.1 else 16]) for _ in range(r.randint(0, 14))) for _ in range(r.randint(1, 60))] for _ in range(60)]
    for texts in [*lists, [t or "" for _, t in ODD], [""], ["", ""], [" "]]:
        for text, ids in zip(texts, encode.many([t.encode() for t in texts]), strict=True):
            assert [int.from_bytes(ids[k : k + 2], "little") for k in range(0, len(ids), 2)] == plain.encode(text, add_special_tokens=False).ids, repr(text)
