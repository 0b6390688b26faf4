"""Chunks that hold added tokens or characters beyond ASCII give the ids of the whole text."""

import random

import numpy as np
from tokenizers import Tokenizer

from aerolith.llm import packing
from aerolith.llm.queries import tokenizer_path

PARTS = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|", "|>", "H̱", "T̈", "J̌", "İ", "é",
         "́", "Σ", "字", "a", "done", "12", ".", ",", "'s", "_", "\x01", "\x1c", "\x85", "　", " ", " ", "\n"]


def test_added_tokens_and_composed_characters():
    tokenizer = Tokenizer.from_file(tokenizer_path())
    words, rng = packing.WordIds(tokenizer), random.Random(1)
    texts = ["done.<|endoftext|>", "a b<|startoftext|>", "(x<|endoftext|>).", "H̱ T̈ J̌", "Η̱. H̱,"]
    texts += ["".join(rng.choices(PARTS, k=rng.randint(1, 9))) for _ in range(5000)]
    for text in texts:
        want = np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        assert words.text_ids(text.encode()) == want, text
    assert words.text_ids(b"done.<|endoftext|>") == np.array([1700, 269, 49407], "<u4").tobytes()
