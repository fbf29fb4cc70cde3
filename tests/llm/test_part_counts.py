"""Counts by the parts of a text between blanks are those of the whole text."""

import random

import public_tokenizers
import pytest

from tickloom.llm import token_counts
from tickloom.llm.token_counts import PartCounts, load_tokenizer

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
PIECES = [
    "a", "Z", "É", "e", "́", "ΑΣ", "İ", "ſ", "'", "'s", "'LL", "1", "42", "!", "<|endoftext|>", "<|", "|>",
    " ", "  ", "\n", "\t", " ", " ", "　", "\x1c", "\x85", "‍", "漢字", "가", "ᄀ", "ᅡ", "🙂",
]


@pytest.mark.parametrize("limit", [0, token_counts.KNOWN_CHARS])
def test_parts_have_the_tokens_of_the_text(limit):
    tokenizer, margin = load_tokenizer(VOCABULARY)
    assert margin is not None
    rng = random.Random(limit)
    texts = ["", " ", "  a  "] + ["".join(rng.choices(PIECES, k=rng.randrange(40))) for _ in range(3000)]
    parts = PartCounts(tokenizer, limit)
    got = [n for at in range(0, len(texts), 100) for n in parts.of(texts[at : at + 100])]
    assert got == [len(tokenizer.encode(t, add_special_tokens=False)) for t in texts]


def test_a_part_is_encoded_once():
    tokenizer, _ = load_tokenizer(VOCABULARY)
    asked = []

    class Asked:
        def encode_batch_fast(self, texts, add_special_tokens):
            asked.extend(texts)
            return tokenizer.encode_batch_fast(texts, add_special_tokens=add_special_tokens)

    parts = PartCounts(Asked())
    assert parts.of(["one two one", "two three"]) == parts.of(["one two one", "two three"])
    assert sorted(asked) == ["one", "three", "two"]
