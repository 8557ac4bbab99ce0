"""Letters that the tokenizer's tables do not know yet."""

import random

import public_tokenizers
import regex
from tokenizers import Tokenizer

from exposure.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_letters_of_newer_tables():
    """Contractions, letters and numbers behind and before letters of every age."""
    library, own = Tokenizer.from_file(PATH), bpe.vocabulary(PATH)
    every = [chr(i) for i in [*range(0x80, 0xD800), *range(0xE000, 0x30000)]]
    known = bpe.NewerLetters(PATH)
    newer = [c for c in regex.findall(r"[\p{L}\p{N}]", "".join(every[:0x2000])) if known[c]]
    assert "౜" in newer or not regex.match(r"\p{L}", "౜")
    rng = random.Random(1)
    texts = [f"a{c}'s 1{c}'re {c}{c}'t  {c}d.{c}" for c in newer]
    texts += ["".join(rng.choices(every + newer * 50 + list("ab 1'sdt\n"), k=30)) for _ in range(3000)]
    ids, bounds = own.encode(texts)
    for text, start, stop in zip(texts, bounds, bounds[1:]):
        assert ids[start:stop].tolist() == library.encode(text, add_special_tokens=False).ids, text
