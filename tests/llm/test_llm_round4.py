"""Characters that one Unicode table knows and another does not."""

import unicodedata

import numpy as np

from shelfwise.llm import packing, queries


def test_a_character_unknown_to_python_goes_through_the_whole_tokenizer():
    tok = packing.CachedTokenizer(queries.tokenizer_path())
    unknown = [chr(c) for c in range(0x110000) if unicodedata.category(chr(c)) == "Cn"]
    for text in ["A\U00013460", *[f"Ab{c}" for c in unknown[::997]]]:
        assert np.frombuffer(tok.encode(text.encode()), "<u4").tolist() == tok.whole.encode(text, add_special_tokens=False).ids, ascii(text)
