"""Pieces of the cached encoders."""

import numpy as np
import public_tokenizers

from matchloom.llm.tokens import TextEncoder


def test_words_beside_a_line_break_are_no_pieces_of_their_own():
    encoder = TextEncoder(public_tokenizers.path("word_bpe_49k.json"), False)
    library = encoder.library.tokenizer
    texts = ["one two", "One\ntwo three", "\tthree\r\n\x0b two  one\n", "three\x0cone", "a\xa0b\x1cc\x85d \x1f e\n", "\n", "İs ªº\nx"]
    for text, raw in zip(texts, encoder.ids(texts)):
        assert np.frombuffer(raw, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text
    plain = TextEncoder(public_tokenizers.path("word_bpe_49k.json"), False)
    plain.ids(texts[:4])
    assert set(plain.pieces.cache) <= {"one", "two", "three"}
