"""The packing encoder hands each different word to the tokenizer once, without the marks after it, and words of letters as one text."""

import numpy as np
import pyarrow as pa
import public_tokenizers
from tokenizers import Tokenizer

from curbline.llm import packing

TEXTS = ["", " ", "\n a  b\t", "it's, don't!! x's' 's '", "a<|startoftext|><|endoftext|> b <|ENDOFTEXT|>", "<|endoftext|>",
         "é. É! ñ$$ ½² x² Ⅷ á. 　 a　b \x85 \x1c ok", "你好 世界,  ok\x1c\x85 don't ́x", "a_b foo-bar--, ...", "word " * 5000,
         "İstanbul İ. ǅ ﬁ K Å", "123 4.5, 6% a1b2!?", "≠ ≮ a≠ é.", "\x00 a\x00", "क्षि. हिन्दी ก็ ไทย", "𝔸𝕓 😀. a😀.", "a'll've. we'RE"]


class Counted:
    def __init__(self, tokenizer):
        self.tokenizer, self.words, self.texts = tokenizer, [], 0

    def encode(self, given, **options):
        self.texts += isinstance(given, str)
        self.words += given.split(" ") if isinstance(given, str) else given
        return self.tokenizer.encode(given, **options)


def test_words_are_encoded_once_and_without_marks():
    path = public_tokenizers.path("word_bpe_49k.json")
    encoder, tokenizer = packing.WordEncoder(path), Tokenizer.from_file(path)
    encoder.tokenizer = counted = Counted(encoder.tokenizer)
    texts = ["Tree tree, tree!? tree### 7, 7###", "tree. tree!? don't. don't"]
    for _ in range(2):
        found = [np.frombuffer(ids, "<u4").tolist() for ids in encoder.encode(texts)]
        assert found == [tokenizer.encode(text, add_special_tokens=False).ids for text in texts]
    assert sorted(counted.words) == sorted(["tree", ",", "!?", "###", ".", "7", "don't"]) and counted.texts == 1


def test_odd_words_have_the_ids_of_the_tokenizer(monkeypatch):
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    # Blanks other than the six that separate words are the tokenizer's own matter.
    expected = [tokenizer.encode(text, add_special_tokens=False).ids for text in TEXTS]
    for most in (packing.WORDS_KEPT, 0):
        monkeypatch.setattr(packing, "WORDS_KEPT", most)
        encoder = packing.WordEncoder(path)
        for _ in range(2):
            assert [np.frombuffer(ids, "<u4").tolist() for ids in encoder.encode(TEXTS)] == expected
            ids, ends = encoder.encoded(pa.array(TEXTS), b"\0\0\0\0")
            assert [part.tolist() for part in np.split(ids, ends)[:-1]] == [[*own, 0] for own in expected]
    assert encoder.encode([]) == []
