"""Word-wise encoding with a tokenizer that drops white space.

The pre-tokenizer of such a vocabulary never joins characters across ASCII
white space, so a text's ids are the ids of its white-space separated words,
one after another. Each distinct word is encoded once per worker by the
tokenizers library and kept as little-endian unsigned 32-bit ids.
"""

from __future__ import annotations

import os

import numpy as np

from tickrisk.llm.common import per_worker

PUNCTUATION = b".,;:!?"


class WordIds(dict):
    """word (UTF-8) -> ids as bytes; encodes a missing word."""

    def __init__(self, encode, most: int):
        super().__init__()
        self.encode, self.most = encode, most

    def __missing__(self, word: bytes) -> bytes:
        # a mark after a letter or digit is a token of its own
        if len(word) > 1 and word[-1] in PUNCTUATION and word[-2:-1].isalnum():
            ids = self[word[:-1]] + self[word[-1:]]
        else:
            ids = self.encode(word)
        if len(word) <= 64:                  # long words are rare: not kept
            if len(self) >= self.most:
                self.clear()
            self[word] = ids
        return ids


class WordEncoder:
    """Ids of whole texts. ``path``: vocabulary file of the tokenizers library whose
    pre-tokenizer drops white space; ``most_words`` bounds the memory of the word cache (about
    200 bytes a word)."""

    def __init__(self, path: str, most_words: int = 1_000_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.ids = WordIds(self._encode, most_words)

    def _encode(self, word: bytes) -> bytes:
        found = self.tokenizer.encode(word.decode("utf-8", "replace"), add_special_tokens=False)
        return np.array(found.ids, "<u4").tobytes()

    def __call__(self, text: bytes) -> bytes:
        """Ids as little-endian unsigned 32-bit integers. ASCII letters are lower-cased
        before the lookup (the vocabulary does so anyway), unless the text may hold a
        special token, which is matched as written."""
        return b"".join(map(self.ids.__getitem__, (text if b"<|" in text else text.lower()).split()))


def word_encoder(path: str) -> WordEncoder:
    return per_worker(("words", path), lambda: WordEncoder(path))
