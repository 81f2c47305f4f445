"""Token ids of whole texts, word by word with a bounded cache.

A single space between two characters that are not white space always starts a new word of
the byte-level pattern, so the parts between such spaces can be encoded on their own.
"""

from __future__ import annotations

import base64
import re

_SINGLE_SPACE = re.compile(r"(?<=\S) (?=\S)")
_SPECIAL = "<|endoftext|>"
_CACHED = 600_000


class _Uneven(Exception):
    """A part that begins with white space: the text has longer gaps than one space."""


class Encoder(dict):
    """Maps a word after a space to the little-endian unsigned 32-bit ids, as bytes.

    ``tokenizer`` is the path of a ``tokenizers`` file. ``ranks``, if given, is the same
    vocabulary as ranks; it encodes Latin words faster, with the same ids.
    """

    def __init__(self, tokenizer: str, ranks: str | None = None, pattern: str | None = None):
        import numpy as np
        from tokenizers import Tokenizer

        super().__init__()
        slow = Tokenizer.from_file(tokenizer)
        self._slow = lambda text: np.array(slow.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        self._fast = None
        if ranks:
            import tiktoken

            with open(ranks, "rb") as lines:
                known = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=known, special_tokens={})
            self._fast = lambda text: np.array(fast.encode_ordinary(text), "<u4").tobytes()
        self._marks = {mark: self._part(mark) for mark in ".,"}

    def _part(self, text: str) -> bytes:
        if self._fast and (text.isascii() or max(text) < "ɐ"):
            return self._fast(text)
        return self._slow(text)

    def __missing__(self, word: str) -> bytes:
        if not word or word[0].isspace():
            raise _Uneven
        if len(self) >= _CACHED:
            self.clear()
        if word[-1] in self._marks and word[:-1].isalpha():
            ids = self[word[:-1]] + self._marks[word[-1]]  # letters and marks are words of their own
        else:
            ids = self._part(" " + word)
        if len(word) < 64:
            self[word] = ids
        return ids

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if _SPECIAL in text:
            return self._slow(text)
        first, *words = text.split(" ")
        try:
            if not first:
                raise _Uneven
            return self._part(first) + b"".join(map(self.__getitem__, words))
        except _Uneven:
            first, *words = _SINGLE_SPACE.split(text)
            return self._part(first) + b"".join(map(self.__getitem__, words))
