"""Exact ids of a lower-casing, word-splitting BPE vocabulary, fast on repeated words.

Words are encoded apart from each other, so a text of plain characters (printable ASCII, line
ends, tabs, Latin-1 letters) is lower-cased, split by the vocabulary's own pattern and looked up
word by word; a word not seen yet goes to the vocabulary's merge model once and is kept in a
table of bounded size. White space is dropped by the vocabulary and no rule reaches over it, so
in any other text only the chunks between spaces with other characters, or with the start of a
special string, are given to the library whole.
"""

from __future__ import annotations

import re
import sys
import zlib
from array import array

import numpy as np
from tokenizers import Tokenizer, pre_tokenizers

_LETTERS = "".join(map(chr, [*range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x100)]))
_PLAIN = "".join(map(chr, range(0x21, 0x7F))) + _LETTERS
_OTHER = re.compile(r"[^\t\n\r\x20-\x7e" + _LETTERS + "]|<\\|")
_SMALL = "".join(sorted(set(_LETTERS.lower())))
# The vocabulary's pattern for lower-case plain text.
_WORDS = re.compile(rf"'(?:s|t|re|ve|m|ll|d)|[a-z{_SMALL}]+|[0-9]|[^\sa-z0-9{_SMALL}]+")
_SPACES = re.compile(r"[\t\n\r ]+")
# Words remembered per Python worker.
KNOWN_WORDS = 800_000


class WordIds(dict):
    """Little-endian 16-bit ids by lower-case word."""

    def __init__(self, content: bytes):
        super().__init__()
        self.tokenizer = Tokenizer.from_str(content.decode())
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids do not fit 16 bits")
        self.merge = self.tokenizer.model.tokenize
        bytewise = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.spelled = str.maketrans({c: bytewise.pre_tokenize_str(c)[0][0] for c in _PLAIN})
        self.check()

    def check(self) -> None:
        """Refuse a vocabulary that treats plain text otherwise than assumed here."""
        for probe in ("It's 12, ÀÉ-ß ok!?'ve", *_PLAIN, *(f"a{c}B{c} {c}'re" for c in _PLAIN)):
            if self.encode(probe) != self.library(probe):
                raise ValueError(f"the vocabulary splits {probe!r} in its own way")

    def library(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, "<u2").tobytes()

    def __missing__(self, word: str) -> bytes:
        # Printable ASCII is spelled as itself.
        spelled = word if word.isascii() else word.translate(self.spelled)
        found = array("H", [t.id for t in self.merge(spelled)])
        if sys.byteorder == "big":
            found.byteswap()
        ids = found.tobytes()
        if len(self) >= KNOWN_WORDS:
            self.clear()
        self[word] = ids
        return ids

    def encode(self, text: str) -> bytes:
        if _OTHER.search(text) is None:
            return b"".join(map(self.__getitem__, _WORDS.findall(text.lower())))
        out = []
        for chunk in _SPACES.split(text):
            if _OTHER.search(chunk):
                out.append(self.library(chunk))
            else:
                out += map(self.__getitem__, _WORDS.findall(chunk.lower()))
        return b"".join(out)


_loaded: dict[int, WordIds] = {}


def word_ids(content: bytes) -> WordIds:
    key = zlib.crc32(content)
    if key not in _loaded:
        _loaded[key] = WordIds(content)
    return _loaded[key]
