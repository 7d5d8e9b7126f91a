"""Word-level BPE files (lower-cased words with an end-of-word mark), encoded
as the tokenizers library does.

White space separates words and is dropped, so the ids of a text are those of
its white-space-separated chunks; chunks are remembered.  An unseen chunk of
ordinary Latin characters is lower-cased, cut by the file's word pattern, and
merged by tiktoken's rank-based merge: the end-of-word mark is the byte 0xFF
(never in UTF-8), whose merges come first.  Any other chunk goes through the
library itself, and so does a text with U+001C to U+001F, which Python alone
counts as white space.
"""

from __future__ import annotations

import json
import sys
from array import array
from functools import cached_property, lru_cache

import numpy as np
import regex

from .bpe import byte_chars

#: fixed word pattern of such files
PATTERN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
_PLAIN = regex.compile(r"[!-~\xA1-įı-ſ]+")
_SEPARATORS = ("\x1c", "\x1d", "\x1e", "\x1f")
_END = "</w>"
CACHE_CHUNKS = 200_000


class WordBpe:
    def __init__(self, path: str):
        import tiktoken

        self.path = path
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        to_byte = byte_chars()
        self.specials = [t["content"] for t in spec["added_tokens"]]
        ranks = {}
        for token, i in spec["model"]["vocab"].items():
            if token not in self.specials:
                word, end = (token[:-len(_END)], b"\xff") if token.endswith(_END) else (token, b"")
                ranks[bytes(to_byte[c] for c in word) + end] = i
        self.ranked = tiktoken.Encoding("ranked", pat_str=r".+", mergeable_ranks=ranks,
                                        special_tokens={})._core_bpe
        self.chunks: dict[str, bytes] = {}

    @cached_property
    def exact(self):
        """The library's own tokenizer, loaded when a text needs it."""
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(self.path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        return tokenizer

    def chunk(self, text: str) -> bytes:
        if not _PLAIN.fullmatch(text) or "<" in text and any(s in text for s in self.specials):
            return self.library(text)
        ids = array("I")
        for piece in PATTERN.findall(text.lower()):
            ids.extend(self.ranked.encode_single_piece(piece.encode() + b"\xff"))
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()

    def library(self, text: str) -> bytes:
        return np.array(self.exact.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        if any(c in text for c in _SEPARATORS):
            return self.library(text)
        chunks = text.split()
        parts = list(map(self.chunks.get, chunks))
        if None in parts:
            found = {c: self.chunk(c) for c, p in zip(chunks, parts) if p is None}
            if len(self.chunks) < CACHE_CHUNKS:
                self.chunks.update(found)
            parts = [found[c] if p is None else p for c, p in zip(chunks, parts)]
        return b"".join(parts)


@lru_cache(maxsize=2)
def codec(path: str) -> WordBpe:
    return WordBpe(path)
