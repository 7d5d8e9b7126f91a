"""Byte-level BPE encoding and decoding by tree concatenation.

Equal to the tokenizers library for the given tokenizer file, without special
tokens being added.  A text is not split at words first: it is halved until
the pieces are short (``LEAF_CHARS``), the pieces are encoded in parallel, and
neighbours are joined up the tree.  A join re-encodes a window around the
cut, growing it on either side until the new encoding begins with the left
piece's token there and ends with the right piece's.  Both sides then agree
exactly: a token sequence is the encoding of its text if each neighbouring
pair is (merges are by rank), every pair left of the window is one of the left
piece, every pair right of it one of the right piece, and the rest the
window's own.  A window that reaches both ends is the whole text.

Texts over ``SPREAD_CHARS`` are dealt out as pieces over the cluster and
joined by text; the others go through the same tree within a task.

A leaf of ordinary characters (``_UNUSUAL`` has the others) is looked up word
by word: a space after a character that is not white space always begins a
new pre-token, so words encode independently there.  Unseen words go through
the rank-based encoder of tiktoken built from the same vocabulary; a leaf with
any unusual character, or the text of a special token, goes through the
tokenizers library itself.

Defined results.  Null text: as empty, no tokens.  Null ids and repeated rows
are carried through, one result row each.  Other columns are left out.
"""

from __future__ import annotations

import json
from functools import cached_property, lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import id_and_text, slices

LEAF_CHARS, SPREAD_CHARS = 4096, 65536
#: words a Python worker remembers; beyond, words are encoded again
CACHE_WORDS = 100_000
#: fixed pre-token pattern of byte-level BPE files
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
_UNUSUAL = regex.compile(r"[^\t\n\r -~\xA1-\xAC\xAE-ſ–—‘-”€]")
_WHITE = "\t\n\r "


def byte_chars() -> dict[str, int]:
    """The printable character that stands for each byte in the file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteBpe:
    """One byte-level BPE file; holds the worker's memory of words."""

    def __init__(self, path: str):
        self.path = path
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        to_byte = byte_chars()
        added = {t["id"]: t["content"] for t in spec["added_tokens"]}
        ranks = {bytes(to_byte[c] for c in token): i
                 for token, i in spec["model"]["vocab"].items() if i not in added}
        self.token_bytes = [b""] * (max([*ranks.values(), *added]) + 1)
        for token, i in ranks.items():
            self.token_bytes[i] = token
        for i, token in added.items():
            self.token_bytes[i] = token.encode()
        self.lengths = np.array([len(t) for t in self.token_bytes])
        self.specials = list(added.values())
        self.reach = max([8, *(len(t.encode()) for t in self.specials)])
        self.added = set(added)
        self.words: dict[str, bytes] = {}

    @cached_property
    def exact(self):
        """The library's own tokenizer, loaded when a text needs it."""
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(self.path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        return tokenizer

    @cached_property
    def ranked(self):
        import tiktoken

        ranks = {t: i for i, t in enumerate(self.token_bytes) if t and i not in self.added}
        return tiktoken.Encoding("ranked", pat_str=PATTERN, mergeable_ranks=ranks,
                                 special_tokens={})

    def plain(self, text: str) -> bool:
        return not _UNUSUAL.search(text) and not any(s in text for s in self.specials)

    def leaf(self, text: str) -> np.ndarray:
        """The ids of a short text."""
        if not text:
            return np.zeros(0, np.uint32)
        if not self.plain(text):
            return np.array(self.exact.encode(text, add_special_tokens=False).ids, np.uint32)
        if any(c + " " in text for c in _WHITE):
            return self.ranked.encode_to_numpy(text)
        first, *rest = text.split(" ")
        parts = list(map(self.words.get, rest))
        if None in parts:
            new = list({w for w, p in zip(rest, parts) if p is None})
            ids = self.ranked.encode_to_numpy(" " + " ".join(new))
            ends = np.cumsum(self.lengths[ids])
            stops = np.searchsorted(ends, np.cumsum([len(w.encode()) + 1 for w in new]), "left") + 1
            raw, at, found = ids.astype("<u4").tobytes(), 0, {}
            for w, stop in zip(new, (4 * stops).tolist()):
                found[w] = raw[at:stop]
                at = stop
            if len(self.words) < CACHE_WORDS:
                self.words.update(found)
            parts = [found[w] if p is None else p for w, p in zip(rest, parts)]
        head = self.ranked.encode_to_numpy(first).astype("<u4").tobytes() if first else b""
        return np.frombuffer(head + b"".join(parts), "<u4")

    def text_of(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.token_bytes.__getitem__, ids.tolist()))

    def _start(self, ids: np.ndarray, n: int) -> int:
        """Where a window of the last ``n`` tokens or more may begin: at a
        whole character, not before an apostrophe (it may begin a
        contraction), not within white space (how that is split depends on
        what follows) and with every special token's text in reach."""
        i = max(0, len(ids) - n)
        while i > 0 and (len(ids) - i < self.reach and self.lengths[ids[i:]].sum() < self.reach
                         or self.token_bytes[ids[i]][0] & 0xC0 == 0x80
                         or self.token_bytes[ids[i]][:1] == b"'"
                         or self._chars(ids[i:i + 4])[:1].isspace()
                         and self._chars(ids[max(0, i - 4):i])[-1:].isspace()):
            i -= 1
        return i

    def _chars(self, ids: np.ndarray) -> str:
        return self.text_of(ids).decode("utf-8", "replace")

    def _stop(self, ids: np.ndarray, n: int) -> int:
        """Where a window of the first ``n`` tokens or more may end: at a
        whole character, after none of white space, an apostrophe or what a
        contraction may have after it."""
        j = min(len(ids), n)
        while j < len(ids) and (j < self.reach and self.lengths[ids[:j]].sum() < self.reach
                                or self.token_bytes[ids[j]][0] & 0xC0 == 0x80
                                or b"'" in self.text_of(ids[max(0, j - 3):j])[-3:]
                                or self._chars(ids[max(0, j - 4):j])[-1:].isspace()):
            j += 1
        return j

    def join(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The encoding of two encoded texts one after the other."""
        if not len(left) or not len(right):
            return left if len(left) else right
        a = b = 4
        while True:
            i, j = self._start(left, a), self._stop(right, b)
            window = self.text_of(left[i:]) + self.text_of(right[:j])
            middle = self.leaf(window.decode())
            agrees_left = i == 0 or middle[0] == left[i]
            agrees_right = j == len(right) or middle[-1] == right[j - 1]
            if agrees_left and agrees_right:
                return np.concatenate([left[:i], middle, right[j:]])
            a, b = a if agrees_left else 2 * (len(left) - i), b if agrees_right else 2 * j

    def tree(self, pieces: list[np.ndarray]) -> np.ndarray:
        """Joins neighbours, then those, up to one."""
        while len(pieces) > 1:
            pieces = [self.join(*pieces[k:k + 2]) if k + 1 < len(pieces) else pieces[k]
                      for k in range(0, len(pieces), 2)]
        return pieces[0] if pieces else np.zeros(0, np.uint32)

    def encode(self, text: str) -> np.ndarray:
        return self.tree([self.leaf(x) for x in halves(text, LEAF_CHARS)])

    def decode(self, ids: np.ndarray) -> str:
        return self.text_of(ids).decode("utf-8", "replace")


def halves(text: str, most: int) -> list[str]:
    """``text`` halved until no piece is over ``most`` characters."""
    parts = 1
    while len(text) > most * parts:
        parts *= 2
    cuts = [len(text) * k // parts for k in range(parts + 1)]
    return [text[a:b] for a, b in zip(cuts, cuts[1:])]


@lru_cache(maxsize=2)
def codec(path: str) -> ByteBpe:
    return ByteBpe(path)


_IDS = T.ArrayType(T.IntegerType())


def _id_lists(rows: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows], dtype=np.int64)])
    flat = np.concatenate(rows) if rows else np.zeros(0, np.uint32)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()),
                                    pa.array(flat.astype(np.int32)))


def encode_udf(path: str):
    @F.arrow_udf(_IDS)
    def encode(text: pa.Array) -> pa.Array:
        bpe = codec(path)
        return _id_lists([bpe.encode(x or "") for part in slices(text) for x in part])
    return encode


def decode_udf(path: str):
    @F.arrow_udf(T.StringType())
    def decode(ids: pa.Array) -> pa.Array:
        bpe = codec(path)
        flat = ids.values.to_numpy(zero_copy_only=False)
        ends = ids.offsets.to_numpy(zero_copy_only=False)
        return pa.array([bpe.decode(flat[a:b]) for a, b in zip(ends[:-1], ends[1:])], pa.string())
    return decode


@F.arrow_udf(T.ArrayType(T.StringType()))
def _pieces_udf(text: pa.Array) -> pa.Array:
    return pa.array([halves(x, SPREAD_CHARS) for x in text.to_pylist()], pa.list_(pa.string()))


def _join_group(path: str):
    def join(pdf: pd.DataFrame) -> pd.DataFrame:
        bpe, pdf = codec(path), pdf.sort_values("pos")
        ids = bpe.tree([np.asarray(x, np.uint32) for x in pdf["ids"]])
        return pd.DataFrame({"id": pdf["id"].iloc[:1], "copies": pdf["copies"].iloc[:1],
                             "ids": [ids.astype(np.int32)]})
    return join


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, ids`` for each row of ``docs``; ``path``: the tokenizer
    file, present on every executor."""
    rows = id_and_text(docs, id_col, text_col)
    short = rows.filter(F.length("text") <= SPREAD_CHARS)
    short = short.select("id", encode_udf(path)("text").alias("ids"))
    # equal rows are encoded once: a text is then named by its id and digest,
    # which a task that is run again finds the same
    long = (rows.filter(F.length("text") > SPREAD_CHARS).groupBy("id", "text")
            .agg(F.count(F.lit(1)).cast("int").alias("copies")))
    pieces = long.select("id", "copies", F.sha2("text", 256).alias("name"),
                         F.posexplode(_pieces_udf("text")).alias("pos", "piece"))
    spread = pieces.repartition("id", "name", "pos").select(
        "id", "copies", "name", "pos", encode_udf(path)("piece").alias("ids"))
    joined = spread.groupBy("id", "name").applyInPandas(
        _join_group(path), "id bigint, copies int, ids array<int>")
    again = joined.select("id", "ids", F.explode(F.sequence(F.lit(1), "copies")))
    return short.union(again.select("id", "ids")).withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """Adds ``text``, the decoded ids (special tokens' text included); null
    ids give an empty text.  The ids pass through the JVM as a column, so
    that a plan that also reads them does not encode twice."""
    ids = F.coalesce(encoded[ids_col], F.array().cast("array<int>"))
    return encoded.withColumn("text", decode_udf(path)(ids))
