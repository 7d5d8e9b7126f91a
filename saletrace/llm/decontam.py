"""Benchmark decontamination: short test items inside long documents.

*Shingles.*  Text is lower-cased; words are runs of ASCII letters, digits and
code points above U+007F; shingles are five consecutive words.  An item of
fewer words is one shingle of its own length.  A document contains an item if
at least ``CONTAINMENT`` = 0.8 of the item's distinct shingles are among the
document's.

*Size-partitioned MinHash.*  Items are partitioned by their number q of
distinct shingles, in powers of two.  In the partition of sizes up to u, an
item's sketch is its ``floor(0.2 u) + 1`` smallest shingle hashes (a bottom-k
MinHash).  A document that contains the item misses at most 0.2 q of its
shingles, so at least one sketch value is among the document's: no contained
item is lost, whatever the document's length.  The document's side of the
sketch is all its shingle hashes up to the largest sketch value of any
partition; a bitmap over hash bits drops nearly all others first.

*Verification.*  Each candidate's shingles are compared as words, exactly.

The items are taken in blocks of ``BLOCK_ITEMS`` (by item id), and each block
is matched against all documents in one pass without a shuffle; what is sent
to the executors is bounded by the block.

Defined results.  Null or empty document: contains nothing.  Item without a
word (or null): matches nothing.  Repeated items or rows: each reported.
Null ids are carried through.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices

SHINGLE, CONTAINMENT = 5, 0.8
BLOCK_ITEMS = 50_000
_MISS = 1 - CONTAINMENT
_BITS = 20
_NOT_WORD = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in range(256))


def words_of(text: str) -> list[bytes]:
    return text.lower().encode("utf-8", "surrogatepass").translate(_NOT_WORD).split()


def _mix(hashes: np.ndarray, size: int) -> np.ndarray:
    n = len(hashes) - size + 1
    with np.errstate(over="ignore"):
        out = hashes[:n].copy()
        for k in range(1, size):
            out *= np.uint64(0x9E3779B97F4A7C15)
            out += hashes[k:k + n]
        out ^= out >> np.uint64(31)
        out *= np.uint64(0xBF58476D1CE4E5B9)
        out ^= out >> np.uint64(29)
    return out


def _hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)


def _shingles(words: list[bytes], size: int) -> set[tuple[bytes, ...]]:
    return set(zip(*[words[k:] for k in range(size)]))


def sketch_size(q: int) -> int:
    """Sketch values of an item of ``q`` distinct shingles: enough for the
    largest size of its partition."""
    upper = (1 << q.bit_length()) - 1
    return min(q, math.floor(round(_MISS * upper, 9)) + 1)


class SketchIndex:
    """The sketches of one block of items, by shingle length."""

    def __init__(self, items: list[tuple[int | None, str | None]]):
        self.items = []
        by_size: dict[int, list[tuple[int, int]]] = {}
        for ident, text in items:
            words = words_of(text or "")
            if not words:
                continue
            size = min(SHINGLE, len(words))
            grams = _shingles(words, size)
            number = len(self.items)
            self.items.append((ident, size, grams))
            values = np.unique(_mix(_hashes(words), size))
            for v in values[:sketch_size(len(grams))].tolist():
                by_size.setdefault(size, []).append((v, number))
        self.tables = {}
        for size, entries in by_size.items():
            entries.sort()
            keys = np.array([e[0] for e in entries], np.uint64)
            bitmap = np.zeros(1 << _BITS, bool)
            bitmap[(keys >> np.uint64(64 - _BITS)).astype(np.int64)] = True
            self.tables[size] = (keys, np.array([e[1] for e in entries]), bitmap)

    def candidates(self, words: list[bytes]) -> set[int]:
        hashes, found = _hashes(words), set()
        for size, (keys, owner, bitmap) in self.tables.items():
            if len(words) < size:
                continue
            h = _mix(hashes, size)
            h = h[bitmap[(h >> np.uint64(64 - _BITS)).astype(np.int64)]]
            if len(h):
                lo, hi = np.searchsorted(keys, h, "left"), np.searchsorted(keys, h, "right")
                for a, b in {*zip(lo[hi > lo].tolist(), hi[hi > lo].tolist())}:
                    found.update(owner[a:b].tolist())
        return found

    def contained(self, text: str) -> list[tuple[int | None, int, int]]:
        """``(item id, its shingles, those in the text)``."""
        words = words_of(text)
        if not words or not (candidates := self.candidates(words)):
            return []
        own = {size: _shingles(words, size) for size in {self.items[i][1] for i in candidates}}
        out = []
        for i in sorted(candidates):
            ident, size, grams = self.items[i]
            shared = len(grams & own[size])
            if shared >= math.ceil(round(CONTAINMENT * len(grams), 9)):
                out.append((ident, len(grams), shared))
        return out


_HITS = T.ArrayType(T.StructType([T.StructField("item_id", T.LongType()),
                                  T.StructField("n_shingles", T.LongType()),
                                  T.StructField("n_shared", T.LongType())]))


_indexes: dict[str, SketchIndex] = {}


def block_index(key: str, items: list[tuple[int | None, str | None]]) -> SketchIndex:
    """A block's index in this Python worker (whose ``hash`` it uses), kept
    from task to task; the last few blocks are held."""
    if key not in _indexes:
        while len(_indexes) >= 4:
            _indexes.pop(next(iter(_indexes)))
        _indexes[key] = SketchIndex(items)
    return _indexes[key]


def hits_udf(items: list[tuple[int | None, str | None]]):
    """Texts to the items of this block they contain."""
    key = hashlib.sha256(repr(items).encode("utf-8", "surrogatepass")).hexdigest()

    @F.arrow_udf(_HITS)
    def hits(text: pa.Array) -> pa.Array:
        index = block_index(key, items)
        return pa.array([[{"item_id": a, "n_shingles": b, "n_shared": c}
                          for a, b, c in index.contained(x or "")]
                         for part in slices(text) for x in part],
                        pa.list_(pa.struct([("item_id", pa.int64()), ("n_shingles", pa.int64()),
                                            ("n_shared", pa.int64())])))
    return hits


def item_blocks(items: DataFrame, id_col: str = "item_id", text_col: str = "text",
                size: int = BLOCK_ITEMS):
    """The items as lists of at most ``size``, in the order of their ids; one
    block at a time is held."""
    block = []
    rows = items.select(items[id_col].cast("bigint").alias("i"), items[text_col].alias("t"))
    for r in rows.orderBy("i", "t").toLocalIterator():
        block.append((r.i, r.t))
        if len(block) == size:
            yield block
            block = []
    if block:
        yield block


def contained_items(docs: DataFrame, items: DataFrame, id_col: str = "doc_id",
                    text_col: str = "text", block: int = BLOCK_ITEMS) -> DataFrame:
    """One row for each document and item it contains: the document's id,
    ``item_id, n_shingles, n_shared, containment``."""
    out = None
    for part in item_blocks(items, size=block):
        hit = docs.select(docs[id_col].alias(id_col),
                          F.explode(hits_udf(part)(docs[text_col])).alias("h"))
        out = hit if out is None else out.union(hit)
    if out is None:
        out = docs.select(docs[id_col].alias(id_col),
                          F.explode(F.lit(None).cast(_HITS)).alias("h"))
    return out.select(id_col, "h.*").withColumn(
        "containment", F.col("n_shared") / F.col("n_shingles"))


def drop_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text",
                      block: int = BLOCK_ITEMS) -> DataFrame:
    """The rows of ``docs`` that contain no item, with their own columns."""
    for part in item_blocks(items, size=block):
        docs = docs.filter(F.size(hits_udf(part)(docs[text_col])) == 0)
    return docs


def containment_sql(documents: str = "documents", items: str = "benchmark") -> str:
    """DuckDB SQL of :func:`contained_items`, from the definition alone."""
    word = r"[a-z0-9]|[^\x00-\x7F]"
    grams = "string_split(array_to_string(w[i:i + n - 1], ' '), chr(0))[1]"
    return f"""
WITH words AS (
  SELECT 0 AS kind, doc_id AS id, regexp_extract_all(lower(text), '({word})+') AS w FROM {documents}
  UNION ALL
  SELECT 1, item_id, regexp_extract_all(lower(text), '({word})+') FROM {items}
), item_grams AS (
  SELECT DISTINCT id, n, {grams} AS g
  FROM (SELECT id, w, least(5, len(w)) AS n, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS i
        FROM words WHERE kind = 1 AND len(w) > 0)
), sizes AS (SELECT DISTINCT n FROM item_grams
), doc_grams AS (
  SELECT DISTINCT id, n, {grams} AS g
  FROM (SELECT id, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM words, sizes WHERE kind = 0 AND len(w) >= n)
), total AS (SELECT id, count(*) AS n_shingles FROM item_grams GROUP BY id
), shared AS (
  SELECT d.id AS doc_id, i.id AS item_id, count(*) AS n_shared
  FROM doc_grams d JOIN item_grams i ON d.n = i.n AND d.g = i.g GROUP BY 1, 2
)
SELECT doc_id, item_id, n_shingles, n_shared, n_shared / n_shingles AS containment
FROM shared JOIN total ON shared.item_id = total.id
WHERE 10 * n_shared >= 8 * n_shingles
"""
