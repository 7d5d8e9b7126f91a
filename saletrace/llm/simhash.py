"""Near-duplicates by SimHash, found through Golay-code keys.

*Fingerprint.*  A-Z are lower-cased, words are runs of code points other than
space and U+0009 to U+000D, shingles are three consecutive words joined by a
space (fewer words: the whole sequence), repeats included.  Bit b is set if
it is set in over half of the shingles' XXH64 (seed 42).

*Search.*  Two fingerprints link at ``MAX_BITS`` = 2 or fewer differing bits.
Copies share a fingerprint, so only distinct fingerprints are searched.  The
64 bits are three segments (22, 21, 21).  Two errors leave at least one
segment untouched (pigeonhole), and the segment after it has at most two.
The perfect binary Golay code (23, 12, 7) finds those: every 23-bit word is
keyed by the indices of all codewords within distance 4 (one or six of them),
and two words at distance 2 or less always share one.  So a fingerprint gets,
per segment, the keys (segment number, its bits, one codeword index of the
next segment), 33 bits wide.  Fingerprints under one key are joined and
verified by their bit distance.

*Crowded keys.*  A key with over ``CROWD`` distinct fingerprints would make
too many pairs.  Its fingerprints instead meet in the balls of radius one: x
and y differ in at most two bits exactly if some z is at most one bit from
both.  At most 65 fingerprints can meet at one z, all of them linked through
it, so a grouped minimum gives the links without making any pairs.  No link
is lost either way.

Defined results.  Null or empty text: fingerprint zero, linked like any
other.  Null id: such a row takes part; the component's id is the smallest
id that is not null, or null if there is none.  Repeated rows: one result row
each.  Very long text: fingerprinted whole, in blocks.  No documents: no rows.
Further columns, whatever their names, are not looked at; ``keep_one`` returns
them unchanged.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import id_and_text, materialize, packed, slices, unpacked
from .components import components

SHINGLE, SEED, MAX_BITS = 3, 42, 2
CROWD = 64
#: (shift, width) of the three segments
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: generator polynomial of the Golay code, x^11+x^9+x^7+x^6+x^5+x+1
GENERATOR = 0b101011100011
_UPPER_TO_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def shingles(text: str) -> list[bytes]:
    words = text.encode("utf-8", "surrogatepass").translate(_UPPER_TO_LOWER).split()
    if len(words) <= SHINGLE:
        return [b" ".join(words)] if words else []
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.empty_like(ends)
    starts[0], starts[1:] = 0, ends[:-1] + 1
    n = len(words) - SHINGLE + 1
    return [joined[a:b] for a, b in zip(starts[:n].tolist(), ends[SHINGLE - 1:].tolist())]


_CHUNK = 1 << 16


def fingerprint(text: str) -> int:
    """The unsigned 64-bit SimHash of one text."""
    parts = shingles(text)
    if not parts:
        return 0
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for at in range(0, len(parts), _CHUNK):
        h = np.array([digest(x, SEED) for x in parts[at:at + _CHUNK]], dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1,
                              bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(parts), bitorder="little").view("<u8")[0])


@F.arrow_udf(T.LongType())
def fingerprint_udf(text: pa.Array) -> pa.Array:
    values = np.array([fingerprint(x or "") for part in slices(text) for x in part], dtype=np.uint64)
    return pa.array(values.view(np.int64))


@lru_cache(maxsize=1)
def golay_keys() -> tuple[np.ndarray, np.ndarray]:
    """For each syndrome of the code: the error patterns of weight up to 4
    with that syndrome (padded with the first) and how many there are.  A
    word xor an error pattern is a codeword; its low 12 bits after the check
    bits are the codeword's index."""
    syndrome_of_bit = np.zeros(23, np.int64)
    for i in range(23):
        v = 1 << i
        for j in range(i, 10, -1):
            if v >> j & 1:
                v ^= GENERATOR << (j - 11)
        syndrome_of_bit[i] = v
    patterns: list[list[int]] = [[] for _ in range(2048)]

    def grow(start: int, left: int, error: int, syndrome: int) -> None:
        patterns[syndrome].append(error)
        if left:
            for i in range(start, 23):
                grow(i + 1, left - 1, error | 1 << i, syndrome ^ int(syndrome_of_bit[i]))

    grow(0, 4, 0, 0)
    count = np.array([len(p) for p in patterns])
    table = np.array([p + p[:1] * (count.max() - len(p)) for p in patterns], np.int64)
    return table, count


@lru_cache(maxsize=1)
def _syndrome_tables() -> tuple[np.ndarray, np.ndarray]:
    """Syndromes of the low 12 and of the high 11 bits of a word."""
    def syndrome(v: int) -> int:
        for j in range(22, 10, -1):
            if v >> j & 1:
                v ^= GENERATOR << (j - 11)
        return v
    return (np.array([syndrome(v) for v in range(4096)]),
            np.array([syndrome(v << 12) for v in range(2048)]))


def fuzzy_keys(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For 23-bit words: the indices of the codewords within distance 4, as
    (row of the word, index) pairs."""
    table, count = golay_keys()
    low, high = _syndrome_tables()
    s = low[words & 0xFFF] ^ high[words >> 12]
    row = np.repeat(np.arange(len(words)), count[s])
    nth = np.arange(len(row)) - np.repeat(np.cumsum(count[s]) - count[s], count[s])
    return row, (words[row] ^ table[s[row], nth]) >> 11


@F.arrow_udf(T.ArrayType(T.LongType()))
def segment_keys_udf(fp: pa.Array) -> pa.Array:
    bits = fp.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    part = [((bits >> np.uint64(a)) & np.uint64((1 << w) - 1)).astype(np.int64)
            for a, w in SEGMENTS]
    rows, keys = [], []
    for i in range(3):
        row, index = fuzzy_keys(part[(i + 1) % 3])
        rows.append(row)
        keys.append((i << 34) | (part[i][row] << 12) | index)
    row, key = np.concatenate(rows), np.concatenate(keys)
    order = np.argsort(row, kind="stable")
    offsets = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(bits)))])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(key[order]))


def links(prints: DataFrame) -> DataFrame:
    """``prints``: distinct ``fp``.  Pairs ``u, v`` that connect all
    fingerprints linked at ``MAX_BITS`` or fewer bits."""
    keyed = prints.select("fp", F.explode(segment_keys_udf("fp")).alias("key"))
    sized = materialize(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n"),
                                                 F.min("fp").alias("lo"))
                        .filter("n > 1").select("key", "n"), "golay-keys")
    # keys met by one fingerprint alone go before the rows are joined
    met = materialize(keyed.join(sized, "key"), "golay-met")
    few = met.filter(F.col("n") <= CROWD).select("key", "fp")
    pairs = (few.join(few.select("key", F.col("fp").alias("other")), "key")
             .filter((F.col("fp") < F.col("other"))
                     & (F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= MAX_BITS))
             .select(F.col("fp").alias("u"), F.col("other").alias("v")))
    crowd = met.filter(F.col("n") > CROWD).select("fp").distinct()
    flips = F.array(F.lit(0).cast("bigint"),
                    *[F.lit(1 << b if b < 63 else -(1 << 63)).cast("bigint") for b in range(64)])
    ball = crowd.select("fp", F.explode(F.transform(
        flips, lambda z: F.col("fp").bitwiseXOR(z))).alias("z"))
    centre = ball.groupBy("z").agg(F.min("fp").alias("v"), F.count(F.lit(1)).alias("n"),
                                   F.collect_set("fp").alias("all"))
    # at most 65 fingerprints lie around one z
    star = centre.filter("n > 1").select(F.explode("all").alias("u"), "v").filter("u != v")
    return pairs.union(star)


def group_prints(prints: DataFrame) -> DataFrame:
    """``prints``: ``id, fp`` per row.  Returns ``fp, component_id, root`` per
    distinct fingerprint; ``root`` names the component and is never null."""
    distinct = materialize(prints.groupBy("fp").agg(F.min("id").alias("least")), "prints")
    roots = components(links(distinct.select("fp")))
    named = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    named = materialize(named, "roots")
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return materialize(named.select("fp", "root").join(least, "root"), "groups")


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, fp, component_id, root``, one row per row of ``docs``."""
    rows = id_and_text(docs, id_col, text_col)
    prints = materialize(rows.select("id", fingerprint_udf("text").alias("fp")), "fingerprints")
    return prints.join(group_prints(prints), "fp")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component: that of the smallest id, or
    any one where the component has no id (or repeats the row).

    Rows are written once with their fingerprint and a number, which stays
    theirs from then on.  Survivors are picked by number alone, so no text is
    fingerprinted twice.  Texts meet the survivors' numbers in one semi join,
    always by a merge on the number, which no two rows share: its cost is that
    of one shuffle of the texts at every size."""
    text = F.coalesce(docs[text_col], F.lit(""))
    rows = materialize(packed(docs, number=F.monotonically_increasing_id(),
                              id=docs[id_col].cast("bigint"), fp=fingerprint_udf(text)), "numbered")
    prints = rows.select("number", "id", "fp")
    groups = group_prints(prints.select("id", "fp"))
    # an id may stand on several texts: the row is that of the component's own;
    # copies are reduced to one row before any join
    own = prints.groupBy("fp").agg(
        F.min(F.struct(F.col("id").isNull().alias("bare"), "id", "number")).alias("least"))
    survivors = own.join(groups.select("fp", "root"), "fp").groupBy("root").agg(
        F.min("least").alias("least"))
    survivors = materialize(survivors.select("least.number"), "survivors")
    return unpacked(rows.join(survivors.hint("merge"), "number", "left_semi"), docs)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: its id, fingerprint (16 hex digits), component."""
    g = simhash_groups(docs, id_col, text_col)
    return g.select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0"))
                    .alias("fingerprint"), "component_id")
