"""The prefix trie of rebuilt conversations, by composable fingerprints.

A conversation is rebuilt as the head of its base conversation (its first h
turns) followed by its own turns after its first h.  No rebuilt text is made.

*Fingerprints.*  A turn is hashed to numbers x; a sequence of turns maps to the
element (C^n, S) with S = sum of x_i * C^i modulo a prime.  Sequences are joined
by the monoid product (C^n, S) * (C^m, T) = (C^(n+m), S + C^n * T).  So a prefix
of a conversation is a running sum over its turns, its suffix after h turns a
difference of two such sums, and the rebuilt prefix of depth d the head's
element times the suffix's, shifted by a power of C: symbolic arithmetic on a
few longs per turn.  Four primes of 31 bits, with a base each, are packed in
two longs.  Running sums over a conversation are themselves products of pieces
(the rows of one range partition), so no conversation need be in one task.

*Groups and their check.*  Rebuilt prefixes of one depth and fingerprint are one
node.  Each prefix refers to its last turn, stored once in the table.  (1) Turns
of one digest must be of one (role, text): the stored turns are grouped by both.
(2) Prefixes of one node must end in one turn digest.  A difference between two
prefixes of one node would show under (2) at the depth where it is last, since
the sums after it agree only if they agreed there.  Where either count is not
zero, the digests and bases are drawn anew and the node table is made again.

*Subtrees.*  Nodes with the same smallest member are a chain along that
conversation.  A node's subtree is the rest of its chain, and the whole chains
of its other members.  So its sums are a running sum over its chain, plus the
chain totals of its members: a second sum over the same groups, to which a
conversation sends only the prefixes above its own chain.

*Work in Spark.*  Every step is a grouped aggregate with map-side combining, a
join on distinct keys, or a join whose hot keys are sliced
(``operators.skew``): the root and a common first turn have very many members
and children.  The ends of a node are joined in chunks and digested in a
stream.

Defined results.  Null role or text becomes empty.  Turns are ordered by turn
(null first), then role, then the text's SHA-256.  Repeated rows are turns of
their own.  Rows without a ``conv_id`` belong to no conversation.  A
conversation rebuilt to no turns is a member of the root.  An empty table gives
no rows.  Extra columns, whatever their names, are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saletrace.operators.chunks import joined_chunks
from saletrace.operators.skew import HOT_ROWS, sliced_join

from .common import materialize
from .hashing import streamed_sha256

#: primes below 2^31, so that products and running sums of 2^31 rows fit a long
PRIMES = (2147483647, 2147483629, 2147483587, 2147483579)
BASE_SIZE, HEAD_MOD = 100, 6
CHAIN_BLOCK = 65_536
TRIES = 8
_SUMS = ("s0", "s1", "s2", "s3")


def draw(attempt: int) -> tuple[int, ...]:
    """The bases of an attempt."""
    r = np.random.default_rng([attempt, 12])
    return tuple(int(r.integers(1 << 20, p - 1)) for p in PRIMES)


# ---- modular arithmetic on columns ------------------------------------------------

def powers(n: np.ndarray, base: int, prime: int) -> np.ndarray:
    """base^n modulo prime, by squaring, for an array of exponents."""
    out, square, n = np.ones(len(n), np.uint64), np.uint64(base), n.astype(np.uint64)
    p = np.uint64(prime)
    while n.any():
        out = np.where(n & np.uint64(1), out * square % p, out)
        square, n = square * square % p, n >> np.uint64(1)
    return out


def _power_udf(bases: tuple[int, ...]):
    @F.arrow_udf(T.ArrayType(T.LongType()))
    def power(n: pa.Array) -> pa.Array:
        at = n.to_numpy(zero_copy_only=False)
        flat = np.stack([powers(at, b, p) for b, p in zip(bases, PRIMES)], 1).astype(np.int64)
        return pa.ListArray.from_arrays(pa.array(np.arange(0, 4 * len(at) + 1, 4), pa.int32()),
                                        pa.array(flat.reshape(-1)))
    return power


def _mod(c: Column, i: int) -> Column:
    return F.pmod(c, F.lit(PRIMES[i]).cast("bigint"))


def _pack(s: list[Column]) -> list[Column]:
    return [F.shiftleft(s[0], 31).bitwiseOR(s[1]), F.shiftleft(s[2], 31).bitwiseOR(s[3])]


def _turn_numbers() -> list[Column]:
    """A turn's four numbers, from 120 bits of its digest."""
    half = [F.conv(F.substring("digest", a, 15), 16, 10).cast("bigint") for a in (1, 16)]
    return [_mod(half[i // 2], i) for i in range(4)]


# ---- turns and their running products ------------------------------------------------

def turns(conversations: DataFrame, salt: int) -> DataFrame:
    """``c, turn, digest, len``: a row per turn, without its text."""
    role, text = (F.coalesce(F.col(x), F.lit("")) for x in ("role", "text"))
    return conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("c"), F.col("turn").cast("bigint").alias("turn"),
        role.alias("role"), F.sha2(F.concat(F.lit(f"{salt}:"), F.length(role).cast("string"),
                                            F.lit(":"), role, text), 256).alias("digest"),
        F.sha2(text, 256).alias("tie"), F.length(text).cast("bigint").alias("len"))


def doubtful_turns(conversations: DataFrame, salt: int) -> int:
    """How many digests stand for two stored turns or more that differ."""
    role, text = (F.coalesce(F.col(x), F.lit("")) for x in ("role", "text"))
    stored = conversations.where("conv_id is not null").select(
        role.alias("role"), text.alias("text"),
        F.sha2(F.concat(F.lit(f"{salt}:"), F.length(role).cast("string"), F.lit(":"), role, text),
               256).alias("digest")).groupBy("digest", "role", "text").agg(F.lit(1).alias("one"))
    return stored.groupBy("digest").agg(F.count("one").alias("n")).where("n > 1").count()


def numbered(rows: DataFrame) -> DataFrame:
    """``c, i, digest, len``: ``i`` from 1 in the conversation's order.  Range
    partitions of the sorted turns are counted by themselves; the rows of a
    conversation in earlier partitions are added."""
    order = [F.col("c"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("tie")]
    placed = materialize(rows.repartitionByRange(*order).sortWithinPartitions(*order)
                         .withColumn("id", F.monotonically_increasing_id())
                         .select("c", "digest", "len", "id",
                                 F.shiftright("id", 33).alias("part")), "trie-turns")
    local = placed.withColumn("nth", F.row_number().over(
        Window.partitionBy("c", "part").orderBy("id")).cast("bigint"))
    before = _before(placed.groupBy("c", "part").agg(F.count(F.lit(1)).alias("n")), "c", "part",
                     ["n"])
    return local.join(before, ["c", "part"]).select(
        "c", (F.col("nth") + F.col("n")).alias("i"), "part", "digest", "len")


def _before(totals: DataFrame, group: str, piece: str, columns: list[str]) -> DataFrame:
    """For each piece of a group: the sums of the pieces before it.  A group
    has as many pieces as partitions or blocks, not rows."""
    w = Window.partitionBy(group).orderBy(piece).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(group, piece, *[F.coalesce(F.sum(x).over(w), F.lit(0)).alias(x)
                                         for x in columns])


def running(rows: DataFrame, bases: tuple[int, ...]) -> DataFrame:
    """``numbered`` with ``s0..s3``: the running sums up to each turn, and
    ``x0..x3``, its own numbers."""
    power = _power_udf(bases)("i")
    terms = rows.withColumn("w", power).withColumn("x", F.array(*_turn_numbers()))
    terms = materialize(terms.select("c", "i", "part", "digest", "len", "x", *[
        _mod(F.col("x")[k] * F.col("w")[k], k).alias(f"t{k}") for k in range(4)]), "trie-terms")
    w = Window.partitionBy("c", "part").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    local = terms.select("c", "i", "part", "digest", "len", "x",
                         *[_mod(F.sum(f"t{k}").over(w), k).alias(f"l{k}") for k in range(4)])
    totals = terms.groupBy("c", "part").agg(*[_mod(F.sum(f"t{k}"), k).alias(f"b{k}")
                                              for k in range(4)])
    before = _before(totals, "c", "part", [f"b{k}" for k in range(4)])
    return local.join(before, ["c", "part"]).select(
        "c", "i", "digest", "len", "x",
        *[_mod(F.col(f"l{k}") + F.col(f"b{k}"), k).alias(_SUMS[k]) for k in range(4)])


# ---- rebuilt prefixes --------------------------------------------------------------

def prefixes(sums: DataFrame, conversations: DataFrame, bases: tuple[int, ...],
             hot_rows: int) -> tuple[DataFrame, DataFrame]:
    """``c, d, k1, k2, p1, p2, digest, len`` per rebuilt prefix (depth 0
    included): its fingerprint, its parent's, and its last turn; and ``c, d,
    k1, k2`` of the whole rebuilt conversations."""
    c = F.col("c")
    convs = (conversations.where("conv_id is not null")
             .select(F.col("conv_id").cast("bigint").alias("c")).groupBy("c")
             .agg(F.count(F.lit(1)).alias("n"))
             .select("c", "n", (c - c % BASE_SIZE).alias("base"),
                     (F.crc32(c.cast("string").cast("binary")) % HEAD_MOD).cast("bigint").alias("h")))
    convs = materialize(convs, "trie-conversations")
    # a base's first turns serve at most 2 * BASE_SIZE conversations
    heads = materialize(sums.where((c % BASE_SIZE == 0) & (F.col("i") < HEAD_MOD)), "trie-heads")
    base_n = convs.where(c % BASE_SIZE == 0).select(c.alias("base"), F.col("n").alias("n_base"))
    convs = (convs.join(base_n, "base", "left")
             .withColumn("k", F.least("h", F.coalesce("n_base", F.lit(0)))))
    whole = heads.select(c.alias("base"), F.col("i").alias("k"), *[
        F.col(s).alias(f"h{k}") for k, s in enumerate(_SUMS)])
    cut = sums.where(F.col("i") < HEAD_MOD).select("c", F.col("i").alias("h"), *[
        F.col(s).alias(f"o{k}") for k, s in enumerate(_SUMS)])
    zero = F.lit(0).cast("bigint")
    convs = materialize(convs.join(whole, ["base", "k"], "left").join(cut, ["c", "h"], "left").select(
        "c", "n", "base", "h", "k",
        *[F.coalesce(F.col(f"{a}{k}"), zero).alias(f"{a}{k}") for a in "ho" for k in range(4)]),
        "trie-plans")
    own_len = F.greatest(F.col("n") - F.col("h"), zero)

    head = convs.select("c", "base", "k").join(
        heads.withColumnRenamed("c", "base"), "base").where(F.col("i") <= F.col("k"))
    head = head.select("c", F.col("i").alias("d"), "digest", "len", "x", *_SUMS)
    plan = convs.select(c.alias("pc"), "h", "k", *[f"{a}{j}" for a in "ho" for j in range(4)])
    own = sliced_join(sums, plan, [("c", "pc")], "inner", hot_rows).where(F.col("i") > F.col("h"))
    # the own turns keep their place or move down, where the base is shorter than h
    back = [[pow(pow(b, -1, p), m, p) for m in range(HEAD_MOD)] for b, p in zip(bases, PRIMES)]
    shift = [F.element_at(F.array(*[F.lit(v).cast("bigint") for v in row]),
                          (F.col("h") - F.col("k") + 1).cast("int")) for row in back]
    own = own.select("c", (F.col("i") - F.col("h") + F.col("k")).alias("d"), "digest", "len", "x", *[
        _mod(F.col(f"h{j}") + shift[j] * _mod(F.col(_SUMS[j]) - F.col(f"o{j}"), j), j).alias(_SUMS[j])
        for j in range(4)])
    w = _power_udf(bases)("d")
    deep = head.unionByName(own).withColumn("w", w)
    parent = [_mod(F.col(_SUMS[j]) - _mod(F.col("x")[j] * F.col("w")[j], j), j) for j in range(4)]
    packed, up = _pack([F.col(s) for s in _SUMS]), _pack(parent)
    root = convs.select("c", zero.alias("d"), zero.alias("k1"), zero.alias("k2"),
                        F.lit(None).cast("bigint").alias("p1"), F.lit(None).cast("bigint").alias("p2"),
                        F.lit("").alias("digest"), zero.alias("len"))
    paths = materialize(root.unionByName(deep.select(
        "c", "d", packed[0].alias("k1"), packed[1].alias("k2"), up[0].alias("p1"),
        up[1].alias("p2"), "digest", "len")), "trie-paths")
    lengths = convs.select(c.alias("lc"), (F.col("k") + own_len).alias("ld"))
    ends = sliced_join(paths.select("c", "d", "k1", "k2"), lengths, [("c", "lc"), ("d", "ld")],
                       "inner", hot_rows).select("c", "d", "k1", "k2")
    return paths, ends


# ---- nodes ------------------------------------------------------------------------

NODE = ("d", "k1", "k2")


def grouped(paths: DataFrame) -> DataFrame:
    """A row per node; ``mixed`` marks one whose members end in two turns."""
    half = [F.conv(F.substring("digest", a, 15), 16, 10).cast("bigint") for a in (1, 16)]
    rows = paths.select("c", *NODE, "p1", "p2", "len", half[0].alias("g1"), half[1].alias("g2"))
    return rows.groupBy(*NODE).agg(
        F.min("c").alias("rep"), F.count(F.lit(1)).alias("n"), F.min("p1").alias("p1"),
        F.min("p2").alias("p2"), F.max("len").alias("len"),
        ((F.min("g1") != F.max("g1")) | (F.min("g2") != F.max("g2"))
         | (F.min("len") != F.max("len"))).alias("mixed"))


def _chain_sums(nodes: DataFrame, block: int) -> DataFrame:
    """``rep, d, leaves_down, saved_down``: sums over the chain from ``d``
    down, block by block (depths of a chain are dense, so blocks are bounded)."""
    rows = nodes.select("rep", "d", "leaf", "saved", F.expr(f"-(d DIV {block})").alias("b"))
    w = (Window.partitionBy("rep", "b").orderBy(F.col("d").desc())
         .rowsBetween(Window.unboundedPreceding, 0))
    local = rows.select("rep", "d", "b", F.sum("leaf").over(w).alias("l"),
                        F.sum("saved").over(w).alias("s"))
    deeper = _before(rows.groupBy("rep", "b").agg(F.sum("leaf").alias("ll"),
                                                  F.sum("saved").alias("ss")), "rep", "b",
                     ["ll", "ss"])
    return local.join(deeper, ["rep", "b"]).select(
        "rep", "d", (F.col("l") + F.col("ll")).alias("leaves_down"),
        (F.col("s") + F.col("ss")).alias("saved_down"))


def trie(conversations: DataFrame, hot_rows: int = HOT_ROWS, chain_block: int = CHAIN_BLOCK,
         bases: Callable[[int], tuple[int, ...]] = draw) -> DataFrame:
    """One row per node of the trie; see the module's text."""
    for attempt in range(TRIES):
        drawn = bases(attempt)
        sums = materialize(running(numbered(turns(conversations, attempt)), drawn), "trie-sums")
        paths, ends = prefixes(sums, conversations, drawn, hot_rows)
        nodes = materialize(grouped(paths), "trie-groups")
        if not nodes.where("mixed").head(1) and not doubtful_turns(conversations, attempt):
            break
    else:
        raise RuntimeError(f"fingerprints of different prefixes met {TRIES} times")

    children = nodes.where("d > 0").groupBy((F.col("d") - 1).alias("d"), F.col("p1").alias("k1"),
                                            F.col("p2").alias("k2")).agg(
        F.count(F.lit(1)).alias("n_children"))
    nodes = nodes.join(children, list(NODE), "left").withColumn(
        "n_children", F.coalesce("n_children", F.lit(0)))
    nodes = materialize(nodes.withColumn("leaf", (F.col("n_children") == 0).cast("bigint"))
                        .withColumn("saved", (F.col("n") - 1) * F.col("len")), "trie-nodes")
    down = _chain_sums(nodes, chain_block)
    chains = nodes.groupBy("rep").agg(F.min("d").alias("top"), F.sum("leaf").alias("leaves"),
                                      F.sum("saved").alias("gain"))
    # a conversation's chain counts for the nodes above its top
    above = sliced_join(paths.select("c", *NODE), chains, [("c", "rep")], "inner", hot_rows).where(
        F.col("d") < F.col("top"))
    side = above.groupBy(*NODE).agg(F.sum("leaves").alias("side_leaves"),
                                    F.sum("gain").alias("side_saved"))
    # the parent of a chain's top is on another chain; below, it is the chain's own
    tops = nodes.join(chains.select(F.col("rep"), F.col("top").alias("d")), ["rep", "d"]).where(
        "d > 0").select(*NODE, (F.col("d") - 1).alias("pd"), "p1", "p2")
    parents = nodes.select(F.col("d").alias("ud"), F.col("k1").alias("u1"), F.col("k2").alias("u2"),
                           F.col("rep").alias("up"))
    tops = sliced_join(tops, parents, [("pd", "ud"), ("p1", "u1"), ("p2", "u2")], "inner",
                       hot_rows).select(*NODE, "up")
    listed = joined_chunks(ends, list(NODE), "c", sep=",",
                           materialize_with=lambda df: materialize(df, "trie-ends"))
    digests = streamed_sha256(listed, list(NODE), ["chunk"], "text", ",")
    key = list(NODE)
    out = (nodes.join(down, ["rep", "d"]).join(side, key, "left").join(tops, key, "left")
           .join(digests, key, "left"))
    zero = F.lit(0).cast("bigint")
    return out.select(
        F.col("rep").alias("conv_id"), F.col("d").alias("depth"),
        F.when(F.col("d") > 0, F.coalesce("up", "rep")).alias("parent_conv_id"),
        F.col("n").alias("n_convs"), "n_children",
        (F.col("leaves_down") + F.coalesce("side_leaves", zero)).alias("n_leaves"),
        (F.col("saved_down") + F.coalesce("side_saved", zero)).alias("saved_tokens"),
        F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))


def trie_sql(conversations: str = "conversations") -> str:
    """DuckDB SQL of :func:`trie`, from the definition alone: rebuilt texts as
    lists, every prefix as a list, a node per distinct list."""
    bit_steps = "[0, 0, 0, 0, 0, 0, 0, 0]"
    crc = f"""xor(list_reduce(list_prepend(4294967295::BIGINT,
        list_transform(string_split(CAST(c AS VARCHAR), ''), lambda ch: CAST(ascii(ch) AS BIGINT))),
        lambda a, b: list_reduce(list_prepend(xor(a, b), {bit_steps}::BIGINT[]),
          lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)),
        4294967295::BIGINT)"""
    return f"""
WITH turn AS (
  SELECT conv_id AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM {conversations} WHERE conv_id IS NOT NULL
), conv AS (
  SELECT c, list(struct_pack(r := role, t := text)
                 ORDER BY turn NULLS FIRST, role, sha256(text)) AS seq
  FROM turn GROUP BY c
), planned AS (SELECT *, {crc} % {HEAD_MOD} AS h FROM conv
), rebuilt AS (
  SELECT p.c, list_concat(CASE WHEN b.c IS NULL THEN [] ELSE b.seq[:p.h] END,
                          p.seq[p.h + 1:]) AS seq
  FROM planned p LEFT JOIN conv b ON b.c = p.c - p.c % {BASE_SIZE}
), prefix AS (
  SELECT c, unnest(range(len(seq) + 1)) AS d, seq FROM rebuilt
), member AS (SELECT c, d, seq[:d] AS path, len(seq) = d AS ends FROM prefix
), node AS (
  SELECT path, d, min(c) AS rep, count(*) AS n,
         sha256(coalesce(string_agg(CASE WHEN ends THEN CAST(c AS VARCHAR) END, ',' ORDER BY c), ''))
           AS ends_sha256
  FROM member GROUP BY path, d
), family AS (
  SELECT n.*, p.rep AS parent, CASE WHEN n.d > 0 THEN (n.n - 1) * length(n.path[n.d].t) ELSE 0 END
         AS saved, (SELECT count(*) FROM node k WHERE k.d = n.d + 1 AND k.path[:n.d] = n.path) AS kids
  FROM node n LEFT JOIN node p ON p.d = n.d - 1 AND p.path = n.path[:n.d - 1]
), below AS (
  SELECT a.rep, a.d, sum(f.saved) AS saved, sum(CASE WHEN f.kids = 0 THEN 1 ELSE 0 END) AS leaves
  FROM (SELECT path, d, saved, kids, unnest(range(d + 1)) AS up FROM family) f
  JOIN node a ON a.d = f.up AND a.path = f.path[:f.up]
  GROUP BY a.rep, a.d
)
SELECT f.rep AS conv_id, CAST(f.d AS BIGINT) AS depth, f.parent AS parent_conv_id,
       f.n AS n_convs, f.kids AS n_children, CAST(b.leaves AS BIGINT) AS n_leaves,
       CAST(b.saved AS BIGINT) AS saved_tokens, f.ends_sha256
FROM family f JOIN below b USING (rep, d)
"""
