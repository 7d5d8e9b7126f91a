"""N-gram Jaccard self-join by a token-group matrix.

A document's set is its distinct 4-word shingles (A-Z lower-cased, words split
at space and U+0009 to U+000D), each as a 64-bit hash; with fewer words, the
whole sequence as one.  Two documents link when ``100 * |x & y| >= 85 * |x | y|``.

*Classes.*  Equal sets are one class; only classes are compared.

*Tokens looked at.*  A link needs ``ceil(0.85 n)`` common tokens of either set,
so under any one order of all tokens two linked sets share one of their first
``n - ceil(0.85 n) + 1``.  The order takes frequent tokens last: tokens that
repeat within blocks of ``BLOCK_TOKENS`` tokens are counted over all documents,
in a table of 2 to the ``WEIGHT_BITS`` ranges of hashes whose size does not
depend on the data, and a token's weight is the logarithm of its range's count.
The order decides what is compared, never what links.

*Positions.*  A set of ``n`` with ``i`` tokens before its first common one has
at most ``n - i`` common tokens, so it links only to sets of up to ``partner_cap``
tokens.  Of two linked sets the smaller one then has a cap of its own size or
more: it is *early* in that token.  Two late ones never meet, and a token
without an early class is dropped.

*Groups.*  Of the classes that share a token, the one in which it stands
earliest for its size is the token's leader: in a family of near copies the one
with the fewest tokens of its own.  Each class is compared with the leader it
shares most tokens with;
what links is a component, and components, cut in pieces of ``GROUP`` classes,
are the groups of similar documents.

*Matrix.*  A token of two components or more gives its rows (token, group).  A
class queries the groups it shares a row with, those of its own component
aside, and of two components the smaller one asks.

*Bound, then open.*  A set's histogram counts its tokens per range of hashes,
two to four to a range: the sum of the lesser counts bounds the common tokens of
two sets, and the greatest counts of a group's members bound those with its
union.  Questions that cannot reach the threshold end here, on half a byte per
token.  For the others the whole sets are made, and a group is brought together
with its queries and the union of its members' tokens.  A query with fewer than
``ceil(0.85 n)`` tokens in the union links with no member.  Only groups that
pass are opened, and members compared one by one; all members of a group are of
one component, so the first link is enough.

So no pair within a group of copies is ever made, and what is compared between
groups is bounded by shared rare tokens.  Groups with many queries are dealt to
slices of ``QUERIES``; joins on hot keys are sliced (``operators.skew``).

Defined results.  Null or empty text, or no word: ``n_shingles`` 0, linked with
nothing, not even its like.  Null id: the row takes part; the component's id is
the smallest id that is not null, or null if there is none.  Repeated rows: one
result row each.  Ties: none matter.  A very long text is one set, never cut.
Empty table: no rows.  Extra columns, whatever their names, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saletrace.operators.skew import HOT_ROWS, sliced_join

from .common import id_and_text, materialize
from .components import components

SHINGLE, PERCENT = 4, 85
BLOCK_TOKENS, WEIGHT_BITS, WEIGHT_BLOCK = 1 << 22, 24, 1 << 12
GROUP, QUERIES = 64, 256
#: bits of the map of ids whose sets are wanted (8 MB); more ids only make it
#: less selective
MAP_BITS = 26
_SLICE_BYTES = 1 << 20
_PLACES = 1 << 31
_MUL = np.uint64(0x9E3779B97F4A7C15)


def needed(n):
    """The least common tokens of a set of ``n`` with anything it links to."""
    return (PERCENT * n + 99) // 100


def partner_cap(n, i):
    """The most tokens of a set that links to one of ``n`` tokens, if their
    first common token has ``i`` others before it in the latter (columns)."""
    return F.floor(((100 + PERCENT) * (n - i) - PERCENT * n) / PERCENT)


# ---- token sets ------------------------------------------------------------------

def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def token_sets(text: pa.Array) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    words = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(text, "")))
    flat, ends = words.flatten(), words.offsets.to_numpy().astype(np.int64)
    full = pc.not_equal(flat, "")
    before = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False))])
    ends = before[ends - ends[0]]
    coded = pc.dictionary_encode(flat.filter(full))
    of_word = np.array([xxhash.xxh64_intdigest(w, 7) for w in coded.dictionary.to_pylist()],
                       np.uint64)
    h = of_word[coded.indices.to_numpy()] if len(of_word) else np.zeros(0, np.uint64)
    m = len(h) - SHINGLE + 1
    grams = np.zeros(max(m, 0), np.uint64)
    for i in range(SHINGLE):
        grams = grams * _MUL + h[i:i + max(m, 0)]
    grams = _mixed(grams)
    out = []
    for a, b in zip(ends[:-1].tolist(), ends[1:].tolist()):
        if b - a >= SHINGLE:
            out.append(np.unique(grams[a:b - SHINGLE + 1]))
        elif b > a:
            short = np.array([b - a], np.uint64)
            for x in h[a:b]:
                short = short * _MUL + x
            out.append(_mixed(short ^ np.uint64(0x5A5A5A5A)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _slices(text: pa.Array) -> Iterator[pa.Array]:
    """Runs of texts of about ``_SLICE_BYTES`` together, a longer text alone."""
    sizes = pc.fill_null(pc.binary_length(text), 0).to_numpy(zero_copy_only=False)
    at, held = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if held and held + size > _SLICE_BYTES:
            yield text.slice(at, i - at)
            at, held = i, 0
        held += size
    if at < len(text):
        yield text.slice(at)


def _sets(text: pa.Array) -> Iterator[np.ndarray]:
    with np.errstate(over="ignore"):
        for part in _slices(text):
            yield from token_sets(part)


def set_digest(tokens: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(tokens.tobytes())


# ---- frequent tokens ---------------------------------------------------------------

def _repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tokens in two sets or more of a block, with how many."""
    # one buffer for all blocks: small arrays held by the thousand would leave
    # the worker's memory in pieces, and joining them would double it
    block, size, seen = np.empty(BLOCK_TOKENS + BLOCK_TOKENS // 16, np.uint64), 0, set()

    def counted() -> pa.RecordBatch:
        held = block[:size]
        held.sort()
        # all but the first of each run; only these few are copied
        token, n = np.unique(held[1:][held[1:] == held[:-1]], return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(token.view(np.int64)),
                                           pa.array(n.astype(np.int64) + 1)], ["token", "n"])
    for batch in batches:
        for tokens in _sets(batch.column(0)):
            digest = set_digest(tokens)
            if len(tokens) and digest not in seen:
                seen.add(digest)
                end = size + len(tokens)
                if end > len(block):  # a block ends after the set that fills it, however long
                    block = np.concatenate([block[:size], np.empty(len(tokens), np.uint64)])
                block[size:end] = tokens
                size = end
            if size > BLOCK_TOKENS:
                yield counted()
                size, seen = 0, set()
    if size:
        yield counted()


def token_weights(rows: DataFrame) -> np.ndarray:
    """A byte per range of hashes (the top ``WEIGHT_BITS`` bits): the rounded
    logarithm of how often its repeated tokens were counted, 0 for none.  The
    counts cover all documents, and are packed on the executors."""
    shift, size = 64 - WEIGHT_BITS, WEIGHT_BLOCK

    def pack(table: pa.Table) -> pa.Table:
        out = np.zeros(size, np.uint8)
        at = table["range"].to_numpy().astype(np.int64) % size
        out[at] = np.round(np.log2(table["n"].to_numpy())).astype(np.uint8)
        return pa.table({"block": table["block"][:1], "packed": pa.array([out.tobytes()])})

    counts = (rows.select("text").mapInArrow(_repeats, "token bigint, n bigint")
              .groupBy(F.shiftrightunsigned("token", shift).alias("range"))
              .agg(F.sum("n").alias("n")).withColumn("block", F.expr(f"range DIV {size}")))
    weights = np.zeros(1 << WEIGHT_BITS, np.uint8)
    for r in counts.groupBy("block").applyInArrow(pack, "block bigint, packed binary").collect():
        weights[r.block * size:(r.block + 1) * size] = np.frombuffer(r.packed, np.uint8)
    return weights


# ---- classes and their first tokens --------------------------------------------------

def first_tokens(tokens: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The first ``n - ceil(0.85 n) + 1`` tokens, rare ones first."""
    n = len(tokens)
    if not n:
        return tokens
    w = weights[(tokens >> np.uint64(65 - len(weights).bit_length())).astype(np.int64)]
    return tokens[np.argsort(w, kind="stable")[:n - needed(n) + 1]]


def histogram(tokens: np.ndarray) -> bytes:
    """Counts per range of hashes, a byte each; ranges are the top bits, a
    power of two of them.  Empty if a count does not fit (no bound then)."""
    bits = max(0, len(tokens).bit_length() - 2)
    counts = (np.bincount((tokens >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
              if bits else np.array([len(tokens)]))
    return b"" if counts.max(initial=0) > 255 else counts.astype(np.uint8).tobytes()


def _folded(h: np.ndarray, size: int) -> np.ndarray:
    return h.reshape(size, -1).sum(1) if len(h) > size else h


def most_common(a: np.ndarray, b: np.ndarray, least: int) -> int:
    """An upper bound of the common tokens, from two histograms (``least`` is
    returned where one is missing)."""
    if not len(a) or not len(b):
        return least
    size = min(len(a), len(b))
    return int(np.minimum(_folded(a, size), _folded(b, size)).sum())


_PRINT = T.StructType([T.StructField("d1", T.LongType()), T.StructField("d2", T.LongType()),
                       T.StructField("n", T.LongType()), T.StructField("hist", T.BinaryType()),
                       T.StructField("first", T.ArrayType(T.LongType()))])


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum([len(a) for a in arrays])])
    flat = np.concatenate(arrays) if arrays else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat.view(np.int64)))


def _print_udf(weights):
    @F.arrow_udf(_PRINT)
    def prints(text: pa.Array) -> pa.Array:
        digests, sizes, firsts, hists = [], [], [], []
        for tokens in _sets(text):
            digests.append(set_digest(tokens))
            hists.append(histogram(tokens))
            sizes.append(len(tokens))
            firsts.append(first_tokens(tokens, weights.value))
        d = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
        return pa.StructArray.from_arrays(
            [pa.array(d[:, 0]), pa.array(d[:, 1]), pa.array(sizes, pa.int64()),
             pa.array(hists, pa.binary()), _lists(firsts)], names=["d1", "d2", "n", "hist", "first"])
    return prints


# ---- whole sets of wanted ids ----------------------------------------------------------

def _id_map(spark: SparkSession, ids: DataFrame):
    """A broadcast bit map of hashed ids, of a fixed size."""
    bit = F.xxhash64("id").bitwiseAND((1 << MAP_BITS) - 1)
    words = ids.select(F.shiftright(bit, 6).alias("w"),
                       F.expr(f"shiftleft(1L, cast(xxhash64(id) & {(1 << MAP_BITS) - 1} & 63 as int))")
                       .alias("b")).groupBy("w").agg(F.bit_or("b").alias("b")).toPandas()
    bits = np.zeros(1 << (MAP_BITS - 6), np.uint64)
    bits[words["w"].to_numpy(np.int64)] = words["b"].to_numpy(np.int64).view(np.uint64)
    return spark.sparkContext.broadcast(bits)


_WHOLE = T.StructType([T.StructField("d1", T.LongType()), T.StructField("d2", T.LongType()),
                       T.StructField("tokens", T.ArrayType(T.LongType()))])


def whole_sets(rows: DataFrame, active: DataFrame) -> DataFrame:
    """``cls, tokens`` of the classes ``active`` (``cls, id, d1, d2``), from the
    texts of the ids that stand for them."""
    wanted = _id_map(rows.sparkSession, active.select("id"))

    @F.arrow_udf(_WHOLE)
    def sets(h: pa.Array, text: pa.Array) -> pa.Array:
        at = h.to_numpy(zero_copy_only=False).astype(np.int64) & ((1 << MAP_BITS) - 1)
        word = wanted.value[at >> 6] >> (at & 63).astype(np.uint64)
        asked = (word & np.uint64(1)).astype(bool)
        got = list(_sets(text.filter(pa.array(asked))))
        place = np.where(asked, np.cumsum(asked) - 1, len(got))
        d = np.frombuffer(b"".join(map(set_digest, got)), np.int64).reshape(-1, 2)
        made = pa.StructArray.from_arrays([pa.array(d[:, 0]), pa.array(d[:, 1]), _lists(got)],
                                          names=["d1", "d2", "tokens"])
        return made.take(pa.array(place, mask=~asked))
    some = rows.select("id", sets(F.xxhash64("id"), "text").alias("s")).where("s is not null")
    some = some.select(F.col("id").alias("sid"), "s.*")
    named = active.select("cls", "id", F.col("d1").alias("c1"), F.col("d2").alias("c2"))
    same = (F.col("d1") == F.col("c1")) & (F.col("d2") == F.col("c2")) & F.col("id").eqNullSafe(
        F.col("sid"))
    return materialize(some.join(named, same).select("cls", "tokens").dropDuplicates(["cls"]),
                       "whole-sets")


# ---- bound and open ----------------------------------------------------------------

_GROUP_KEY = ("gc", "gs", "slice")


def _bring_together(asked: DataFrame, members: DataFrame, payload: DataFrame,
                    columns: tuple[str, ...]) -> DataFrame:
    """Members and askers of each group in one partition, members (``asks`` 0)
    first, with the ``columns`` of ``payload`` by class.  A group asked by over
    ``QUERIES`` classes is dealt to slices, its members repeated in each."""
    load = asked.groupBy("gc", "gs").agg(F.ceil(F.count(F.lit(1)) / QUERIES).cast("int").alias("k"))
    load = materialize(load, "group-loads")
    inside = members.join(load, ["gc", "gs"]).select(
        "gc", "gs", F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("slice"),
        F.lit(0).alias("asks"), "cls")
    # a group of one slice needs no lookup: only crowded ones are joined
    crowded = load.where("k > 1").select(F.col("gc").alias("lc"), F.col("gs").alias("ls"), "k")
    asking = sliced_join(asked, crowded, [("gc", "lc"), ("gs", "ls")], "left", HOT_ROWS).select(
        "gc", "gs", F.pmod(F.xxhash64("q"), F.coalesce("k", F.lit(1))).cast("int").alias("slice"),
        F.lit(1).alias("asks"), F.col("q").alias("cls"))
    rows = inside.unionByName(asking).join(payload, "cls").select(*_GROUP_KEY, "asks", "cls", *columns)
    return rows.repartition(*_GROUP_KEY).sortWithinPartitions(*_GROUP_KEY, "asks")


def _ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The questions that histograms leave open."""
    now, members, whole = None, [], None
    for batch in batches:
        keys = list(zip(*[batch.column(i).to_pylist() for i in range(3)]))
        asks, cls, sizes = (batch.column(i).to_pylist() for i in (3, 4, 5))
        left: list[tuple[int, int, int]] = []
        for i, key in enumerate(keys):
            hist = np.frombuffer(batch.column(6)[i].as_py(), np.uint8).astype(np.int64)
            if key != now:
                now, members, whole = key, [], None
            if not asks[i]:
                members.append((sizes[i], hist))
                continue
            if whole is None:
                least = min(len(h) for _, h in members)
                whole = (np.max([_folded(h, least) for _, h in members], axis=0) if least
                         else np.zeros(0, np.int64))
            n = sizes[i]
            if most_common(whole, hist, n) < needed(n):
                continue
            for m, theirs in members:
                both = -(-PERCENT * (n + m) // (100 + PERCENT))
                if min(n, m) >= both and most_common(theirs, hist, both) >= both:
                    left.append((key[0], key[1], cls[i]))
                    break
        if left:
            yield pa.RecordBatch.from_arrays([pa.array([f[j] for f in left], pa.int64())
                                              for j in range(3)], names=["gc", "gs", "q"])


def open_questions(asked: DataFrame, members: DataFrame, hists: DataFrame) -> DataFrame:
    """The rows ``gc, gs, q`` of ``asked`` that may hold a link, by the bound."""
    rows = _bring_together(asked, members, hists, ("n", "hist"))
    return materialize(rows.mapInArrow(_ask, "gc bigint, gs bigint, q bigint"), "open-questions")


def _open(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by group and slice, members (``asks`` 0) first."""
    now, members, union = None, [], None
    for batch in batches:
        keys = list(zip(*[batch.column(i).to_pylist() for i in range(3)]))
        asks, cls = batch.column(3).to_pylist(), batch.column(4).to_pylist()
        ends = batch.column(5).offsets.to_numpy()
        flat = batch.column(5).values.to_numpy().view(np.uint64)
        found: list[tuple[int, int]] = []
        for i, key in enumerate(keys):
            tokens = flat[ends[i]:ends[i + 1]]
            if key != now:
                now, members, union = key, [], None
            if not asks[i]:
                members.append((cls[i], tokens.copy()))
                continue
            if union is None:
                union = (np.unique(np.concatenate([t for _, t in members])) if len(members) > 1
                         else members[0][1])
            least = needed(len(tokens))
            if len(members) > 1 and _common(union, tokens) < least:
                continue
            for other, theirs in members:
                both = min(len(tokens), len(theirs))
                if both < least or both < needed(len(theirs)):
                    continue
                both = _common(theirs, tokens)
                if 100 * both >= PERCENT * (len(tokens) + len(theirs) - both):
                    found.append((cls[i], other))
                    break
        if found:
            yield pa.RecordBatch.from_arrays([pa.array([f[j] for f in found], pa.int64())
                                              for j in range(2)], names=["u", "v"])


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """How many of ``b`` are in ``a``; both sorted and distinct."""
    at = np.minimum(np.searchsorted(a, b), len(a) - 1)
    return int((a[at] == b).sum())


def open_groups(asked: DataFrame, members: DataFrame, sets: DataFrame) -> DataFrame:
    """``asked``: ``gc, gs, q``, a class and a group it asks; ``members``: ``gc,
    gs, cls``.  One verified link ``u, v`` at most per row of ``asked``."""
    rows = _bring_together(asked, members, sets, ("tokens",))
    return rows.mapInArrow(_open, "u bigint, v bigint")


def _concerned(asked: DataFrame, members: DataFrame) -> DataFrame:
    """``cls`` of the askers and of the members they ask."""
    groups = asked.select("gc", "gs").distinct()
    return (asked.select(F.col("q").alias("cls"))
            .union(members.join(groups, ["gc", "gs"]).select("cls")).distinct())


# ---- the join -----------------------------------------------------------------------

def _rooted(shared: DataFrame, links: DataFrame) -> DataFrame:
    """``cls, comp`` of every class in ``shared``."""
    roots = components(links)
    return (shared.join(roots, F.col("cls") == F.col("node"), "left")
            .select("cls", F.coalesce("root", "cls").alias("comp")))


def linked_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     hot_rows: int = HOT_ROWS) -> DataFrame:
    """Per row of ``docs``: its id, ``n_shingles`` and ``component_id``."""
    spark = docs.sparkSession
    rows = id_and_text(docs, id_col, text_col)
    weights = spark.sparkContext.broadcast(token_weights(rows))
    prints = rows.select("id", _print_udf(weights)("text").alias("p")).select("id", "p.*")
    prints = materialize(prints.withColumn("rid", F.monotonically_increasing_id()), "set-prints")

    # the row that stands for a class: the smallest id, nulls last
    stands = F.min(F.struct(F.col("id").isNull(), "id", "rid")).alias("s")
    classes = (prints.where("n > 0").groupBy("d1", "d2").agg(stands, F.min("id").alias("least"))
               .select(F.col("s.rid").alias("cls"), F.col("s.id").alias("id"), "d1", "d2", "least"))
    classes = materialize(classes, "set-classes")
    tokens = (prints.select("rid", "n", "first").join(classes.select("cls"), F.col("rid") == F.col("cls"))
              .select("cls", "n", F.posexplode("first").alias("i", "token"))
              # one number for both, as all tokens of all first lists are shuffled
              .select("cls", "token", (F.col("n") * _PLACES + F.col("i")).alias("place"))
              .repartition("token"))
    n, i = F.shiftright("place", 31), F.col("place").bitwiseAND(_PLACES - 1)
    cap = partner_cap(n, i)
    # earliest for its size; ties go to the same class in every token
    earliest = F.floor(i * 1000 / n) * (1 << 40) + F.xxhash64("cls").bitwiseAND((1 << 40) - 1)
    leaders = (tokens.groupBy("token")
               .agg(F.count(F.lit(1)).alias("m"), F.max(cap >= n).alias("met"),
                    F.min_by("cls", earliest).alias("lead"))
               .where("m > 1 and met").select("token", "lead"))
    shared = materialize(tokens.join(leaders, "token"), "shared-tokens")
    ids = materialize(shared.select("cls").distinct(), "active-classes")
    hists = prints.select(F.col("rid").alias("cls"), "n", "hist")

    # each class and the leader it shares most tokens with
    votes = shared.where("cls != lead").groupBy("cls", "lead").agg(F.count(F.lit(1)).alias("votes"))
    best = votes.groupBy("cls").agg(F.max(F.struct("votes", (-F.col("lead")).alias("g"))).alias("b"))
    zero = F.lit(0).cast("bigint")
    led = materialize(best.select((-F.col("b.g")).alias("gc"), zero.alias("gs"),
                                  F.col("cls").alias("q")), "led-classes")
    leads = led.select("gc", "gs", F.col("gc").alias("cls")).distinct()
    led = open_questions(led, leads, hists)
    named = classes.select("cls", "id", "d1", "d2")
    sets = whole_sets(rows, named.join(_concerned(led, leads), "cls"))
    comp = materialize(_rooted(ids, open_groups(led, leads, sets)), "first-components")

    # the matrix: groups of similar classes, by shared tokens
    size = comp.groupBy("comp").agg(F.count(F.lit(1)).alias("size"))
    placed = (sliced_join(comp, size.withColumnRenamed("comp", "sc"), [("comp", "sc")], "inner",
                          hot_rows).join(hists.select("cls", "n"), "cls")
              .select("cls", "comp", "size", "n",
                      F.pmod(F.xxhash64("cls"), F.ceil(F.col("size") / GROUP)).alias("gs")))
    placed = materialize(placed, "placed-classes")
    placements = shared.select("token", "cls", cap.alias("cap"), (cap >= n).alias("early"))
    cells = materialize(placements.join(placed, "cls"), "token-cells")
    mixed = cells.groupBy("token").agg(F.min("comp").alias("a"), F.max("comp").alias("b")).where(
        "a != b").select("token")
    cells = materialize(cells.join(mixed, "token"), "mixed-cells")
    matrix = cells.groupBy(F.col("token").alias("t"), F.col("comp").alias("gc"), "gs").agg(
        F.max("size").alias("gsize"), F.min("n").alias("lo"), F.max("n").alias("hi"),
        F.max("cap").alias("gcap"), F.max("early").alias("gearly"))
    smaller = F.struct("size", "comp") < F.struct(F.col("gsize"), F.col("gc"))
    fits = ((100 * F.col("hi") >= PERCENT * F.col("n")) & (PERCENT * F.col("lo") <= 100 * F.col("n"))
            & (F.col("lo") <= F.col("cap")) & (F.col("n") <= F.col("gcap")))

    def asking(some: DataFrame, rows: DataFrame) -> DataFrame:
        met = sliced_join(some.drop("gs", "early"), rows.drop("gearly"), [("token", "t")], "inner",
                          hot_rows)
        return met.where(smaller & fits).select("gc", "gs", F.col("cls").alias("q"))

    # late askers meet groups with an early member only
    asked = asking(cells.where("early"), matrix).union(
        asking(cells.where("not early"), matrix.where("gearly")))
    asked = materialize(asked.distinct(), "asked-groups")
    members = placed.select(F.col("comp").alias("gc"), "gs", "cls")
    asked = open_questions(asked, members, hists)
    more = _concerned(asked, members).join(sets.select("cls"), "cls", "left_anti")
    sets = sets.unionByName(whole_sets(rows, named.join(more, "cls")))
    links = open_groups(asked, members, sets)
    of = comp.select(F.col("cls").alias("o"), F.col("comp").alias("oc"))
    links = (links.join(of, F.col("u") == F.col("o")).select(F.col("oc").alias("u"), "v")
             .join(of, F.col("v") == F.col("o")).select("u", F.col("oc").alias("v")))
    joined = components(materialize(links.distinct(), "group-links"))
    final = (comp.join(joined, F.col("comp") == F.col("node"), "left")
             .select(F.col("cls").alias("fc"), F.coalesce("root", "comp").alias("root")))

    rooted = materialize(classes.join(final, F.col("cls") == F.col("fc"), "left").select(
        "d1", "d2", "least", F.coalesce("root", "cls").alias("root")), "rooted-classes")
    least = rooted.groupBy(F.col("root").alias("r")).agg(F.min("least").alias("component_id"))
    whole = sliced_join(rooted.select("d1", "d2", "root"), least, [("root", "r")], "inner", hot_rows)
    whole = materialize(whole.select(F.col("d1").alias("e1"), F.col("d2").alias("e2"),
                                     "component_id"), "named-classes")
    facts = prints.select("id", "n", "d1", "d2")
    full = sliced_join(facts.where("n > 0"), whole, [("d1", "e1"), ("d2", "e2")], "inner", hot_rows)
    return (full.select("id", "n", "component_id")
            .union(facts.where("n = 0").select("id", "n", F.col("id").alias("component_id")))
            .select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id"))


def links_sql(documents: str = "documents") -> str:
    """DuckDB SQL of :func:`linked_documents`, by counting the common shingles
    of all pairs that have one, and following the links."""
    return rf"""
WITH RECURSIVE word AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^ \t\n\r\v\f]+') AS w
  FROM {documents}
), gram AS (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) >= {SHINGLE} THEN
    list_transform(range(1, len(w) - {SHINGLE} + 2), lambda i: array_to_string(w[i:i + {SHINGLE - 1}], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END)) AS g
  FROM word
), size AS (SELECT doc_id, count(*) AS n FROM gram GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o
  FROM gram a JOIN gram b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL
), link AS (
  SELECT x, y FROM common JOIN size s ON s.doc_id = x JOIN size t ON t.doc_id = y
  WHERE 100 * o >= {PERCENT} * (s.n + t.n - o)
), edge AS (SELECT x, y FROM link UNION ALL SELECT y, x FROM link
), reach AS (
  SELECT doc_id, doc_id AS r FROM size
  UNION
  SELECT e.y, reach.r FROM reach JOIN edge e ON e.x = reach.doc_id AND reach.r < e.y
), least AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, coalesce(l.component_id, d.doc_id) AS component_id
FROM {documents} d LEFT JOIN size s USING (doc_id) LEFT JOIN least l USING (doc_id)
"""
