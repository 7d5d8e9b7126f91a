"""Repair of conversation structure by a square-root checkpointed DP.

A conversation is well formed if its role initials read ``(s?(ua)+)?``.  The
automaton of that language has four states: nothing yet, after the system
turn, after a user turn, after an assistant turn; the first and last accept.
In any state at most one role can be put in by a rerole or an insert, so a
sequence of edit letters fixes the repaired conversation.

*Edits.*  K(eep) costs 0, R(erole) to user or assistant 3, D(elete) 4, I(nsert)
of an empty user or assistant turn 3, anywhere.  A blank or duplicate row must
be deleted; a truncated row that is not deleted costs 3 more.

*Method.*  The backward vector of a position holds, per state, the least cost
of finishing from there.  Vectors are stored only at every sqrt(n)-th row (the
checkpoints); the walk forward recomputes one block of them at a time and takes
at each step the ASCII-least edit that is tight (its cost and the next vector
make up the present one).  Different letters lead to different choices, each
of which fixes the next state, so that greedy walk spells the least string.  A
row is one small integer here (its initial and fault), so a conversation holds
sqrt(n) vectors and n bytes besides its rows.

*Work in Spark.*  Conversations are hashed to partitions and sorted there; a
task reads them one after another.  A conversation of over ``LONG_ROWS`` rows
goes another way: all its rows are range-partitioned and numbered, and cut in
blocks of ``BLOCK_ROWS``.  A block gives its (min, +) matrix of 4 x 4 costs;
the blocks' products from the end are the backward vectors at block ends, which
are the outer checkpoints; a second pass finds where each block's walk ends for
each state it may start in, and a third writes its edits.  The digest of its
text then runs over its lines in order, batch by batch.

Defined results.  Null role or text becomes one space, so such a text is blank
and such a role can only be reroled or deleted.  A role counts by its first
character; an empty role has none.  Rows of equal turn are taken by role, then
text.  Repeated rows are duplicates.  A null ``conv_id`` is a conversation of
its own.  No rows after damage: zeros, an empty audit, the empty digest.  An
empty table gives no rows.  Extra columns, whatever their names, are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from math import isqrt

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from saletrace.operators.ordering import with_position
from saletrace.operators.skew import sliced_join

from .common import materialize, slices
from .hashing import streamed_sha256

LONG_ROWS, BLOCK_ROWS = 100_000, 20_000
WHITE = " \t\n\r\x0b\x0c"
INF = 1 << 60
KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 3, 4, 3, 3
#: state after an insert or rerole, and the role it puts in
PUT = {0: (2, "user"), 1: (2, "user"), 2: (3, "assistant"), 3: (2, "user")}
#: state after keeping a turn of this initial
KEPT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
LEGAL = {"su", "ua", "au"}
END = (0, INSERT * 2, INSERT, 0)


# ---- the DP over symbols -------------------------------------------------------
# A symbol is 4 * initial + fault: initial s, u, a or another; fault none, blank,
# duplicate or truncated.
INITIALS = "sua"
OK, BLANK, DUPLICATE, TRUNCATED = range(4)


def symbol(role: str, fault: int) -> int:
    at = INITIALS.find(role[:1]) if role else -1
    return 4 * (at if at >= 0 else 3) + fault


def _moves(sym: int, state: int) -> list[tuple[str, int, int]]:
    """``(letter, cost, next state)`` of the edits that use up the row."""
    initial, fault = sym >> 2, sym & 3
    out = [("D", DELETE, state)]
    if fault in (BLANK, DUPLICATE):
        return out
    extra = CUT_OFF if fault == TRUNCATED else 0
    after = KEPT.get((state, INITIALS[initial])) if initial < 3 else None
    if after is not None:
        out.append(("K", KEEP + extra, after))
    out.append(("R", REROLE + extra, PUT[state][0]))
    return out


MOVES = [[_moves(sym, q) for q in range(4)] for sym in range(16)]
_NEXT = [PUT[q][0] for q in range(4)]


def _with_inserts(v: list[int]) -> tuple[int, ...]:
    """Any insert may come first; three in a row visit all that is reached."""
    for _ in range(3):
        v = [min(v[q], INSERT + v[_NEXT[q]]) for q in range(4)]
    return tuple(v)


def back(sym: int, after: tuple[int, ...]) -> tuple[int, ...]:
    """The vector before a row from the one after it."""
    return _with_inserts([min(c + after[q2] for _, c, q2 in MOVES[sym][q]) for q in range(4)])


def least_cost(symbols: bytes, end: tuple[int, ...] = END) -> tuple[int, ...]:
    for sym in reversed(symbols):
        end = back(sym, end)
    return end


def walk(symbols: bytes, state: int = 0, end: tuple[int, ...] = END, last: bool = True
         ) -> Iterator[tuple[str, int, int]]:
    """The ASCII-least tight edits: ``(letter, row, state before)`` in order.
    Unless ``last``, inserts after the last row are left to what follows."""
    n = len(symbols)
    step = max(1, isqrt(n))
    marks, v = {}, end
    for i in range(n - 1, -1, -1):  # only checkpoints are stored
        if (i + 1) % step == 0 or i == n - 1:
            marks[i + 1] = v
        v = back(symbols[i], v)
    q, i = state, 0
    while i < n:
        stop = min(n, (i // step + 1) * step)
        block = [marks[stop]]
        for j in range(stop - 1, i - 1, -1):  # one block of vectors again
            block.append(back(symbols[j], block[-1]))
        block.reverse()
        base = i
        while i < stop:
            now, after = block[i - base], block[i - base + 1]
            options = [("I", INSERT + now[_NEXT[q]], _NEXT[q])] + [
                (a, c + after[q2], q2) for a, c, q2 in MOVES[symbols[i]][q]]
            letter, _, q2 = min(x for x in options if x[1] == now[q])
            yield letter, i, q
            q, i = q2, i + (letter != "I")
    if last:
        tail = _with_inserts(list(end))
        while tail[q] and tail[q] == INSERT + tail[_NEXT[q]]:
            yield "I", n, q
            q = _NEXT[q]


def end_state(symbols: bytes, state: int, end: tuple[int, ...]) -> int:
    q = state
    for letter, i, before in walk(symbols, state, end, last=False):
        q = (PUT[before][0] if letter in "IR" else before if letter == "D"
             else KEPT[(before, INITIALS[symbols[i] >> 2])])
    return q


def repaired_line(letter: str, state: int, role: str, text: str) -> str | None:
    if letter == "D":
        return None
    if letter == "I":
        return f"{PUT[state][1]}:"
    return f"{role if letter == 'K' else PUT[state][1]}:{text}"


def fault_of(text: str, seen: bool) -> int:
    body = text.rstrip(WHITE)
    if not body:
        return BLANK
    return DUPLICATE if seen else OK if body[-1] in ".!?" else TRUNCATED


# ---- damage --------------------------------------------------------------------

def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, copies`` after the contract's damage; a
    dropped row stays as a mark with ``copies`` 0."""
    conv, turn = F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint")
    kind = F.crc32(F.concat(F.coalesce(conv.cast("string"), F.lit(" ")), F.lit(":"),
                            F.coalesce(turn.cast("string"), F.lit(" "))).cast("binary")) % 20
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    return conversations.select(
        conv.alias("conv_id"), turn.alias("turn"),
        F.when(kind == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(text, ".!?", ""))
        .otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"))


# ---- conversations of ordinary length --------------------------------------------

RESULT = ("conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, "
          "illegal bigint, cost bigint, audit string, repaired_sha256 string")
_ORDER = ("turn", "role", "text")


def repair_one(rows: list[tuple[int | None, str, str]]) -> tuple:
    """``rows``: turn, role, text in order.  The result's columns after the id."""
    seen: set[tuple[str, str]] = set()
    faults = []
    for _, role, text in rows:
        faults.append(fault_of(text, (role, text) in seen))
        seen.add((role, text))
    turns = {t for t, _, _ in rows if t is not None}
    symbols = bytes(symbol(r, f) for (_, r, _), f in zip(rows, faults))
    audit, digest, first = [], hashlib.sha256(), True
    for letter, i, q in walk(symbols):
        audit.append(letter)
        role, text = rows[i][1:] if i < len(rows) else ("", "")
        line = repaired_line(letter, q, role, text)
        if line is not None:
            digest.update((line if first else "\n" + line).encode("utf-8", "surrogatepass"))
            first = False
    initials = [r[:1] for _, r, _ in rows]
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            faults.count(BLANK), faults.count(DUPLICATE), faults.count(TRUNCATED),
            sum(a + b not in LEGAL for a, b in zip(initials, initials[1:])),
            least_cost(symbols)[0], "".join(audit), digest.hexdigest())


def _record(rows: list[tuple]) -> pa.RecordBatch:
    names = [c.split()[0] for c in RESULT.split(", ")]
    kinds = [pa.string() if c.endswith("string") else pa.int64() for c in RESULT.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k)
                                       for i, k in enumerate(kinds)], names=names)


def _repair_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, rows, open_ = None, [], False
    for batch in batches:
        out = []
        for part in slices(pa.StructArray.from_arrays(batch.columns, names=batch.schema.names)):
            for r in part:
                if not open_ or r["conv_id"] != now:
                    if open_:
                        out.append((now, *repair_one(rows)))
                    now, rows, open_ = r["conv_id"], [], True
                rows += [(r["turn"], r["role"], r["text"])] * r["copies"]
        if out:
            yield _record(out)
    if open_:
        yield _record([(now, *repair_one(rows))])


def _short(rows: DataFrame) -> DataFrame:
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", *_ORDER)
    return ordered.mapInArrow(_repair_sorted, RESULT)


# ---- long conversations: blocks ----------------------------------------------------

def _per_group(rows: DataFrame, schema: str, work: Callable[[list[dict]], list[tuple]],
               key: tuple[str, ...], order: tuple[str, ...]) -> DataFrame:
    names = [c.split()[0] for c in schema.split(", ")]

    def run(table: pa.Table) -> pa.Table:
        got = table.sort_by([(c, "ascending") for c in order]).to_pylist()
        out = work(got)
        kinds = {"bigint": pa.int64(), "string": pa.string(), "array<bigint>": pa.list_(pa.int64())}
        return pa.table({n: pa.array([r[i] for r in out], kinds[c.split()[1]])
                         for i, (n, c) in enumerate(zip(names, schema.split(", ")))})
    return rows.groupBy(*key).applyInArrow(run, schema)


def _symbols(rows: list[dict]) -> bytes:
    return bytes(symbol(r["role"], r["fault"]) for r in rows)


def _matrix(rows: list[dict]) -> list[tuple]:
    """A block's costs from each state to each, and its first and last initial."""
    symbols = _symbols(rows)
    units = [tuple(0 if q == q2 else INF for q in range(4)) for q2 in range(4)]
    columns = [least_cost(symbols, u) for u in units]
    initials = [r["role"][:1] for r in rows]
    inner = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))
    return [(rows[0]["c"], rows[0]["block"], [columns[q2][q] for q in range(4) for q2 in range(4)],
             initials[0], initials[-1], inner)]


def _vectors(blocks: list[dict]) -> list[tuple]:
    """The backward vector after each block, and the illegal pairs up to it."""
    v, out = END, []
    for i in range(len(blocks) - 1, -1, -1):
        b = blocks[i]
        joint = i and blocks[i - 1]["last"] + b["first"] not in LEGAL
        out.append((b["c"], b["block"], list(v), b["inner"] + int(joint), int(i == len(blocks) - 1)))
        m = b["matrix"]
        v = tuple(min(m[4 * q + q2] + v[q2] for q2 in range(4)) for q in range(4))
    return out


def _ends(rows: list[dict]) -> list[tuple]:
    symbols, v = _symbols(rows), tuple(rows[0]["after"])
    return [(rows[0]["c"], rows[0]["block"], [end_state(symbols, q, v) for q in range(4)])]


def _starts(blocks: list[dict]) -> list[tuple]:
    q, out = 0, []
    for b in blocks:
        out.append((b["c"], b["block"], q))
        q = b["ends"][q]
    return out


def _edits(rows: list[dict]) -> list[tuple]:
    """One row per edit: its letter, cost and the repaired line, if any."""
    out, first, symbols = [], rows[0], _symbols(rows)
    for n, (letter, i, q) in enumerate(walk(symbols, first["start"], tuple(first["after"]),
                                            last=bool(first["is_last"]))):
        row = rows[min(i, len(rows) - 1)]
        cost = INSERT if letter == "I" else next(c for a, c, _ in MOVES[symbols[i]][q] if a == letter)
        out.append((first["c"], first["block"], n, letter, cost,
                    repaired_line(letter, q, row["role"], row["text"])))
    return out


def _long(rows: DataFrame, block_rows: int) -> DataFrame:
    """The same for conversations of any length; ``c`` is the id, as text of
    a null id would clash with none."""
    present = rows.groupBy("conv_id").agg(F.count(F.lit(1)).alias("_n")).select("conv_id")
    c = F.struct(F.col("conv_id").isNull().cast("bigint").alias("z"),
                 F.coalesce("conv_id", F.lit(0)).alias("v"))
    copies = (rows.where("copies > 0")
              .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
              .select(F.concat_ws(":", c["z"].cast("string"), c["v"].cast("string")).alias("c"),
                      "conv_id", "turn", "role", "text", "copy"))
    keep: Callable[[DataFrame], DataFrame] = lambda df: materialize(df, "long-turns")
    placed = with_position(copies, [F.col("c"), F.col("turn").asc_nulls_first(), F.col("role"),
                                    F.col("text"), F.col("copy")], keep, name="at")
    key = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    placed = materialize(placed.withColumn("key", key).withColumn(
        "block", F.expr(f"at DIV {int(block_rows)}")), "long-placed")
    first = placed.groupBy(F.col("c").alias("fc"), F.col("key").alias("fkey")).agg(
        F.min("at").alias("first_at"))
    body = F.regexp_replace("text", r"[ \t-\r]+$", "")
    fault = (F.when(body == "", BLANK).when(F.col("at") > F.col("first_at"), DUPLICATE)
             .when(F.right(body, F.lit(1)).isin(".", "!", "?"), OK).otherwise(TRUNCATED))
    turns = materialize(sliced_join(placed, first, [("c", "fc"), ("key", "fkey")], "inner")
                        .select("conv_id", "c", "block", "at", "turn", "role", "text",
                                fault.alias("fault")), "long-faults")
    facts = turns.groupBy("c").agg(
        F.first("conv_id").alias("conv_id"), F.min("turn").alias("lo"), F.max("turn").alias("hi"),
        *[F.count(F.when(F.col("fault") == f, F.lit(1))).alias(n) for f, n in
          ((BLANK, "blank"), (DUPLICATE, "duplicate"), (TRUNCATED, "truncated"))])
    distinct = turns.where("turn is not null").select("c", "turn").distinct().groupBy("c").agg(
        F.count(F.lit(1)).alias("n_turns"))
    thin = turns.select("c", "block", "at", "role", "fault")
    matrices = materialize(_per_group(
        thin, "c string, block bigint, matrix array<bigint>, first string, last string, inner bigint",
        _matrix, ("c", "block"), ("at",)), "long-matrices")
    vectors = materialize(_per_group(
        matrices, "c string, block bigint, after array<bigint>, illegal bigint, is_last bigint",
        _vectors, ("c",), ("block",)), "long-vectors")
    ends = _per_group(thin.join(vectors, ["c", "block"]),
                      "c string, block bigint, ends array<bigint>", _ends, ("c", "block"), ("at",))
    starts = _per_group(ends, "c string, block bigint, start bigint", _starts, ("c",), ("block",))
    plan = materialize(vectors.join(starts, ["c", "block"]), "long-plan")
    edits = materialize(_per_group(
        turns.drop("turn", "conv_id").join(plan, ["c", "block"]),
        "c string, block bigint, nth bigint, letter string, cost bigint, line string", _edits,
        ("c", "block"), ("at",)), "long-edits")
    by_block = edits.groupBy("c", "block").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("nth", "letter"))),
                                 lambda x: x["letter"]), "").alias("letters"))
    audit = by_block.groupBy("c").agg(F.array_join(F.transform(F.sort_array(
        F.collect_list(F.struct("block", "letters"))), lambda x: x["letters"]), "").alias("audit"))
    paid = edits.groupBy("c").agg(F.sum("cost").alias("cost"))
    illegal = vectors.groupBy("c").agg(F.sum("illegal").alias("illegal"))
    digests = streamed_sha256(edits.where("line is not null"), ["c"], ["block", "nth"], "line", "\n")
    done = (facts.join(distinct, "c", "left").join(illegal, "c").join(audit, "c").join(paid, "c")
            .join(digests, "c", "left")
            .select("conv_id", F.coalesce(F.col("hi") - F.col("lo") + 1 - F.col("n_turns"),
                                          F.lit(0)).alias("gaps"),
                    "blank", "duplicate", "truncated", "illegal",
                    "cost", "audit", F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256")))
    bare = present.join(done.select(F.col("conv_id").alias("_c")),
                        F.col("conv_id").eqNullSafe(F.col("_c")), "left_anti")
    zero = F.lit(0).cast("bigint")
    return done.union(bare.select("conv_id", *[zero] * 6, F.lit(""), F.sha2(F.lit(""), 256)))


def repaired(conversations: DataFrame, long_rows: int = LONG_ROWS,
             block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per conversation: its faults, the cheapest edits, their cost
    and the digest of the repaired text."""
    rows = damaged(conversations)
    sizes = rows.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    long = materialize(sizes.where(F.col("n") > long_rows).select(F.col("conv_id").alias("_long")),
                       "long-conversations")
    if not long.head(1):
        return _short(rows)
    same = F.col("conv_id").eqNullSafe(F.col("_long"))
    return _short(rows.join(long, same, "left_anti")).union(
        _long(rows.join(long, same, "left_semi"), block_rows))
