import hashlib
import heapq
import random
import re
import zlib

import pytest

from saletrace.llm import conversation_repair as cr

WHITE = "".join(chr(c) for c in (32, 9, 10, 11, 12, 13))
FORM = re.compile(r"(s?(ua)+)?")


def damage(conv, turn, role, text):
    role, text = (" " if x is None else x for x in (role, text))
    key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
    kind = zlib.crc32(key.encode()) % 20
    if kind == 0:
        return []
    if kind == 1:
        text = ""
    if kind == 2:
        text = re.sub("[.!?]", "", text)
    if kind == 4:
        role = "user"
    return [(turn, role, text)] * (2 if kind == 3 else 1)


def cheapest(rows, faults):
    """Dijkstra over (row, repaired initials' state) with the letters so far:
    least cost, then least string.  States are the initials themselves cut to
    what the pattern still needs, found by trying suffixes against it."""
    def alive(initials):  # can some suffix complete it?
        return any(FORM.fullmatch(initials + tail) for tail in ("", "a", "ua", "uaua"))

    def short(initials):
        return initials if len(initials) < 3 else ("ua" if initials[-1] == "a" else "uau")
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, letters, i, initials, lines = heapq.heappop(heap)
        if (i, initials) in done:
            continue
        done.add((i, initials))
        if i == len(rows) and FORM.fullmatch(initials):
            return cost, letters, lines
        steps = [("I", 3, i, name, "") for name in ("user", "assistant")]
        if i < len(rows):
            _, role, text = rows[i]
            steps.append(("D", 4, i + 1, None, None))
            if faults[i] not in ("blank", "duplicate"):
                extra = 3 if faults[i] == "truncated" else 0
                steps.append(("K", extra, i + 1, role, text))
                steps += [("R", 3 + extra, i + 1, name, text) for name in ("user", "assistant")]
        for letter, c, j, role, text in steps:
            if role is None:
                heapq.heappush(heap, (cost + c, letters + letter, j, initials, lines))
            elif role[:1] and alive(initials + role[:1]):
                heapq.heappush(heap, (cost + c, letters + letter, j, short(initials + role[:1]),
                                      lines + (f"{role}:{text}",)))
    raise AssertionError("no repair")


def brute(table):
    convs = {}
    for conv, turn, role, text in table:
        convs.setdefault(conv, []).extend(damage(conv, turn, role, text))
    out = {}
    for conv, rows in convs.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        faults = []
        for n, (_, role, text) in enumerate(rows):
            body = text.strip(WHITE)
            faults.append("blank" if not body else
                          "duplicate" if any(r[1:] == (role, text) for r in rows[:n]) else
                          "truncated" if body[-1] not in ".!?" else "")
        turns = [r[0] for r in rows if r[0] is not None]
        cost, audit, lines = cheapest(rows, faults)
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
                     *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
                     sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:])),
                     cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def random_table(n, seed, longest=9):
    r = random.Random(seed)
    table = []
    for c in range(n):
        turns = list(range(r.randint(1, longest)))
        for t in turns:
            role = r.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            if r.random() < 0.5:
                role = "system" if t == 0 and c % 3 == 0 else ("user", "assistant")[(t + c % 3) % 2]
            text = r.choice(["one.", "two!", "no end", " \n", "", None, "same?", f"text {t}. "])
            table.append((c, r.choice([t, t, t, t + 3, None]), role, text))
    return table


def check(spark, table, **kw):
    df = spark.createDataFrame([(*x, "clash", "clash") for x in table],
                               "conv_id bigint, turn bigint, role string, text string, "
                               "copies string, cost string")
    got = {r.conv_id: tuple(r)[1:] for r in cr.repaired(df, **kw).collect()}
    assert got == brute(table)


def test_equals_search_over_all_edits(spark):
    table = random_table(250, 1)
    check(spark, table + table[:40] + [(None, 0, "user", "a."), (None, 1, "assistant", "b."),
                                       (900, None, None, None), (-7, -2, "assistant", "é 日本.")])


def test_long_conversations_in_blocks(spark):
    """Every conversation of over 3 rows goes by blocks of 4."""
    table = random_table(40, 2, longest=14) + [(None, i, "user", f"t{i}.") for i in range(9)]
    check(spark, table, long_rows=3, block_rows=4)


def test_a_long_dropped_conversation(spark):
    gone = [(5, t, "user", "x.") for t in range(400) if zlib.crc32(f"5:{t}".encode()) % 20 == 0]
    check(spark, gone + [(6, 0, "user", "x.")], long_rows=2, block_rows=4)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 10, 99, 1000])
def test_checkpointed_walk_costs_the_least(n):
    r = random.Random(n)
    symbols = bytes(r.randrange(16) for _ in range(n))
    cost = {"I": cr.INSERT}
    paid = sum(cost.get(a) or next((c for b, c, _ in cr.MOVES[symbols[i]][q] if b == a))
               if a != "K" else next(c for b, c, _ in cr.MOVES[symbols[i]][q] if b == a)
               for a, i, q in cr.walk(symbols))
    assert paid == cr.least_cost(symbols)[0]


def test_very_long_text_and_empty_table(spark):
    check(spark, [(1, 0, "user", "x" * 2_000_000 + "."), (1, 1, "assistant", "word " * 300_000)])
    empty = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert cr.repaired(empty).collect() == []
