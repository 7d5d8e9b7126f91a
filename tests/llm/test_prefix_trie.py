import hashlib
import random
import zlib
from collections import defaultdict

from saletrace.llm import prefix_trie


def brute(table):
    convs = defaultdict(list)
    for conv, turn, role, text in table:
        if conv is not None:
            convs[conv].append((turn, role or "", text or ""))
    for rows in convs.values():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1],
                                 hashlib.sha256(r[2].encode()).hexdigest()))
    built = {}
    for c, rows in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        built[c] = tuple(r[1:] for r in convs.get(base, [])[:h] + rows[h:])
    members = defaultdict(list)
    for c, seq in built.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    kids = defaultdict(set)
    for node in members:
        if node:
            kids[node[:-1]].add(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[k] for k in kids[node]) or 1
        own = (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        saved[node] = own + sum(saved[k] for k in kids[node])
    return sorted((min(m), len(node), min(members[node[:-1]]) if node else None, len(m),
                   len(kids[node]), leaves[node], saved[node], hashlib.sha256(",".join(
                       str(c) for c in sorted(m) if len(built[c]) == len(node)).encode()).hexdigest())
                  for node, m in members.items())


def check(spark, table, **kw):
    df = spark.createDataFrame([(*x, "clash", 1) for x in table],
                               "conv_id bigint, turn bigint, role string, text string, "
                               "digest string, d bigint")
    got = sorted(tuple(r) for r in prefix_trie.trie(df, **kw).collect())
    assert got == brute(table)


def table_of(seed, n=260, texts=3, longest=9):
    r = random.Random(seed)
    out = []
    for _ in range(n):
        c = r.choice([r.randrange(0, 420), r.randrange(0, 420), -r.randrange(1, 130)])
        for t in range(r.randint(0, longest)):
            out.append((c, r.choice([t, t, t, None]), r.choice(["user", "user", "assistant", None]),
                        r.choice(["", None, "é日本", "x" * 40] + [f"t{i}" for i in range(texts)])))
    return out


def test_equals_brute_force(spark):
    table = table_of(1)
    check(spark, table + table[:50] + [(None, 0, "user", "nobody's"), (700, None, None, None)])


def test_hot_keys_and_small_blocks(spark):
    """Joins sliced at ten rows a key, chains summed in blocks of two depths;
    a third of all conversations are the same."""
    same = [(c, t, "user", f"common {t}") for c in range(1000, 1400, 5) for t in range(7)]
    long = [(2000, t, "user", f"w{t % 3}") for t in range(300)]
    long += [(2003, t, "user", f"w{t % 3}") for t in range(290)]
    check(spark, table_of(2, n=60) + same + long, hot_rows=10, chain_block=2)


def test_met_fingerprints_are_drawn_anew(spark):
    """Bases of one make the hash blind to order: such prefixes meet, which
    the check finds, and the next bases are taken."""
    tried = []

    def weak_first(attempt):
        tried.append(attempt)
        return (1, 1, 1, 1) if attempt == 0 else prefix_trie.draw(attempt)
    table = [(100 * c, t, "user", x) for c, seq in enumerate(["ab", "ba", "abc", "bac"])
             for t, x in enumerate(seq * 4)]
    check(spark, table, bases=weak_first)
    assert tried == [0, 1]


def test_long_text_and_empty_table(spark):
    check(spark, [(100, 0, "user", "x" * 1_000_000), (101, 0, "user", "y " * 400_000)])
    empty = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert prefix_trie.trie(empty).collect() == []
