import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from saletrace.llm import simhash
from saletrace.llm.components import components


def naive_print(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\r\x0b\x0c":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    parts = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    h = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def naive_groups(prints):
    """Root (smallest member) of every fingerprint, by comparing all pairs."""
    prints = sorted(set(prints))
    parent = {p: p for p in prints}

    def find(p):
        while parent[p] != p:
            p = parent[p]
        return p
    for i, a in enumerate(prints):
        for b in prints[:i]:
            if bin((a ^ b) & (2 ** 64 - 1)).count("1") <= 2:
                parent[max(find(a), find(b))] = min(find(a), find(b))
    return {p: find(p) for p in prints}


def test_golay_keys_meet_within_two_bits():
    r = np.random.default_rng(0)
    table, count = simhash.golay_keys()
    assert set(count.tolist()) == {1, 6}
    words = r.integers(0, 1 << 23, 4000)
    for flips in (0, 1, 2):
        near = words.copy()
        for i in range(len(near)):
            for b in r.choice(23, flips, replace=False):
                near[i] ^= 1 << int(b)
        keys = []
        for v in (words, near):
            rows, index = simhash.fuzzy_keys(v)
            own = [set() for _ in v]
            for a, b in zip(rows.tolist(), index.tolist()):
                own[a].add(b)
            keys.append(own)
        assert all(a & b for a, b in zip(*keys))


def near_prints(n, seed):
    r = random.Random(seed)
    out = []
    while len(out) < n:
        x = r.getrandbits(64)
        for _ in range(r.choice([1, 1, 3, 12])):
            out.append(x)
            for b in r.sample(range(64), r.choice([1, 2, 2, 3])):
                x ^= 1 << b
    return [x - (1 << 64) if x >> 63 else x for x in out]


def check_groups(spark, prints):
    rows = spark.createDataFrame([(i, p) for i, p in enumerate(prints)], "id bigint, fp bigint")
    want = naive_groups(prints)
    least = {}
    for i, p in enumerate(prints):
        least.setdefault(want[p], i)
        least[want[p]] = min(least[want[p]], i)
    got = {r.fp: (r.root, r.component_id) for r in simhash.group_prints(rows).collect()}
    assert got == {p: (want[p], least[want[p]]) for p in want}


def test_links_equal_all_pairs(spark):
    check_groups(spark, near_prints(400, 1))


def test_crowded_keys(spark, monkeypatch):
    """Every key that two fingerprints share goes by balls instead of pairs."""
    monkeypatch.setattr(simhash, "CROWD", 1)
    check_groups(spark, near_prints(300, 2))


def test_mixed_crowds(spark, monkeypatch):
    monkeypatch.setattr(simhash, "CROWD", 3)
    x = 0x0123456789ABCDEF
    check_groups(spark, near_prints(100, 3) + [x ^ (1 << b) for b in range(62)] + [x])


def test_components(spark):
    r = random.Random(5)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(180)]
    edges += [(1000 + i, 1001 + i) for i in range(60)]  # a chain
    parent = {}

    def find(p):
        parent.setdefault(p, p)
        while parent[p] != p:
            p = parent[p]
        return p
    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r.node: r.root for r in
           components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert got == {p: find(p) for p in parent if find(p) != p}


def test_operator(spark, make_docs, odd_rows):
    rows = odd_rows + [(20, "THE cat sat on the mat"), (21, "the cat\tsat on  the mat")]
    out = simhash.near_duplicates(make_docs(rows, clash=True)).collect()
    assert len(out) == len(rows)
    prints = {(r.doc_id, r.fingerprint): r.component_id for r in out}
    signed = [naive_print(t) for _, t in rows]
    root = naive_groups(signed)
    for (i, _), p in zip(rows, signed):
        ids = [j for (j, _), q in zip(rows, signed) if root[q] == root[p] and j is not None]
        assert prints[(i, f"{p:016x}")] == (min(ids) if ids else None)


def test_keep_one(spark, make_docs, odd_rows):
    docs = make_docs(odd_rows, clash=True)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    got = sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect())
    signed = {}
    for i, t in odd_rows:
        signed.setdefault(naive_print(t), []).append(i)
    root = naive_groups(signed)
    groups = {}
    for p, ids in signed.items():
        groups.setdefault(root[p], []).extend(ids)
    want = sorted((all(i is None for i in g), min([i for i in g if i is not None], default=0))
                  for g in groups.values())
    assert got == want
    assert simhash.keep_one(docs.limit(0)).count() == 0


def test_plan_makes_no_pairs_of_copies(spark, make_docs):
    """A thousand copies are one fingerprint: no key is met twice."""
    docs = make_docs([(i, "the same words in every one of these rows") for i in range(1000)])
    out = simhash.near_duplicates(docs)
    assert out.filter(F.col("component_id") != 0).count() == 0


def test_keep_one_where_an_id_stands_on_several_texts(spark, make_docs, prose):
    """Each component keeps a row, and it is the component's own."""
    a, b, c = (prose(200, 900 + k) for k in range(3))
    rows = [(1, a), (1, b), (2, b), (1, c), (3, c), (3, a), (1, a)]
    assert len({naive_print(t) for t in (a, b, c)}) == 3
    kept = simhash.keep_one(make_docs(rows, clash=True)).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == sorted([(1, a), (1, b), (1, c)])
