import random

import duckdb
import numpy as np

from saletrace.llm import decontam


def naive(text, item):
    words = lambda t: [w for w in "".join(
        c if c.isalnum() and c.isascii() or ord(c) > 127 else " " for c in (t or "").lower()).split(" ") if w]
    a, b = words(text), words(item)
    if not b:
        return None
    n = min(5, len(b))
    grams = lambda w: {tuple(w[i:i + n]) for i in range(len(w) - n + 1)}
    shared = len(grams(a) & grams(b))
    return (len(grams(b)), shared) if 10 * shared >= 8 * len(grams(b)) else None


def cases(prose):
    r = random.Random(3)
    items = [(i, prose(r.choice([3, 5, 6, 12, 25, 60, 200]), 100 + i)) for i in range(30)]
    items += [(30, None), (31, ""), (32, "?!"), (33, items[4][1]), (None, prose(20, 999))]
    docs = []
    for k in range(120):
        body = prose(r.choice([0, 10, 100, 3000]), 1000 + k).split()
        for _ in range(r.choice([0, 1, 3])):
            part = r.choice(items[:30])[1].split()
            for _ in range(r.choice([0, 0, 1, 2])):
                part[r.randrange(len(part))] = "changed"
            at = r.randint(0, len(body))
            body[at:at] = part
        docs.append((k, r.choice([" ", ", ", "\n"]).join(body).upper() if k % 7 == 0
                     else " ".join(body)))
    return docs, items


def test_equals_brute_force(spark, make_docs, prose, odd_rows):
    docs, items = cases(prose)
    docs += [(i, t) for i, t in odd_rows]
    table = spark.createDataFrame(items, "item_id bigint, text string")
    want = sorted(((i, j, *naive(t, x)) for i, t in docs for j, x in items if naive(t, x)), key=repr)
    for block in (1000, 7):  # one block of items, or several
        got = decontam.contained_items(make_docs(docs, clash=True), table, block=block).collect()
        assert sorted(((r.doc_id, r.item_id, r.n_shingles, r.n_shared) for r in got),
                      key=repr) == want
    clean = decontam.drop_contaminated(make_docs(docs, clash=True), table, block=7)
    bad = {(i, t) for i, t in docs if any(naive(t, x) for _, x in items)}
    assert sorted(((r.doc_id, r.text) for r in clean.collect()), key=repr) == sorted(
        ((i, t) for i, t in docs if (i, t) not in bad), key=repr)


def test_sketch_never_misses():
    r = random.Random(1)
    for q in [*range(1, 70), 200, 1000]:
        grams = np.array(sorted(r.sample(range(10 ** 9), q)))
        lost = set(r.sample(range(q), int(0.2 * q + 1e-9)))
        assert any(i not in lost for i in range(decontam.sketch_size(q)))
        assert decontam.sketch_size(q) > int(0.2 * q + 1e-9)
        assert len(grams) == q


def test_empty_tables(spark, make_docs):
    none = spark.createDataFrame([], "item_id bigint, text string")
    docs = make_docs([(1, "a b c")])
    assert decontam.contained_items(docs, none).count() == 0
    assert decontam.drop_contaminated(docs, none).count() == 1
    items = spark.createDataFrame([(1, "a b c")], "item_id bigint, text string")
    assert decontam.contained_items(docs.limit(0), items).count() == 0


def test_equals_sql(spark, sf_small):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_small}/{t}.parquet'")
    want = sorted(con.sql(decontam.containment_sql()).fetchall())
    got = decontam.contained_items(spark.read.parquet(f"{sf_small}/documents.parquet"),
                                   spark.read.parquet(f"{sf_small}/benchmark.parquet"))
    assert sorted(map(tuple, got.collect())) == want and want
