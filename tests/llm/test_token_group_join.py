import random
import re

import numpy as np
import pyarrow as pa

from saletrace.llm import token_group_join as tg

WORD = re.compile("[^ \t-\r]+")


def naive_set(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(low)
    if len(w) < 4:
        return {" ".join(w)} if w else set()
    return {" ".join(w[i:i + 4]) for i in range(len(w) - 3)}


def brute(rows):
    sets = [naive_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and (a == b or 100 * len(a & b) >= 85 * len(a | b)):
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted(((d, len(s), least.get(find(i)) if s else d)
                   for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def corpus(seed, n=220):
    """Families of near copies at all distances, a passage that many share,
    short texts, and chains whose ends do not link."""
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(60)]
    passage = [r.choice(vocab) for _ in range(40)]
    out, text = [], []
    for i in range(n):
        kind = r.random()
        if not text or kind < 0.3:
            text = [r.choice(vocab) for _ in range(r.choice([1, 3, 4, 5, 7, 12, 30, 90, 200]))]
            if r.random() < 0.5:
                text = text[:8] + passage + text[8:]
        for _ in range(r.choice([0, 0, 1, 1, 2, 4])):
            at = r.randrange(len(text) + 1)
            text = text[:at] + ([r.choice(vocab)] if r.random() < 0.6 else []) + text[at + 1:]
        text = text or ["w"]
        out.append((i * 3 % 1009, " ".join(w.upper() if r.random() < 0.1 else w for w in text)))
    return out


def check(make_docs, rows, **kw):
    got = tg.linked_documents(make_docs(rows, clash=True), **kw).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)


def test_sets_are_the_shingles():
    texts = [None, "", " \x0b ", "One", "one  TWO\tthree", "a b c d", "A b c d a b c d e", "é b c d"]
    sets = tg.token_sets(pa.array(texts))
    assert [len(s) for s in sets] == [len(naive_set(t)) for t in texts]
    again = tg.token_sets(pa.array(["x y", "a B C d", "one two three"]).slice(1))
    assert again[0] == sets[5] and again[1] == sets[4]


def test_equals_all_pairs(make_docs, odd_rows):
    check(make_docs, corpus(1) + odd_rows)


def test_small_groups_slices_and_heavy_tokens(make_docs, monkeypatch):
    monkeypatch.setattr(tg, "GROUP", 2)
    monkeypatch.setattr(tg, "QUERIES", 3)
    monkeypatch.setattr(tg, "BLOCK_TOKENS", 500)
    check(make_docs, corpus(2), hot_rows=5)


def test_order_by_weight_does_not_change_links(make_docs, monkeypatch):
    """Few ranges, so weights are arbitrary, and a bit map that selects nearly
    all ids."""
    monkeypatch.setattr(tg, "WEIGHT_BITS", 3)
    monkeypatch.setattr(tg, "WEIGHT_BLOCK", 2)
    monkeypatch.setattr(tg, "MAP_BITS", 7)
    check(make_docs, corpus(3))


def test_a_family_of_copies_makes_no_pairs(make_docs):
    """Hundreds of near copies are led by one, not paired."""
    r = random.Random(5)
    base = [r.choice("abcdefgh") * r.randint(1, 5) for _ in range(150)]
    rows = []
    for i in range(400):
        text = list(base)
        text[r.randrange(150)] = f"edit{i}"
        rows.append((i, " ".join(text)))
    got = tg.linked_documents(make_docs(rows)).collect()
    assert {r.component_id for r in got} == {0}


def test_first_tokens_always_meet():
    """Two sets over the threshold share a first token under any order."""
    r = np.random.default_rng(3)
    weights = r.integers(0, 5, 1 << tg.WEIGHT_BITS).astype(np.uint8)
    heavy = r.integers(0, 2 ** 64, 50, dtype=np.uint64)
    for _ in range(500):
        n = int(r.integers(1, 60))
        pool = np.unique(np.concatenate([heavy, r.integers(0, 2 ** 64, 40, dtype=np.uint64)]))
        x = np.sort(r.choice(pool, min(n, len(pool)), replace=False))
        y = np.unique(np.concatenate([x[r.random(len(x)) < 0.95],
                                      r.choice(pool, int(len(x) * 0.08))]))
        both = len(np.intersect1d(x, y))
        if both and 100 * both >= 85 * (len(x) + len(y) - both):
            assert set(tg.first_tokens(x, weights)) & set(tg.first_tokens(y, weights))


def test_histograms_bound_the_common_tokens():
    r = np.random.default_rng(8)
    for _ in range(300):
        x = np.unique(r.integers(0, 2 ** 64, int(r.integers(1, 400)), dtype=np.uint64))
        y = np.unique(np.concatenate([x[r.random(len(x)) < r.random()],
                                      r.integers(0, 2 ** 64, int(r.integers(0, 300)), dtype=np.uint64)]))
        a, b = (np.frombuffer(tg.histogram(t), np.uint8).astype(np.int64) for t in (x, y))
        if len(y):
            assert tg.most_common(a, b, 0) >= len(np.intersect1d(x, y))
            assert a.sum() == len(x) and tg.most_common(a, a, 0) == len(x)
    crowded = np.arange(400, dtype=np.uint64)  # all in one range: no bound
    assert tg.histogram(crowded) == b"" and tg.most_common(np.zeros(0), a, 17) == 17


def test_empty_table(make_docs):
    assert tg.linked_documents(make_docs([])).collect() == []


def test_blocks_are_counted_in_one_buffer(monkeypatch):
    """Blocks of many small sets: the counts are right, a set that overfills a
    block stays whole in it, and no block is held twice."""
    import tracemalloc
    from collections import Counter

    monkeypatch.setattr(tg, "BLOCK_TOKENS", 1 << 16)
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 1 << 18, 400).astype(np.uint64)) for _ in range(2000)]
    sets.insert(3, np.arange(1 << 17, dtype=np.uint64))  # longer than a block
    want, block = [], []
    for s in sets:
        block.append(s)
        if sum(map(len, block)) > 1 << 16:
            want.append(block)
            block = []
    want = [{t: n for t, n in Counter(np.concatenate(b).tolist()).items() if n > 1}
            for b in [*want, block] if b]
    monkeypatch.setattr(tg, "_sets", lambda text: iter(sets))
    batch = pa.RecordBatch.from_arrays([pa.array([""])], ["text"])
    got = [dict(zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
           for b in tg._repeats(iter([batch]))]
    assert got == want

    small = [rng.integers(0, 1 << 62, 400).astype(np.uint64) for _ in range(2000)]
    monkeypatch.setattr(tg, "BLOCK_TOKENS", sum(map(len, small)) - 1)
    monkeypatch.setattr(tg, "_sets", lambda text: (s.copy() for s in small))
    tracemalloc.start()
    list(tg._repeats(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 12 * tg.BLOCK_TOKENS  # 8 bytes a token, and one to mark repeats


def test_a_worker_holds_the_words_of_a_short_run(monkeypatch):
    """A batch is cut to runs of 1 MB of text or less; a longer text is whole."""
    text = pa.array(["ab " * 100_000] * 9 + ["cd " * 1_000_000, None, "ef"])
    runs = list(tg._slices(text))
    assert pa.concat_arrays(runs).equals(text)
    assert all(len(r) == 1 or sum(len(t or "") for t in r.to_pylist()) <= 1 << 20 for r in runs)
