import random

import numpy as np
import public_tokenizers
import pytest

from saletrace.llm import bpe, word_bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
ALPHABET = ["'", "s", "t", "re", "ll", " ", "  ", "\n", " \n", "a", "ab", "é", "日", "😀", "1", "23",
            "!", "!!", "<|endoftext|>", "<|", "endoftext", "|>", " ", "　", "́", "the",
            "ing", "\t", "\x1c", "\x85", "ß", "İ", "Σ", "ſ", "'s", "'LL", "x" * 9, " " * 7, "\r\n",
            "​", "…", "—", "ŉ", "²", "½", "\xad"]


def texts(n, seed):
    r = random.Random(seed)
    return ["".join(r.choices(r.sample(ALPHABET, r.randint(1, 8)), k=r.randint(0, 50)))
            for _ in range(n)]


@pytest.mark.parametrize("leaf", [3, 8, 64])
def test_tree_equals_library(monkeypatch, leaf):
    monkeypatch.setattr(bpe, "LEAF_CHARS", leaf)
    codec = bpe.ByteBpe(PATH)
    for x in texts(3000, leaf):
        want = codec.exact.encode(x, add_special_tokens=False).ids
        got = codec.encode(x)
        assert got.tolist() == want, repr(x)
        assert codec.decode(got) == codec.exact.decode(want, skip_special_tokens=False)


def test_unsplit_runs(monkeypatch):
    monkeypatch.setattr(bpe, "LEAF_CHARS", 100)
    codec = bpe.ByteBpe(PATH)
    r = random.Random(2)
    for x in ("a" * 5000, " " * 5000 + "x", "\n" * 3001, "日" * 900, "ab" * 2000 + "'s",
              "".join(r.choices("abcde", k=6000)), "😀" * 700, "1" * 2222):
        assert codec.encode(x).tolist() == codec.exact.encode(x, add_special_tokens=False).ids


def test_word_memory_is_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 3)
    codec = bpe.ByteBpe(PATH)
    for x in ("one two three four", "five six one two", "one nine five five"):
        assert codec.encode(x).tolist() == codec.exact.encode(x, add_special_tokens=False).ids


def test_operator(spark, make_docs, odd_rows):
    odd_rows = odd_rows + [odd_rows[8]] * 3  # a long row, four times
    docs = make_docs(odd_rows, clash=True)
    out = bpe.decode(bpe.encode(docs, PATH), PATH).collect()
    exact = bpe.ByteBpe(PATH).exact
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    want = sorted(((i, t or "") for i, t in odd_rows), key=key)
    got = sorted(((r.doc_id, r.text) for r in out), key=key)
    assert got == want
    ids = {r.text: r.ids for r in out}
    for t in ids:
        assert ids[t] == exact.encode(t, add_special_tokens=False).ids
    assert bpe.encode(docs.limit(0), PATH).count() == 0


def test_word_files_equal_library():
    codec = word_bpe.WordBpe(public_tokenizers.path("word_bpe_49k.json"))
    for x in texts(4000, 1) + ["", "The QUICK brown fox's 42 naïve ÀÉÎ—test <|startoftext|>x"]:
        want = codec.exact.encode(x, add_special_tokens=False).ids
        assert np.frombuffer(codec.encode(x), "<u4").tolist() == want, repr(x)
