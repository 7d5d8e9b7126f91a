import io
import zlib

import numpy as np
import public_tokenizers
import pytest
import zstandard

from saletrace.llm import token_files as tf
from saletrace.llm.common import new_folder

PATH = public_tokenizers.path("word_bpe_49k.json")


def shard(sizes):
    r, file = np.random.default_rng(0), io.BytesIO()
    docs = [r.integers(0, 49_000, n).astype("<u4").tobytes() for n in sizes]
    writer = tf.ShardWriter(file)
    for i, d in enumerate(docs):
        writer.add(None if i == 0 else i, d)
    writer.close()
    return docs, file.getvalue()


SIZES = [3, 0, tf.FRAME_IDS, 1, 3 * tf.FRAME_IDS + 5, 7, 0, tf.FRAME_IDS - 8, 2 * tf.FRAME_IDS, 40]


def test_round_trip_and_random_access():
    docs, raw = shard(SIZES)
    reader = tf.ShardReader(io.BytesIO(raw))
    assert [d for _, _, d in reader.documents()] == docs
    assert [reader.document(k) for k in reversed(range(len(docs)))] == docs[::-1]
    assert [(i, a) for i, a, _ in reader.documents()] == [
        (k or None, sum(SIZES[:k])) for k in range(len(SIZES))]
    # a plain decoder skips the index and the table
    plain = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw), read_across_frames=True)
    assert plain.read() == b"".join(docs)


def test_only_requested_frames_are_read():
    _, raw = shard(SIZES)
    reader, read = tf.ShardReader(io.BytesIO(raw)), []
    own = reader.frame
    reader.frame = lambda k: read.append(k) or own(k)
    reader.document(5)
    assert len(read) == 1
    reader.document(1)
    assert len(read) == 1


def test_damage_is_found():
    docs, raw = shard([2000])
    bad = bytearray(raw)
    bad[40] ^= 1
    with pytest.raises((ValueError, zstandard.ZstdError)):
        tf.ShardReader(io.BytesIO(bytes(bad))).document(0)
    with pytest.raises(ValueError):
        tf.ShardReader(io.BytesIO(raw[:-1]))


def test_operator(spark, make_docs, odd_rows):
    from tokenizers import Tokenizer
    exact = Tokenizer.from_file(PATH)
    docs = make_docs(odd_rows, clash=True)
    folder = new_folder(spark, "tokens")
    manifest = tf.write_tokens(docs, PATH, folder)
    rows = tf.read_tokens(manifest).orderBy("start").collect()
    assert [r.id for r in rows] == sorted((i for i, _ in odd_rows),
                                          key=lambda i: (i is not None, i or 0))
    ids = lambda t: exact.encode(t or "", add_special_tokens=False).ids + [2]
    at = 0
    for r in rows:
        assert r.start == at
        at += len(r.ids) // 4
    got = sorted((r.id is None, r.id or 0, zlib.crc32(r.ids)) for r in rows)
    assert got == sorted((i is None, i or 0, zlib.crc32(np.array(ids(t), "<u4").tobytes()))
                         for i, t in odd_rows)
    want = spark.createDataFrame([(4,), (6,), (77,)], "id bigint")
    some = tf.read_tokens(manifest, want).collect()
    assert sorted((r.id, r.start, bytes(r.ids)) for r in some) == sorted(
        (r.id, r.start, bytes(r.ids)) for r in rows if r.id in (4, 6))
    assert tf.tokenized(spark, docs.limit(0), PATH).count() == 0
