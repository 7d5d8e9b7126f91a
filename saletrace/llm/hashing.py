"""SHA-256 over pieces of a text that lie on many rows.

A digest is one sequential computation, so all pieces of one key pass through
one task; they do so one Arrow batch after another, and nothing of a text is
held but the digest's state.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def streamed_sha256(pieces: DataFrame, key: Sequence[str], order: Sequence[str], text: str,
                    sep: str) -> DataFrame:
    """``key..., sha256``: the lowercase hex digest of each key's ``text``
    values in ``order``, joined by ``sep``.  ``key`` columns are bigint or
    string."""
    rows = (pieces.select(*key, *order, F.col(text).alias("_text")).repartition(*key)
            .sortWithinPartitions(*key, *order).select(*key, "_text"))
    n, joint = len(key), sep.encode()
    kinds = {k: rows.schema[k].dataType.simpleString() for k in key}
    arrow = [pa.string() if kinds[k] == "string" else pa.int64() for k in key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None

        def done(keys: list, hexes: list) -> pa.RecordBatch:
            columns = [pa.array([k[i] for k in keys], arrow[i]) for i in range(n)]
            return pa.RecordBatch.from_arrays(columns + [pa.array(hexes, pa.string())],
                                              names=[*key, "sha256"])
        for batch in batches:
            keys, hexes = [], []
            ids = list(zip(*[batch.column(i).to_pylist() for i in range(n)]))
            for one, piece in zip(ids, batch.column(n).to_pylist()):
                if one != now:
                    if state is not None:
                        keys.append(now)
                        hexes.append(state.hexdigest())
                    now, state = one, hashlib.sha256()
                else:
                    state.update(joint)
                state.update(piece.encode("utf-8", "surrogatepass"))
            if keys:
                yield done(keys, hexes)
        if state is not None:
            yield done([now], [state.hexdigest()])

    return rows.mapInArrow(run, ", ".join(f"{k} {t}" for k, t in kinds.items())
                           + ", sha256 string")
