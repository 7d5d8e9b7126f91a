"""Exact sums, chunked lists and sliced joins."""

import math
import random

import pytest
from pyspark.sql import functions as F

from saletrace.functions.exact import exact_sum_parts, exact_sum_result
from saletrace.operators.chunks import joined_chunks
from saletrace.operators.skew import sliced_join


def exact_sum(df, group="g", value="x"):
    return df.groupBy(group).agg(*exact_sum_parts(F.col(value), "_s")).select(
        group, exact_sum_result("_s").alias("s"))


def test_sum_is_the_nearest_double_whatever_the_partitions(spark):
    """10,000 addends of mixed size and sign: the same bits under 1, 7 and 64
    partitions, those of an exactly rounded sum."""
    r = random.Random(1)
    rows = [(g, r.choice([-1, 1]) * r.random() * 10.0 ** r.randint(-20, 40)) for g in range(5)
            for _ in range(2000)]
    rows += [(5, 1e16), (5, 1.0), (5, -1e16), (6, 0.1), (6, -0.1), (7, None), (8, 0.1), (8, 0.2)]
    want = {g: math.fsum(x for h, x in rows if h == g and x is not None) for g in range(9)}
    want[7] = None
    for n in (1, 7, 64):
        df = spark.createDataFrame(rows, "g int, x double").repartition(n)
        assert {row.g: row.s for row in exact_sum(df).collect()} == want


def test_rounding_is_to_even_and_sticky(spark):
    cases = [[2.0 ** 53, 1.0], [2.0 ** 53, 1.0, 2.0 ** -60], [2.0 ** 53, 3.0], [-2.0 ** 53, -1.0],
             [-2.0 ** 53, -1.0, -2.0 ** -60], [2.0 ** 200, -2.0 ** 147, 2.0 ** -50],
             [2.0 ** -75, 2.0 ** 100, -2.0 ** 100], [-0.0], [4294967296.0, -1.0]]
    r = random.Random(3)
    cases += [[math.ldexp(r.randrange(-2 ** 53, 2 ** 53), r.randint(-70, 60)) for _ in range(3)]
              for _ in range(300)]
    df = spark.createDataFrame([(g, x) for g, xs in enumerate(cases) for x in xs], "g int, x double")
    got = {row.g: row.s for row in exact_sum(df).collect()}
    assert got == {g: math.fsum(xs) for g, xs in enumerate(cases)}


def test_addends_out_of_range(spark):
    rows = [(0, math.inf), (0, 1.0), (1, math.nan), (1, 1.0), (2, 1e300), (2, 1.0), (3, 1e-300)]
    got = {r.g: r.s for r in exact_sum(spark.createDataFrame(rows, "g int, x double")).collect()}
    assert got[0] == math.inf and math.isnan(got[1]) and got[2] == 1e300 and got[3] == 1e-300


@pytest.mark.parametrize("chunk", [1, 7, 10_000])
def test_chunks_concatenate_to_the_sorted_list(spark, chunk):
    r = random.Random(chunk)
    rows = [(r.choice([None, 1, 2]), f"v{r.randrange(500)}") for _ in range(900)] + [(3, None)]
    df = spark.createDataFrame(rows, "g int, v string")
    got = {}
    for c in joined_chunks(df, ["g"], "v", sep="|", chunk_rows=chunk).orderBy("g", "chunk").collect():
        pieces = got.setdefault(c.g, [])
        assert c.chunk == len(pieces) and c.n_values == len(c.text.split("|")) <= chunk
        pieces.append(c.text)
    want = {}
    for g, v in rows:
        if v is not None:
            want.setdefault(g, []).append(v)
    assert {g: "|".join(p) for g, p in got.items()} == {g: "|".join(sorted(v)) for g, v in want.items()}


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("hot_rows", [None, 200])
def test_sliced_join_equals_the_join(spark, how, hot_rows):
    r = random.Random(2)
    left = spark.createDataFrame(
        [(r.choice([None, "hot", "hot", "hot", f"k{r.randrange(40)}"]), r.choice([None, 1, 2]), i)
         for i in range(2000)], "a string, b int, i int")
    right = spark.createDataFrame([("hot", 1, "x"), ("hot", 1, "y"), (None, 1, "n"), ("k1", None, "m")]
                                  + [(f"k{j}", j % 3, f"z{j}") for j in range(30)],
                                  "c string, d int, w string")
    plain = left.join(right, (left.a == right.c) & (left.b == right.d), how)
    got = sliced_join(left, right, [("a", "c"), ("b", "d")], how, hot_rows)
    assert got.columns == plain.columns
    key = lambda x: tuple((v is not None, v) for v in x)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, plain.collect()), key=key)


def test_no_task_holds_the_hot_key(spark):
    """One key on nine rows of ten, and NULLs on half of the others: the
    largest task of the join has at most a few slices of rows."""
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled",
            "spark.sql.shuffle.partitions")
    old = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in zip(keys, ("-1", "false", "64")):
            spark.conf.set(k, v)
        n, hot = 40_000, 500
        left = spark.range(n).select(
            F.when(F.col("id") % 10 != 0, F.lit(7)).when(F.col("id") % 20 == 0, F.col("id")).alias("k"),
            F.col("id").alias("v"))
        right = spark.range(n).select(F.col("id").alias("rk"), (F.col("id") * 2).alias("w"))
        out = sliced_join(left, right, [("k", "rk")], "left", hot_rows=hot)
        sizes = [r.n for r in out.groupBy(F.spark_partition_id().alias("p")).agg(
            F.count(F.lit(1)).alias("n")).collect()]
        assert sum(sizes) == n and max(sizes) <= 6 * hot
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_result_is_cheap_and_the_same_by_columns(spark):
    """A million sums in seconds (the first form took milliseconds for each),
    and the staged form gives the bits of the single expression."""
    import time

    from saletrace.functions.exact import with_exact_sum

    r = random.Random(5)
    rows = [(g, r.choice([-1, 1]) * math.ldexp(r.randrange(1, 2 ** 53), r.randint(-70, 100)))
            for g in range(400) for _ in range(r.randint(1, 4))]
    rows += [(1000, None), (1001, -1.0), (1002, -2.0 ** -75), (1003, math.inf), (1004, -4294967296.0)]
    df = spark.createDataFrame(rows, "g int, x double")
    parts = df.groupBy("g").agg(*exact_sum_parts(F.col("x"), "_s"))
    staged = {row.g: row.s for row in with_exact_sum(parts, "_s", "s").collect()}
    assert staged == {row.g: row.s for row in exact_sum(df).collect()}
    want = {g: math.fsum(x for h, x in rows if h == g and x is not None) for g in staged}
    assert staged == want | {1000: None}

    many = spark.range(1_000_000).select("id", (F.col("id") / F.lit(7.0)).alias("x"))
    began = time.monotonic()
    with_exact_sum(many.groupBy("id").agg(*exact_sum_parts(F.col("x"), "_s")), "_s", "s").write.format(
        "noop").mode("overwrite").save()
    assert time.monotonic() - began < 120
