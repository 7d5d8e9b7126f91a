"""The positional bound of the n-gram join, by all small cases in integers."""

from pyspark.sql import functions as F

from saletrace.llm import token_group_join as tg


def test_cap_is_the_largest_partner(spark):
    """A set of n with i tokens before the first common one has at most n - i
    common tokens: no larger partner than the cap can reach the threshold, and
    two late sets never can."""
    rows = spark.range(1, 61).selectExpr("id AS n", "explode(sequence(0L, id - 1)) AS i")
    caps = {(r.n, r.i): r.cap for r in rows.select(
        "n", "i", tg.partner_cap(F.col("n"), F.col("i")).alias("cap")).collect()}
    for (n, i), cap in caps.items():
        fits = [m for m in range(1, 90) if 100 * (n - i) >= tg.PERCENT * (n + m - (n - i))]
        assert max(fits, default=0) == max(cap, 0)
    late = [(n, cap) for (n, _), cap in caps.items() if cap < n]
    assert not any(m <= cap and n <= other for n, cap in late for m, other in late)
