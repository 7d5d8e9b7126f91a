"""Joins on OR conditions against a nested loop over all pairs."""

import itertools

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from saletrace.operators.disjunctive import Alternative, disjunctive_join

val = st.sampled_from([0, 1, 2, None])
lefts = st.lists(st.tuples(val, val), max_size=6)
rights = st.lists(st.tuples(val, val), max_size=6)
links = st.lists(st.tuples(val, val), max_size=4)


def eq(x, y):
    return x is not None and x == y


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(lefts, rights, links, links)
def test_equals_the_nested_loop(spark, left, right, first, second):
    """Repeated rows keep their weight; pairs that meet several alternatives
    appear once; NULLs never meet."""
    def holds(l, r):
        return (eq(l[0], r[0]) and r[1] is not None and r[1] > 0
                or any(eq(l[0], a) and eq(r[1], b) for a, b in first)
                or eq(l[1], r[1])
                or (l[1] is not None and l[1] < 2
                    and any(eq(l[1], a) and eq(r[0], b) for a, b in second)))
    schema = "%s int, %s int"
    ldf = spark.createDataFrame(left, schema % ("a", "b"))
    rdf = spark.createDataFrame(right, schema % ("c", "d"))
    one, two = (spark.createDataFrame(x, schema % ("p", "q")) for x in (first, second))
    alternatives = [Alternative([("a", "c")], right="d > 0"),
                    Alternative([("a", "p")], through=one, to=[("q", "d")]),
                    Alternative([("b", "d")]),
                    Alternative([("b", "p")], left="b < 2", through=two, to=[("q", "c")])]
    pairs = [l + r for l, r in itertools.product(left, right) if holds(l, r)]
    alone = [l + (None, None) for l in left if not any(holds(l, r) for r in right)]
    inner = disjunctive_join(ldf, rdf, alternatives)
    assert sorted(map(tuple, inner.collect()), key=str) == sorted(pairs, key=str)
    outer = disjunctive_join(ldf, rdf, alternatives, "left", hot_rows=None)
    assert sorted(map(tuple, outer.collect()), key=str) == sorted(pairs + alone, key=str)


def test_no_nested_loop(spark):
    ldf = spark.createDataFrame([(1, 2)], "a int, b int")
    rdf = spark.createDataFrame([(1, 2)], "c int, d int")
    plan = disjunctive_join(ldf, rdf, [Alternative([("a", "c")]), Alternative([("b", "d")])], "left")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in text and "Cartesian" not in text
