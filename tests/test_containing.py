"""Outer intervals of very different lengths, and what is spread for them."""

import random

from tidemark.functions.rangejoin import points_by_length
from tidemark.operators import intervals as I


def _lists(spark):
    rnd = random.Random(12)
    outer = [("a", s, s + rnd.choice([0, 1, 3, 4, 16, 17, 900, 4**9, 5**15])) for s in (rnd.randrange(-3000, 3000) for _ in range(150))]
    outer += [(None, 1, 5), ("a", None, 5), ("b", 3, 9), ("b", 3, 9)]
    inner = [("a", s, s + rnd.choice([0, 2, 40])) for s in (rnd.randrange(-5000, 5000) for _ in range(300))] + [(None, 2, 3), ("b", 4, 5), ("b", 4, 5)]
    return outer, inner, *(spark.createDataFrame(x, "k string, start long, stop long") for x in (outer, inner))


def test_containing_match(spark):
    outer, inner, o, i = _lists(spark)
    want = set()
    for k, a, b in set(outer):
        found = [x for x in set(inner) if k is not None and a is not None and x[0] == k and x[1] >= a - 2 and x[2] <= b + 2]
        want.add((k, a, b, len(found), *(found[0][1:] if len(found) == 1 else (None, None))))
    made = [tuple(r) for r in I.containing_match(o, i, ["k"], 2).collect()]
    assert set(made) == want and len(made) == len(want)


def test_long_intervals_are_in_two_buckets(spark):
    """An interval of thirty years beside one of a day: rows to be joined do not grow with length."""
    day = I.DAY
    o = spark.createDataFrame([("a", 0, 11_000 * day), ("a", 5 * day, 6 * day)], "k string, start long, stop long")
    plan = points_by_length(o.selectExpr("k", "start as s"), o, ["k"], "s")._jdf.queryExecution().optimizedPlan().toString()
    assert "sequence(" not in plan
    whole = I.containing_match(o, o, ["k"], 0)._jdf.queryExecution().optimizedPlan().toString()
    assert "sequence(" not in whole
