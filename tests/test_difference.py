"""Keyed difference against plain Python, and what it leaves unread."""

import random

import pytest

from cohortcraft.operators import difference

SCHEMA = "k long, j string, a string, b double"


def plain(old, new):
    def by_key(rows):
        out = {}
        for r in rows:
            out.setdefault(r[:2], []).append(r[2:])
        return out

    left, right, found = by_key(old), by_key(new), set()
    text = lambda v: None if v is None else str(v)
    for key in set(left) | set(right):
        x, y = left.get(key, []), right.get(key, [])
        if len(x) > 1 or len(y) > 1:
            if sorted(x, key=repr) != sorted(y, key=repr):
                found.add((*key, "repeated", None, None, None))
        elif not y:
            found.add((*key, "dropped", None, None, None))
        elif not x:
            found.add((*key, "added", None, None, None))
        else:
            for name, u, v in zip("ab", x[0], y[0]):
                if u != v:
                    found.add((*key, "changed", name, text(u), text(v)))
    return found


@pytest.mark.parametrize("buckets", [1, 64])
def test_difference_equals_plain_python(spark, buckets):
    rng = random.Random(5)
    keys = [(i, rng.choice(["x", "y", None])) for i in range(400)] + [(None, None), (None, "x")]
    old = [(*k, rng.choice(["p", "q", None, ""]), rng.choice([1.5, 2.25, None])) for k in keys]
    new = [(*r[:2], rng.choice(["p", None]) if rng.random() < 0.1 else r[2], 9.5 if rng.random() < 0.1 else r[3]) for r in old if rng.random() > 0.1]
    new += [(1000 + i, "x", "n", 1.0) for i in range(20)]
    old += [(500, "r", "p", 1.0), (500, "r", "p", 1.0), (501, "r", "p", 1.0)]
    new += [(500, "r", "p", 1.0), (500, "r", "p", 1.0), (501, "r", "p", 1.0), (501, "r", "q", 1.0)]
    a, b = spark.createDataFrame(old, SCHEMA), spark.createDataFrame(new, SCHEMA).select("b", "a", "j", "k")
    rows = [tuple(r) for r in difference.difference(a, b, ["k", "j"], buckets).collect()]
    assert len(rows) == len(set(rows)) and set(rows) == plain(old, new)


def test_equal_versions_send_no_rows(spark):
    a = spark.range(5000).selectExpr("id AS k", "id * 2 AS v")
    b = a.repartition(7)
    assert difference.differing_buckets(a, b, ["k"]).count() == 0
    assert difference.difference(a, b, ["k"]).count() == 0
    c = b.selectExpr("k", "CASE WHEN k = 17 THEN -1 ELSE v END AS v")
    assert difference.differing_buckets(a, c, ["k"]).count() == 1
    assert [tuple(r) for r in difference.difference(a, c, ["k"]).collect()] == [(17, "changed", "v", "34", "-1")]


def test_columns_must_agree(spark):
    a = spark.range(3).selectExpr("id AS k", "1 AS v")
    with pytest.raises(ValueError, match="w"):
        difference.difference(a, a.withColumnRenamed("v", "w"), ["k"])


def test_keys_alone_and_empty_tables(spark):
    a = spark.range(5).withColumnRenamed("id", "k")
    assert {tuple(r)[:2] for r in difference.difference(a, a.where("k > 2"), ["k"]).collect()} == {(0, "dropped"), (1, "dropped"), (2, "dropped")}
    assert difference.difference(a.limit(0), a.limit(0), ["k"]).count() == 0
