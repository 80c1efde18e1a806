"""Document rounding against Python's own rule (exact binary value, ties to even)."""

import math
import random
import struct

import pytest
from pyspark.sql import functions as F

from cohortcraft.functions.metrics import half_even


@pytest.mark.parametrize("digits", [0, 2, 4])
def test_half_even_equals_the_documents_rule(spark, digits):
    rng = random.Random(digits)
    values = [None, 0.0, -0.0, 0.125, 0.375, -0.125, 2.675, 1.005, 0.5, 1.5, 2.5, -2.5, 1e15, 123456789012345.67, 5e-324, 1e300, -1e22, math.inf, -math.inf]
    values += [rng.randrange(10**9) / 10**rng.choice([2, 3, 5]) for _ in range(120_000)]  # printed decimals, many near ties
    values += [(2 * rng.randrange(10**6) + 1) / 2**rng.choice([1, 2, 3, 5]) for _ in range(60_000)]  # true ties
    values += [struct.unpack("d", struct.pack("Q", rng.getrandbits(64)))[0] for _ in range(60_000)]  # any double
    values += [rng.uniform(-1e6, 1e6) for _ in range(100_000)]
    values = [v for v in values if v is None or not math.isnan(v)]
    df = spark.createDataFrame([(v,) for v in values], "x double").select("x", half_even("x", digits).alias("y"))
    for x, y in df.collect():
        want = x if x is None or math.isinf(x) else round(x, digits)
        assert y == want or (abs(x) > 1e292 and y == x), (x, y, want)


def test_a_million_values(spark):
    """Against Python, batch by batch."""
    import pandas as pd

    def count(batches):
        for b in batches:
            wrong = sum(round(x, 4) != y for x, y in zip(b["x"], b["y"]))
            yield pd.DataFrame({"n": [len(b)], "wrong": [wrong]})

    rows = spark.range(1_000_000).select(((F.rand(3) - 0.5) * F.pow(F.lit(10.0), (F.col("id") % 9).cast("double"))).alias("x"))
    got = rows.select("x", half_even("x", 4).alias("y")).mapInPandas(count, "n long, wrong long").agg(F.sum("n"), F.sum("wrong")).first()
    assert tuple(got) == (1_000_000, 0)
