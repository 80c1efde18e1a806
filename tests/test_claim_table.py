"""Claims as a table and the reconciled audit, against plain Python."""

import bisect
import datetime as dt
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from cohortcraft.operators import audit, claim_table

CLAIMS = "claim_id long, scope_id string, metric string, kind string, claimed_value double, claimed_text string, tolerance double"
VALUES = "scope_id string, scope_ok boolean, metric string, actual_value double, actual_text string"


def test_rules_by_kind(spark):
    values = spark.createDataFrame(
        [("s", True, "share", 48.0, None), ("s", True, "income", 1000.0, None), ("s", True, "zero", 0.0, None), ("s", True, "side", None, "below"),
         ("bad", False, "share", 48.0, None), ("s", True, "unknown value", None, None)], VALUES,
    )
    claims = spark.createDataFrame(
        [
            (1, "s", "share", "percentage", 48.25, None, None), (2, "s", "share", "percentage", 48.26, None, None),
            (3, "s", "share", "percentage", 50.0, None, 2.0), (4, "s", "income", "currency", 1010.0, None, None),
            (5, "s", "income", "currency", 1010.1, None, None), (6, "s", "zero", "currency", 0.0, None, None),
            (7, "s", "zero", "currency", 0.001, None, None), (8, "s", "side", "direction", None, "below", None),
            (9, "s", "side", "direction", None, "above", None), (10, None, "share", "percentage", 48.0, None, None),
            (11, "s", "nothing", "percentage", 1.0, None, None), (12, "elsewhere", "share", "percentage", 48.0, None, None),
            (13, "s", "share", "guess", 48.0, None, None), (14, "s", "unknown value", "percentage", 1.0, None, None),
            (15, "s", "share", "percentage", None, None, None),
        ],
        CLAIMS,
    )
    found = sorted((r["claim_id"], r["scope_id"], r["status"]) for r in claim_table.check_claims(claims, values).collect())
    assert found == [
        (1, "s", "PASS"), (2, "s", "FAIL"), (3, "s", "PASS"), (4, "s", "PASS"), (5, "s", "FAIL"), (6, "s", "PASS"), (7, "s", "FAIL"),
        (8, "s", "PASS"), (9, "s", "FAIL"), (10, "bad", "FAIL"), (10, "s", "PASS"), (11, "s", "UNKNOWN"), (12, "elsewhere", "UNKNOWN"),
        (13, "s", "UNKNOWN"), (14, "s", "FAIL"), (15, "s", "FAIL"),
    ]


@pytest.fixture(scope="module")
def answers(spark):
    rng = random.Random(7)
    start = dt.datetime(2024, 1, 3)
    rows = [(i, start + dt.timedelta(minutes=rng.randrange(60 * 24 * 40)), rng.choice("abc"), "percentage", rng.uniform(0, 10)) for i in range(3000)]
    return rows, spark.createDataFrame(rows, "answer_id long, ts timestamp_ntz, metric string, kind string, claimed_value double")


def test_draw_is_exact_per_period(spark, answers):
    rows, df = answers
    drawn = audit.audit_draw(df, "answer_id", "ts", 20)
    weeks = {}
    for i, ts, *_ in rows:
        weeks.setdefault(ts.date() - dt.timedelta(days=ts.weekday()), []).append((hashlib.md5(f"{i}|42".encode()).hexdigest(), i))
    want = {(week, i) for week, ids in weeks.items() for _, i in sorted(ids)[:20]}
    assert {(r["audit_period"], r["answer_id"]) for r in drawn.collect()} == want
    assert audit.audit_draw(df, "answer_id", "ts", 10**6).count() == len(rows)
    plan = drawn._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan  # the limit holds before the shuffle


def test_as_of_takes_the_version_of_the_time(spark, answers):
    rows, df = answers
    rng = random.Random(8)
    versions = sorted({(m, dt.date(2024, 1, 1) + dt.timedelta(days=rng.randrange(3, 45))) for m in "ab" for _ in range(12)})
    table = spark.createDataFrame([(m, d, float(i)) for i, (m, d) in enumerate(versions)], "metric string, valid_from date, actual_value double")
    got = {r["answer_id"]: (r["valid_from"], r["actual_value"]) for r in audit.as_of(df, table, "metric", "ts", "valid_from", "actual_value").collect()}
    assert len(got) == len(rows)
    for i, ts, metric, *_ in rows:
        mine = [d for m, d in versions if m == metric]
        at = bisect.bisect_right([dt.datetime.combine(d, dt.time()) for d in mine], ts) - 1
        assert got[i] == ((mine[at], float(versions.index((metric, mine[at])))) if at >= 0 else (None, None))


def test_statuses(spark):
    ts = dt.datetime(2024, 1, 10)
    rows = [(1, ts, "m", "percentage", 5.2), (2, ts, "m", "percentage", 5.3), (3, ts, "m", None, 5.0), (4, dt.datetime(2024, 1, 1), "m", "percentage", 5.0),
            (5, ts, "none", "percentage", 5.0), (6, dt.datetime(2024, 1, 5), "m", "currency", 5.05)]
    df = spark.createDataFrame(rows, "answer_id long, ts timestamp_ntz, metric string, kind string, claimed_value double")
    versions = spark.createDataFrame([("m", dt.date(2024, 1, 5), 5.0)], "metric string, valid_from date, actual_value double")
    got = {r["answer_id"]: r["status"] for r in audit.reconciled_audit(df, versions, 10).collect()}
    assert got == {1: "PASS", 2: "FAIL", 3: "UNKNOWN", 4: "NO_VERSION", 5: "NO_VERSION", 6: "PASS"}
    empty = df.where(F.lit(False))
    assert audit.reconciled_audit(empty, versions, 10).count() == 0
