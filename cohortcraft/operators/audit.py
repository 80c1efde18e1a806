"""Recurring audit sample of answers (documented procedure).

A deterministic, distributed sample: each answer is kept when a hash of its
id and the seed falls under ``fraction``, computed per period, so reruns
select the same answers and no data passes through the driver. The
sampled answers are then checked with the same claim tolerances.

``audit_draw`` takes exactly k answers per period instead: the k least hashes,
found by a row limit per period that Spark already applies before the shuffle, so
a period's hot group never travels. ``as_of`` gives each answer the metric
version of its time, and ``reconciled_audit`` checks the drawn answers against
the versions with the rules of the claims.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortcraft.functions.metrics import round_to
from cohortcraft.operators.claim_table import holds


def _digest(id_col: str, seed: int) -> Column:
    return F.md5(F.concat_ws("|", F.col(id_col).cast("string"), F.lit(str(seed))))


def audit_sample(answers: DataFrame, id_col: str, ts_col: str, fraction: float, seed: int = 42,
                 period: str = "week") -> DataFrame:
    """Rows kept with probability ``fraction`` per answer, tagged with their period start."""
    if not 0.0 <= fraction <= 1.0:
        raise ValueError("fraction must be in [0, 1]")
    # 52 bits of an md5, so any engine repeats the draw
    u = F.conv(F.substring(_digest(id_col, seed), 1, 13), 16, 10).cast("double") / float(1 << 52)
    return answers.where(u < fraction).withColumn("audit_period", F.date_trunc(period, F.col(ts_col)).cast("date"))


def audit_draw(answers: DataFrame, id_col: str, ts_col: str, k: int, seed: int = 42, period: str = "week") -> DataFrame:
    """Exactly ``k`` answers of every period (all, if there are fewer), tagged with their period start.

    The draw depends on ids and seed alone; equal hashes go by id.
    """
    start = F.date_trunc(period, F.col(ts_col)).cast("date")
    least = Window.partitionBy("audit_period").orderBy("_digest", id_col)
    drawn = answers.withColumns({"audit_period": start, "_digest": _digest(id_col, seed)})
    return drawn.withColumn("_place", F.row_number().over(least)).where(F.col("_place") <= k).drop("_digest", "_place")


def as_of(answers: DataFrame, versions: DataFrame, key: str, ts_col: str, valid_from: str, value: str) -> DataFrame:
    """``answers`` with ``value`` and ``valid_from`` of the latest version of their key at or before their time.

    Both are laid on one time line per key; a version precedes the answers of
    its own instant. Work is linear in answers plus versions: no pair of them is
    formed. Answers before the first version get NULL.
    """
    own = [c for c in answers.columns if c not in (valid_from, value)]
    line = answers.select(*own, F.lit(None).cast(dict(versions.dtypes)[value]).alias(value),
                          F.lit(None).cast(dict(versions.dtypes)[valid_from]).alias(valid_from), F.col(ts_col).alias("_at"), F.lit(1).alias("_side"))
    marks = versions.select(key, value, valid_from, F.col(valid_from).cast(dict(answers.dtypes)[ts_col]).alias("_at"), F.lit(0).alias("_side"))
    both = line.unionByName(marks, allowMissingColumns=True)
    until = Window.partitionBy(key).orderBy("_at", "_side").rowsBetween(Window.unboundedPreceding, 0)
    version = F.last(F.when(F.col("_side") == 0, F.struct(value, valid_from)), ignorenulls=True).over(until)
    return both.withColumn("_v", version).where(F.col("_side") == 1).select(
        *own, F.col(f"_v.{value}").alias(value), F.col(f"_v.{valid_from}").alias(valid_from)
    )


def reconciled_audit(answers: DataFrame, versions: DataFrame, k: int, seed: int = 42, period: str = "week") -> DataFrame:
    """One row per drawn answer with the metric version of its time and a status.

    ``answers``: answer_id, ts, metric, kind, claimed_value; ``versions``:
    metric, valid_from, actual_value. ``NO_VERSION`` marks an answer from before
    the metric's first version, ``UNKNOWN`` one of an unknown kind.
    """
    drawn = audit_draw(answers, "answer_id", "ts", k, seed, period)
    matched = as_of(drawn, versions, "metric", "ts", "valid_from", "actual_value")
    none = F.lit(None)
    ok = holds(F.col("kind"), F.col("claimed_value"), F.col("actual_value"), none.cast("double"), none.cast("string"), none.cast("string"))
    status = F.when(F.col("valid_from").isNull(), "NO_VERSION").when(ok.isNull(), "UNKNOWN").when(ok, "PASS").otherwise("FAIL")
    return matched.select(
        "answer_id", "ts", "audit_period", "metric", "kind", "claimed_value", "valid_from",
        round_to("actual_value", 4).alias("actual_value"), status.alias("status"),
    )
