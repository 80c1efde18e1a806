"""More adapters from the driver's tables: claims, answers with metric versions, and broken text.

Like ``contract``, they give the operators input that grows with the driver's
tables; they are no operators themselves.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortcraft.operators.cohort import SCOPES
from cohortcraft.session import checkpoint_dir
from cohortcraft.sources.columnar import driver_table

# Fixed order of the generated claims' metrics; the last one is unknown.
CLAIMED = (
    ("portfolio_share_pct", "percentage"),
    ("segment_default_rate_pct", "percentage"),
    ("overall_default_rate_pct", "percentage"),
    ("segment_vs_overall_direction", "direction"),
    ("average_loan_amount_usd", "currency"),
    ("average_annual_income_usd", "currency"),
    ("grade_bc_share_pct", "percentage"),
    ("average_interest_rate_pct", "percentage"),
    ("median_loan_amount_usd", "currency"),
)
DIRECTIONS = ("below", "above", "equal")
KIND_BY_EVENT = {"click": "currency", "view": "percentage", "purchase": "currency", "error": "percentage"}
"""Rule by event type; other types have none."""
ORDER_COLUMNS = ("id", "status", "note", "price", "ordered")


def _nth(values: tuple[str, ...], at):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (at + 1).cast("int"))


def customer_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One claim per customer: metric by key, scope by nation (every scope for a fifth), values from the key and balance."""
    key, nation = F.col("c_custkey"), F.col("c_nationkey")
    kind = _nth(tuple(k for _, k in CLAIMED), key % len(CLAIMED))
    own = key % 4
    return driver_table(spark, sf_dir, "customer").select(
        key.alias("claim_id"),
        F.when(nation % 5 < len(SCOPES), _nth(tuple(s.scope_id for s in SCOPES), F.least(nation % 5, F.lit(len(SCOPES) - 1)))).alias("scope_id"),
        _nth(tuple(m for m, _ in CLAIMED), key % len(CLAIMED)).alias("metric"),
        kind.alias("kind"),
        F.when(kind == "percentage", (key * 7 % 400) / 4.0).when(kind == "currency", F.col("c_acctbal") * 25).alias("claimed_value"),
        F.when(kind == "direction", _nth(DIRECTIONS, nation % 3)).alias("claimed_text"),
        F.when(own > 0, F.when(kind == "currency", own * 0.25).otherwise(own * 5.0)).alias("tolerance"),
    )


def event_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as answers: the event type is the metric, the value the claim."""
    kind = F.create_map(*[F.lit(x) for pair in KIND_BY_EVENT.items() for x in pair])[F.col("event_type")]
    return driver_table(spark, sf_dir, "events").select(
        F.col("event_id").alias("answer_id"), "ts", F.col("event_type").alias("metric"), kind.alias("kind"), F.col("value").alias("claimed_value")
    )


def event_metric_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A version of every metric per day, in force from the next day on: the day's mean value."""
    day = F.to_date("ts")
    means = driver_table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("metric"), day.alias("day")).agg(F.avg("value").alias("actual_value"))
    return means.select("metric", F.date_add("day", 1).alias("valid_from"), "actual_value")


def next_orders(orders: DataFrame) -> DataFrame:
    """A later version of ``orders``: keys mod 101 = 7 gone, mod 103 = 9 repeated under new keys, mod 97 and 89 changed."""
    key = F.col("o_orderkey")
    kept = orders.where(key % 101 != 7).withColumns({
        "o_orderstatus": F.when(key % 97 == 1, "X").otherwise(F.col("o_orderstatus")),
        "o_orderpriority": F.when(key % 89 == 2, F.lit(None)).otherwise(F.col("o_orderpriority")),
    })
    return kept.unionByName(orders.where(key % 103 == 9).withColumn("o_orderkey", key + 10**12))


def orders_text(spark: SparkSession, sf_dir: str, broken: bool) -> str:
    """``orders`` as delimited text in the shared folder; returns the folder.

    Every seventh note is quoted, with a doubled quote, a separator and a line
    break in it. ``broken`` shortens records with key mod 11 = 3 and lengthens
    those with key mod 13 = 5 of the rest.
    """
    key = F.col("o_orderkey")
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    price = F.concat(F.floor(cents / 100).cast("string"), F.lit("."), F.lpad((cents % 100).cast("string"), 2, "0"))
    note = F.when(key % 7 == 0, F.concat(F.lit('"order ""'), key.cast("string"), F.lit('"",\nplaced"'))).otherwise(F.col("o_orderpriority"))
    fields = [key.cast("string"), F.col("o_orderstatus"), note, price, F.date_format("o_orderdate", "yyyy-MM-dd")]
    line = F.concat_ws(",", *fields)
    if broken:
        line = F.when(key % 11 == 3, F.concat_ws(",", *fields[:-1])).when(key % 13 == 5, F.concat_ws(",", *fields, F.lit("left over"))).otherwise(line)
    path = f"{checkpoint_dir(spark).rstrip('/')}/orders-text-{uuid.uuid4().hex}"
    driver_table(spark, sf_dir, "orders").select(line.alias("value")).write.text(path)
    return path
