import duckdb
import pandas as pd
from pyspark.sql import functions as F

from cohortcraft.llm import quality_rules as rules
from cohortcraft.llm.sql import ORACLE

TEXTS = [
    None, "", " \t\n", "one", "a b c a b c", "der " * 60, "the cat sat on the mat and the dog of the house " * 3 + "\n" + "x y\nx y\n \n \nx y",
    "the of and to a in is that " * 9, "WORD!! " * 80, "é ü ß # * $ % & | < > " * 30, "a\x1cb c\x0bd", "the " + " ".join(f"w{k} of" for k in range(200)),
]


def test_equals_sql(spark, docs_of):
    docs = docs_of([(k, t) for k, t in enumerate(TEXTS)] + [(3, "one"), (None, "the of")])
    got = rules.quality_rules(docs).select("doc_id", *rules.MEASURES, "base_failed", "kept", "n_stop_words").toPandas()
    con = duckdb.connect()
    con.register("documents", docs.toPandas().astype({"doc_id": "Int64", "n_chars": "Int64"}))
    want = con.sql(ORACLE["op4_quality_rules"]).df()
    key = list(got.columns)
    order = lambda d: d[key].astype(str).replace({"<NA>": "nan", "nan": "nan"}).map(lambda x: x.removesuffix(".0")).sort_values(key).reset_index(drop=True)
    pd.testing.assert_frame_equal(order(got), order(want))


def test_long_text_uses_pairs(spark, docs_of, monkeypatch):
    docs = docs_of([(k, t) for k, t in enumerate(TEXTS)])
    want = {r.doc_id: r.n_repeat_words for r in rules.quality_rules(docs).collect()}
    monkeypatch.setattr(rules, "_POSITIONS", 4)  # texts of more words than fit the packed form
    monkeypatch.setattr(rules, "_POSITIONS", 4)
    got = {r.doc_id: r.n_repeat_words for r in rules.quality_rules(docs.where("doc_id > 4")).collect()}
    assert got == {k: v for k, v in want.items() if k > 4}


def test_no_python_no_shuffle(spark, docs_of):
    plan = rules.quality_rules(docs_of([(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_stage_returns_the_columns_as_they_were(spark, docs_of):
    good = "the cat of the house and the dog in the garden is on a " + " ".join(f"word{k}" for k in range(60))
    docs = docs_of([(1, good), (2, "short"), (3, None)]).withColumn("n_words", F.lit("own"))
    left = rules.without_rejected(docs)
    assert left.columns == docs.columns and [(r.doc_id, r.n_words) for r in left.collect()] == [(1, "own")]
    assert rules.without_rejected(docs.limit(0)).count() == 0
