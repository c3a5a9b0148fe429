"""Most frequent words: texts are shuffled whole, also where several rows share a key."""

import math

import pytest
from pyspark.sql import functions as F

from mlspark.operators import metrics
from mlspark.operators.features import tfidf_l2
from mlspark.session import written


def test_words_are_not_shuffled(spark):
    rows = [(1, ["b", "a", "b", "c"]), (1, ["a", "d", "a"]), (2, ["x", "y", "x", "y", "z"]), (3, []), (4, None), (None, ["q", "q", "p"])]
    top = metrics.top_terms(spark.createDataFrame(rows, "k long, tokens array<string>"), "k", "tokens", 2)
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.index("Generate") < plan.index("Exchange hashpartitioning")  # printed from the end to the start
    assert {(r.k, r.term, r.tf, r["rank"]) for r in top.collect()} == {
        (1, "a", 3, 1), (1, "b", 2, 2), (2, "x", 2, 1), (2, "y", 2, 2), (None, "q", 2, 1), (None, "p", 1, 2),
    }


def test_weights_shuffle_words_twice_at_most(spark):
    """Words go to their term and back to their text, never a third time; texts without a key have no weight."""
    texts = [(1, "red red blue"), (2, "blue green"), (2, "green"), (None, "blue red"), (3, "")]
    docs = spark.createDataFrame(texts, "id int, text string").select("id", F.split("text", " ").alias("tokens"))
    bag = written(docs.select("id", F.explode("tokens").alias("term")).groupBy("id", "term").agg(F.count(F.lit(1)).alias("tf")), "bag")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = tfidf_l2(bag, "id", "term", "tf", F.lit(4))
        plan = out._jdf.queryExecution().executedPlan().toString()
        rows = {(r["id"], r["term"]): r["weight"] for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert plan.count("Exchange hashpartitioning(id") == 1
    assert set(rows) == {(1, "red"), (1, "blue"), (2, "blue"), (2, "green"), (3, "")}
    idf = {"red": math.log(5 / 3) + 1, "blue": math.log(5 / 4) + 1, "green": math.log(5 / 2) + 1}
    length = math.hypot(2 * idf["red"], idf["blue"])
    assert rows[1, "red"] == pytest.approx(2 * idf["red"] / length) and rows[1, "blue"] == pytest.approx(idf["blue"] / length)
    assert rows[3, ""] == 1.0
