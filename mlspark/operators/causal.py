"""Treatment effects: plain difference, propensity scores, nearest-score matching."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mlspark.operators.joins import nearest_join
from mlspark.operators.metrics import group_effect

naive_effect = group_effect


def propensity_scores(df: DataFrame, features: Sequence[str], treatment: str, out: str = "propensity_score") -> DataFrame:
    """P(treated) by logistic regression with the usual L2 penalty of strength C = 1.

    That objective is the sum of losses plus half the squared weights; Spark minimises the mean loss,
    so the penalty is 1/n.
    """
    n = df.count()
    model = Pipeline(
        stages=[
            VectorAssembler(inputCols=list(features), outputCol="_x"),
            LogisticRegression(featuresCol="_x", labelCol=treatment, standardization=False, regParam=1.0 / n, maxIter=200, tol=1e-8),
        ]
    ).fit(df)
    return model.transform(df).select(*df.columns, vector_to_array("probability")[1].alias(out))


def match_pairs(df: DataFrame, row_id: str, treatment: str, score: str) -> DataFrame:
    """Nearest control per treated row, with replacement and without a caliper."""
    treated, control = df.filter(F.col(treatment) == 1), df.filter(F.col(treatment) == 0)
    return nearest_join(treated.select(row_id, score), control.select(row_id, score), score, row_id, row_id)


def psm_effect(df: DataFrame, row_id: str, treatment: str, score: str, outcome: str) -> DataFrame:
    """Mean outcome of treated rows, of their matches, and the difference: the effect on the treated."""
    pairs = match_pairs(df, row_id, treatment, score)
    mine = pairs.join(df.select(row_id, F.col(outcome).alias("_mine")), row_id)
    theirs = df.select(F.col(row_id).alias(f"matched_{row_id}"), F.col(outcome).alias("_theirs"))
    both = mine.join(theirs, f"matched_{row_id}")
    return both.agg(
        F.avg(F.col("_mine") - F.col("_theirs")).alias("effect"),
        F.avg("_mine").alias("mean_treated"),
        F.avg("_theirs").alias("mean_matched"),
        F.count(F.lit(1)).alias("n_pairs"),
    )
