"""Aggregates and evaluation metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mlspark.operators.windows import topn_per_group
from mlspark.plans.ordered import null_safe_join, running_sums

N = F.lit


def describe_table(df: DataFrame, distinct: Sequence[str], non_null: Sequence[str]) -> DataFrame:
    """One row: row count, distinct counts and non-missing counts."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.countDistinct(c).alias(f"n_distinct_{c}") for c in distinct],
        *[F.count(c).alias(f"n_{c}") for c in non_null],
    )


def class_counts(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def group_effect(df: DataFrame, treatment: str, outcome: str) -> DataFrame:
    """Mean outcome per arm and their difference, in one pass."""
    treated = F.avg(F.when(F.col(treatment) == 1, F.col(outcome)))
    control = F.avg(F.when(F.col(treatment) == 0, F.col(outcome)))
    return df.agg(treated.alias("mean_treated"), control.alias("mean_control"), (treated - control).alias("effect"))


def regression_metrics(df: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """MAE, MSE, RMSE, R2 and MAPE (percent, over non-zero actuals; zero actuals are counted)."""
    y, e = F.col(actual), F.col(actual) - F.col(predicted)
    mse = F.avg(e * e)
    return df.groupBy(*by).agg(
        F.avg(F.abs(e)).alias("mae"),
        mse.alias("mse"),
        F.sqrt(mse).alias("rmse"),
        (1 - F.sum(e * e) / F.nullif(F.var_pop(y) * F.count(y), F.lit(0.0))).alias("r2"),
        (F.avg(F.when(y != 0, F.abs(e / y))) * 100).alias("mape"),
        F.count(F.when(y == 0, 1)).alias("n_zero_actual"),
        F.count(F.lit(1)).alias("n"),
    )


def confusion_matrix(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by, label, prediction).agg(F.count(F.lit(1)).alias("n"))


def accuracy(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(F.avg((F.col(label) == F.col(prediction)).cast("int")).alias("accuracy"))


def ratio(a: Column, b: Column) -> Column:
    return F.when(b == 0, F.lit(0.0)).otherwise(a / b)


def class_name(df: DataFrame, col: str) -> Column:
    """The class as text, the same for 1 and 1.0: estimators predict doubles for integer labels."""
    c = F.col(col)
    if isinstance(df.schema[col].dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
        return F.when(c == F.floor(c), c.cast("long").cast("string")).otherwise(c.cast("string"))
    return c.cast("string")


def classification_report(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """Per class precision, recall, F1 and support, then accuracy, macro and weighted averages.

    Everything after the first aggregate works on the confusion table, one row per class pair.
    """
    named = df.withColumn(label, class_name(df, label)).withColumn(prediction, class_name(df, prediction))
    cells = confusion_matrix(named, label, prediction, by)
    hit = F.when(F.col(label) == F.col(prediction), F.col("n")).otherwise(0)
    zero = F.lit(0).cast("long")
    sides = F.array(
        F.struct(F.col(label).alias("class"), F.col("n").alias("support"), zero.alias("predicted"), hit.alias("tp")),
        F.struct(F.col(prediction).alias("class"), zero.alias("support"), F.col("n").alias("predicted"), zero.alias("tp")),
    )
    per_class = (
        cells.select(*by, F.inline(sides))
        .groupBy(*by, "class")
        .agg(F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum("tp").alias("tp"))
        .withColumn("precision", ratio(F.col("tp"), F.col("predicted")))
        .withColumn("recall", ratio(F.col("tp"), F.col("support")))
        .withColumn("f1", ratio(2 * F.col("tp"), F.col("predicted") + F.col("support")))
    )
    measures = ["precision", "recall", "f1"]
    total = F.sum("support")
    share = F.sum("tp") / total
    summary = per_class.groupBy(*by).agg(
        F.array(
            F.struct(F.lit("accuracy").alias("class"), *[share.alias(m) for m in measures], total.alias("support")),
            F.struct(F.lit("macro avg").alias("class"), *[F.avg(m).alias(m) for m in measures], total.alias("support")),
            F.struct(
                F.lit("weighted avg").alias("class"),
                *[(F.sum(F.col(m) * F.col("support")) / total).alias(m) for m in measures],
                total.alias("support"),
            ),
        ).alias("rows")
    )
    columns = [*by, "class", *measures, "support"]
    return per_class.select(*columns).unionByName(summary.select(*by, F.inline("rows")).select(*columns))


def pr_curve(df: DataFrame, label: str, score: str) -> DataFrame:
    """Precision and recall at every distinct score, with the point before it in score order.

    Rows are first summed per score; the running totals use score buckets, so no task sees the whole
    curve.  The point before the first is recall 0, precision 1.
    """
    per_score = df.groupBy(score).agg(
        F.sum(F.col(label).cast("long")).alias("_pos"), F.count(F.lit(1)).alias("_all")
    )
    curve = running_sums(per_score, [], score, {"tp": F.col("_pos"), "flagged": F.col("_all")}, descending=True)
    positives = df.select(F.sum(F.col(label).cast("long"))).scalar()
    before_tp, before_flagged = F.col("tp") - F.col("_pos"), F.col("flagged") - F.col("_all")
    return curve.select(
        F.col(score).alias("threshold"),
        (F.col("tp") / F.col("flagged")).alias("precision"),
        (F.col("tp") / positives).alias("recall"),
        F.when(before_flagged == 0, F.lit(1.0)).otherwise(before_tp / F.nullif(before_flagged, F.lit(0))).alias("precision_before"),
        (before_tp / positives).alias("recall_before"),
    )


def pr_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Trapezoid area under the precision-recall points."""
    width = F.col("recall") - F.col("recall_before")
    return pr_curve(df, label, score).agg(
        F.sum(width * (F.col("precision") + F.col("precision_before")) / 2).alias("pr_auc")
    )


def precision_at_n(recommended: DataFrame, positives: DataFrame, n: int, user: str = "user_id", item: str = "item_id") -> DataFrame:
    """Hits among the n recommendations over n, averaged over users that have positives.

    ``recommended`` holds at most n rows per user; a user without any scores 0.
    """
    wanted = positives.select(user, item).distinct()
    hits = recommended.select(user, item).join(wanted, [user, item], "left_semi").groupBy(user).agg(F.count(F.lit(1)).alias("hits"))
    users = wanted.select(user).distinct()
    return (
        users.join(hits, user, "left")
        .agg((F.avg(F.coalesce(F.col("hits"), F.lit(0)) / F.lit(n))).alias("precision"), F.count(F.lit(1)).alias("n_users"))
    )


def quantile_threshold(df: DataFrame, col: str, p: float, by: Sequence[str] = (), out: str = "threshold") -> DataFrame:
    """Exact percentile with linear interpolation, one row per group.

    Values are counted per distinct value, then located by running counts in value buckets, instead of
    holding all values in one aggregation buffer.
    """
    counted = df.filter(F.col(col).isNotNull()).groupBy(*by, col).agg(F.count(F.lit(1)).alias("_n"))
    ranked = running_sums(counted, by, col, {"_upto": F.col("_n")})
    sizes = counted.groupBy(*by).agg(((F.sum("_n") - 1) * F.lit(float(p))).alias("_rank"))
    placed = null_safe_join(ranked, sizes, by) if by else ranked.withColumn("_rank", sizes.scalar())
    at = F.min(F.when(F.col("_upto") > F.floor("_rank"), F.col(col)))
    above = F.min(F.when(F.col("_upto") > F.ceil("_rank"), F.col(col)))
    weight = F.max(F.col("_rank") - F.floor("_rank"))
    return placed.groupBy(*by).agg((at + (above - at) * weight).alias(out))


def best_by(df: DataFrame, name: str, metric: str, largest: bool = True, by: Sequence[str] = ()) -> DataFrame:
    """Name of the best row, the smallest name on ties."""
    sign = -F.col(metric) if largest else F.col(metric)
    return df.groupBy(*by).agg(
        F.min_by(name, F.struct(sign, F.col(name))).alias("best"), (F.max if largest else F.min)(metric).alias("best_value")
    )


def top_terms(df: DataFrame, key: str, tokens: str, n: int) -> DataFrame:
    """Most frequent words of each text, the first seen on ties.

    Texts are shuffled whole, by key, and opened after that: neither the count nor the rank shuffles words.
    """
    counted = (
        df.select(key, tokens).repartition(key).select(key, F.posexplode(tokens).alias("_at", "term"))
        .groupBy(key, "term")
        .agg(F.count(F.lit(1)).alias("tf"), F.min("_at").alias("first_at"))
    )
    return topn_per_group(counted, [key], "tf", n, ["first_at"])


def minmax_normalize(df: DataFrame, by: Sequence[str], score: str, out: str, epsilon: float = 1e-9) -> DataFrame:
    """(x - min) / (max - min + epsilon) inside each group; the ranges are aggregated, then joined."""
    ranges = df.groupBy(*by).agg(F.min(score).alias("_lo"), F.max(score).alias("_hi"))
    scaled = (F.col(score) - F.col("_lo")) / (F.col("_hi") - F.col("_lo") + F.lit(epsilon))
    return null_safe_join(df, ranges, by).select(*df.columns, scaled.alias(out))


def weighted_mean_score(df: DataFrame, by: Sequence[str], weight: str, value: str, out: str = "score") -> DataFrame:
    """Sum(weight * value) / sum(weight), only where the weights sum to more than 0."""
    return (
        df.groupBy(*by)
        .agg(F.sum(F.col(weight) * F.col(value)).alias("_num"), F.sum(weight).alias("_den"))
        .filter(F.col("_den") > 0)
        .select(*by, (F.col("_num") / F.col("_den")).alias(out))
    )


def mean_efficiency_filter(df: DataFrame, flagged: Column, efficiency: str, score: str, min_score: float = 2000) -> DataFrame:
    """Flagged rows above the mean efficiency of all rows and above a minimum score."""
    mean = df.select(F.avg(efficiency)).scalar()
    return df.filter(flagged & (F.col(efficiency) > mean) & (F.col(score) > min_score))


def fold_average(df: DataFrame, by: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    return df.groupBy(*by).agg(
        *[F.avg(m).alias(f"{m}_mean") for m in metrics], *[F.stddev_pop(m).alias(f"{m}_std") for m in metrics]
    )
