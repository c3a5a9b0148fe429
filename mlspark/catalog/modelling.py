"""Feature preparation and models on the given tables."""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.pipeline import PipelineModel
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from mlspark.catalog import query
from mlspark.catalog.ordered import rounded
from mlspark.operators import features as X
from mlspark.operators import models as M
from mlspark.operators import tuning as U
from mlspark.operators.reshape import metrics_table
from mlspark.operators.sampling import split_random
from mlspark.plans.ordered import spread_hash
from mlspark.plans.views import CHURN, churn, table
from mlspark.session import scratch_path, written
from mlspark.sources.files import load_model, save_model


@query(
    "F1_standard_scale",
    """SELECT c_custkey, round((c_acctbal - (SELECT avg(c_acctbal) FROM customer)) / (SELECT stddev_pop(c_acctbal) FROM customer), 6) AS c_acctbal,
              round((c_nationkey - (SELECT avg(c_nationkey) FROM customer)) / (SELECT stddev_pop(c_nationkey) FROM customer), 6) AS c_nationkey FROM customer""",
)
def f1(spark, sf):
    rows = table(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_nationkey")
    return rounded(X.standard_scale(rows, ["c_acctbal", "c_nationkey"]), 6, "c_acctbal", "c_nationkey")


@query(
    "F2_minmax_scale",
    """WITH p AS (SELECT min(value) AS lo, max(value) AS hi FROM events WHERE event_type <> 'error')
       SELECT event_id, round((value - lo) / (hi - lo) * 2 - 1, 6) AS value FROM events, p""",
)
def f2(spark, sf):
    events = table(spark, sf, "events")
    normal = events.filter("event_type <> 'error'")
    return rounded(X.minmax_scale(events.select("event_id", "value"), ["value"], (-1.0, 1.0), fit_on=normal), 6, "value")


@query(
    "F3_one_hot_ignore_unknown",
    """SELECT o_orderkey, [CAST(o_orderstatus = 'F' AS DOUBLE), CAST(o_orderstatus = 'O' AS DOUBLE)] AS status FROM orders""",
)
def f3(spark, sf):
    orders = table(spark, sf, "orders")
    return X.one_hot_known(orders, "o_orderstatus", orders.filter("o_orderstatus <> 'P'"), "status").select("o_orderkey", "status")


@query(
    "F4_ordinal_encode",
    """SELECT o_orderkey, CAST(coalesce(list_position(['5-LOW', '4-NOT SPECIFIED', '3-MEDIUM', '2-HIGH'], o_orderpriority), 0) - 1 AS INT) AS priority FROM orders""",
)
def f4(spark, sf):
    order = ["5-LOW", "4-NOT SPECIFIED", "3-MEDIUM", "2-HIGH"]
    return table(spark, sf, "orders").select("o_orderkey", X.ordinal_encode("o_orderpriority", order).alias("priority"))


CHURN_PREP = M.ColumnPipeline(
    numeric=["tenure", "monthly_charges", "c_acctbal"],
    nominal=["contract"],
)


@query(
    "F5_column_pipeline",
    "WITH " + CHURN + """, g AS (SELECT *, CASE WHEN c_custkey % 9 <> 0 THEN tenure END AS t, CASE WHEN c_custkey % 8 <> 0 THEN contract END AS c FROM churn),
    m AS (SELECT avg(t) AS m, (SELECT c FROM g WHERE c IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS top FROM g),
    f AS (SELECT c_custkey, n_orders, coalesce(t, m) AS t, coalesce(c, top) AS c FROM g, m)
    SELECT c_custkey, [round((t - avg(t) OVER ()) / stddev_pop(t) OVER (), 5) + 0.0, CAST(c = 'AUTOMOBILE' AS DOUBLE), CAST(c = 'BUILDING' AS DOUBLE), CAST(c = 'FURNITURE' AS DOUBLE),
      CAST(c = 'HOUSEHOLD' AS DOUBLE), CAST(c = 'MACHINERY' AS DOUBLE),
      CASE c WHEN 'MACHINERY' THEN 0.0 WHEN 'BUILDING' THEN 1.0 ELSE -1.0 END, CAST(n_orders AS DOUBLE)] AS features FROM f""",
)
def f5(spark, sf):
    key = F.col("c_custkey")
    rows = churn(spark, sf).select(
        "c_custkey", "n_orders", F.when(key % 9 != 0, F.col("tenure")).alias("tenure"), F.when(key % 8 != 0, F.col("contract")).alias("contract")
    ).withColumn("grade", F.col("contract"))
    prep = M.ColumnPipeline(numeric=["tenure"], nominal=["contract"], ordinal={"grade": ["MACHINERY", "BUILDING"]}, passthrough=["n_orders"])
    out = prep.fit(rows).transform(rows)
    return out.select("c_custkey", F.transform(vector_to_array("features"), lambda v: F.round(v, 5) + 0.0).alias("features"))


@query(
    "F7_interactions",
    """SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_tax, round(l_quantity * l_discount, 6) AS l_quantity_x_l_discount,
              round(l_quantity * l_tax, 6) AS l_quantity_x_l_tax, round(l_discount * l_tax, 6) AS l_discount_x_l_tax FROM lineitem""",
)
def f7(spark, sf):
    cols = ["l_quantity", "l_discount", "l_tax"]
    out = X.interactions(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *cols), cols)
    return rounded(out, 6, *[c for c in out.columns if "_x_" in c])


DIMENSIONS = 64


def coordinates(spark, sf):
    e = F.col("embedding")
    return table(spark, sf, "embeddings").select("vec_id", "label", *[e[i].cast("double").alias(f"e{i}") for i in range(DIMENSIONS)])


@query("F8_geo_cluster")
def f8(spark, sf):
    rows = coordinates(spark, sf)
    cols = [f"e{i}" for i in range(DIMENSIONS)]
    model = M.geo_cluster(rows.filter("vec_id % 5 <> 0"), cols, 6)
    return model.transform(rows).select("vec_id", *cols, "geo_cluster")


@query("F9_pca")
def f9(spark, sf):
    rows = coordinates(spark, sf)
    cols = [f"e{i}" for i in range(DIMENSIONS)]
    model = M.fit_pca(rows, cols, 2)
    out = M.pca_restore(model, model.transform(rows), cols)
    return out.select("vec_id", vector_to_array("pca").alias("pca"), *[f"restored_{c}" for c in cols])


# ---- comparison ---------------------------------------------------------------------------------------


def quality_data(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", "n_chars")
    rows = table(spark, sf, "labels").join(docs, "doc_id").select(
        "doc_id",
        F.col("quality").alias("label"),
        F.col("n_chars").cast("double").alias("n_chars"),
        (F.length(F.regexp_replace("text", r"[^\p{L}]", "")) / F.greatest(F.length("text"), F.lit(1))).alias("letter_share"),
        F.regexp_count("text", F.lit("\n")).cast("double").alias("n_lines"),
        (F.regexp_count("text", F.lit("[0-9]")) / F.greatest(F.length("text"), F.lit(1))).alias("digit_share"),
    )
    cols = ["n_chars", "letter_share", "n_lines", "digit_share"]
    split = written(split_random(rows, "doc_id", 0.3, "label"), "quality")
    train, test = split.filter("part = 'train'"), split.filter("part = 'test'")
    prep = M.ColumnPipeline(numeric=cols).fit(train)
    return tuple(prep.transform(d).select("features", "label") for d in (train, test))


@query("M1_compare_classifiers")
def m1(spark, sf):
    split = written(split_random(table(spark, sf, "embeddings"), "vec_id", 0.3, "label"), "vectors")
    rows = split.select("part", "label", array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))
    vectors = (rows.filter("part = 'train'"), rows.filter("part = 'test'"), 10)
    scores = M.compare_classifiers({"vectors": vectors, "quality": (*quality_data(spark, sf), 2)})
    order = ["Logistic Regression", "Decision Tree", "Naive Bayes", "SVM", "Random Forest"]
    return metrics_table(scores, "dataset", "model", "accuracy", ["vectors", "quality"], order)


def price_rows(spark, sf):
    part = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_retailprice", F.col("p_size").cast("double").alias("p_size"))
    lines = table(spark, sf, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("row_id"), "l_partkey", "l_quantity", "l_discount", "l_tax", "l_extendedprice"
    )
    return lines.join(part, "l_partkey").drop("l_partkey")


PRICE_COLS = ["l_quantity", "l_discount", "l_tax", "p_retailprice", "p_size"]


@query("M2_compare_regressors")
def m2(spark, sf):
    rows = price_rows(spark, sf).withColumn("fold", F.pmod(spread_hash("row_id", 3), F.lit(5)))
    return M.compare_regressors(rows.filter("fold > 0"), rows.filter("fold = 0"), PRICE_COLS, "l_extendedprice")


@query(
    "M2_ols_one_feature",
    """SELECT round(regr_slope(l_extendedprice, l_quantity), 4) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept,
              round(regr_r2(l_extendedprice, l_quantity), 6) AS r2 FROM lineitem""",
)
def m2_ols(spark, sf):
    rows = table(spark, sf, "lineitem").select(array_to_vector(F.array("l_quantity")).alias("x"), F.col("l_extendedprice").alias("y"))
    model = LinearRegression(featuresCol="x", labelCol="y", solver="normal").fit(rows)
    return spark.range(1).select(
        F.round(F.lit(float(model.coefficients[0])), 4).alias("slope"),
        F.round(F.lit(float(model.intercept)), 4).alias("intercept"),
        F.round(F.lit(float(model.summary.r2)), 6).alias("r2"),
    )


@query(
    "M3_balanced_weights",
    """WITH n AS (SELECT toxic, count(*) AS n FROM labels GROUP BY 1)
       SELECT doc_id, l.toxic, round((SELECT sum(n) / count(*) FROM n) / n.n, 6) AS weight FROM labels l JOIN n ON n.toxic = l.toxic""",
)
def m3_weights(spark, sf):
    rows = table(spark, sf, "labels").select("doc_id", "toxic")
    return rounded(M.balanced_weights(rows, "toxic"), 6, "weight")


def churn_parts(spark, sf):
    split = written(split_random(churn(spark, sf), "c_custkey", 0.2, "churn"), "churn")
    return split.filter("part = 'train'"), split.filter("part = 'test'")


def report(model, test, label):
    from mlspark.operators.metrics import classification_report

    return classification_report(model.transform(test).withColumn("prediction", F.col("prediction").cast("int")), label, "prediction")


@query("M3_boosted_classifier")
def m3(spark, sf):
    train, test = churn_parts(spark, sf)
    plain = report(M.boosted_classifier(CHURN_PREP, train, "churn", False, maxIter=100, maxDepth=3), test, "churn")
    balanced = report(M.boosted_classifier(CHURN_PREP, train, "churn", True, maxIter=100, maxDepth=3), test, "churn")
    return plain.withColumn("balanced", F.lit(False)).unionByName(balanced.withColumn("balanced", F.lit(True)))


@query("M4_forest_classifier")
def m4(spark, sf):
    train, test = churn_parts(spark, sf)
    return report(M.forest_classifier(CHURN_PREP, train, "churn"), test, "churn")


PARALLEL = 4  # fits at once


def tuned(spark, sf):
    train, valid = churn_parts(spark, sf)
    prep = CHURN_PREP.fit(train)
    train, valid = (prep.transform(d).select("features", "churn") for d in (train, valid))
    trials = U.random_grid({"maxIter": (5, 15), "stepSize": (0.01, 0.3), "maxDepth": (3, 10)}, 16)

    def make(params):
        return GBTClassifier(featuresCol="features", labelCol="churn", seed=42, **params)

    return U.tune(train, valid, make, trials, "churn", parallelism=PARALLEL)


@query("M5_tune")
def m5(spark, sf):
    best, log = tuned(spark, sf)
    return U.best_trial(log).withColumn("best_depth", F.lit(best["maxDepth"]))


@query("M6_trial_log")
def m6(spark, sf):
    _, log = tuned(spark, sf)
    path = scratch_path(spark, "trials")
    U.append_trial_log(log, path)
    return spark.read.schema(log.schema).parquet(path)


class Above:
    """An estimator without training: class 1, as a double, where a column exceeds a bound."""

    def __init__(self, column: str, bound: float) -> None:
        self.column, self.bound = column, bound

    def fit(self, _):
        return self

    def transform(self, df):
        return df.withColumn("prediction", (F.col(self.column) > self.bound).cast("double"))


@query(
    "M6_trial_metrics",
    """WITH t AS (SELECT unnest([10, 25, 40, 60]) AS bound), s AS (
      SELECT bound, sum(CASE WHEN l_quantity > bound AND l_returnflag = 'R' THEN 1 ELSE 0 END) AS tp,
        sum(CASE WHEN l_quantity > bound THEN 1 ELSE 0 END) AS predicted, sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS support
      FROM lineitem, t GROUP BY bound)
    SELECT CAST(bound AS VARCHAR) AS bound, CASE WHEN predicted = 0 THEN 0.0 ELSE round(CAST(tp AS DOUBLE) / predicted, 9) END AS precision,
      round(CAST(tp AS DOUBLE) / support, 9) AS recall, round(2.0 * tp / (predicted + support), 9) AS f1,
      round(CASE WHEN CAST(tp AS DOUBLE) / support >= 0.1 THEN 2.0 * tp / (predicted + support) ELSE CAST(tp AS DOUBLE) / support - 1 END, 9) AS score FROM s""",
)
def m6_metrics(spark, sf):
    """The tuner's figures for an integer label and double predictions, which SQL can state for fixed rules."""
    rows = table(spark, sf, "lineitem").select("l_quantity", (F.col("l_returnflag") == "R").cast("int").alias("label"))
    _, log = U.tune(rows, rows, lambda params: Above("l_quantity", params["bound"]), [{"bound": b} for b in (10, 25, 40, 60)], "label")
    figures = [F.round(c, 9).alias(c) for c in ("precision", "recall", "f1", "score")]
    return log.select(F.col("params")["bound"].alias("bound"), *figures)


@query("M7_cross_validate")
def m7(spark, sf):
    rows = price_rows(spark, sf)
    pairs = ["l_quantity", "p_retailprice", "l_discount"]

    def fit(train):
        clusters = M.geo_cluster(train, ["p_size", "p_retailprice"], 6)
        crossed = X.interactions(clusters.transform(train), pairs)
        cols = [*PRICE_COLS, "geo_cluster", *[c for c in crossed.columns if "_x_" in c]]
        assemble = VectorAssembler(inputCols=cols, outputCol="features")
        model = GBTRegressor(featuresCol="features", labelCol="l_extendedprice", maxIter=20, maxDepth=4, seed=42).fit(assemble.transform(crossed))
        return lambda held_out: model.transform(assemble.transform(X.interactions(clusters.transform(held_out), pairs)))

    folds = U.cross_validate(rows, "row_id", "l_extendedprice", fit, 5, parallelism=PARALLEL)
    return folds.agg(F.avg("mse").alias("mse_mean"), F.stddev_pop("mse").alias("mse_std"))


@query("M8_importance_table")
def m8(spark, sf):
    train, _ = churn_parts(spark, sf)
    prep = PipelineModel(CHURN_PREP.stages(train))
    names = prep.stages[-1].getInputCols()
    data = prep.transform(train)
    forest = M.forest_classifier(CHURN_PREP, train, "churn").stages[-1]
    linear = LogisticRegression(featuresCol="features", labelCol="churn").fit(data)
    importance = M.importance_table(spark, forest, names).select(F.lit("importance").alias("kind"), "feature", F.col("importance").alias("value"))
    coefficients = M.coef_table(spark, linear, names).select(F.lit("coefficient").alias("kind"), "feature", F.col("coefficient").alias("value"))
    return importance.unionByName(coefficients)


@query(
    "M9_linear_contributions",
    """WITH m AS (SELECT regr_slope(l_extendedprice, l_quantity) AS b, avg(l_quantity) AS x FROM lineitem)
       SELECT l_orderkey * 10 + l_linenumber AS row_id, round(b * (l_quantity - x), 2) AS shap_l_quantity FROM lineitem, m""",
)
def m9_linear(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("row_id"), "l_quantity", F.col("l_extendedprice").alias("y"),
        array_to_vector(F.array("l_quantity")).alias("x"),
    )
    model = LinearRegression(featuresCol="x", labelCol="y", solver="normal").fit(rows)
    mean = rows.agg(F.avg("l_quantity")).first()[0]
    out = M.linear_contributions(rows, "row_id", {"l_quantity": model.coefficients[0]}, {"l_quantity": mean})
    return rounded(out, 2, "shap_l_quantity")


@query("M9_shapley_contributions")
def m9(spark, sf):
    # line numbers repeat, so rows get their own id, fixed by writing them
    rows = written(price_rows(spark, sf).withColumn("row_id", F.monotonically_increasing_id()), "prices")
    assemble = VectorAssembler(inputCols=PRICE_COLS, outputCol="features")
    model = GBTRegressor(featuresCol="features", labelCol="l_extendedprice", maxIter=5, maxDepth=4, seed=42).fit(assemble.transform(rows))
    means = rows.agg(*[F.avg(c).alias(c) for c in PRICE_COLS]).first().asDict()
    return M.shapley_contributions(rows, "row_id", PRICE_COLS, means, lambda d: model.transform(assemble.transform(d)), orders=2)


@query("M11_promote_if")
def m11(spark, sf):
    train, test = churn_parts(spark, sf)
    model = M.forest_classifier(CHURN_PREP, train, "churn")
    scores = written(report(model, test, "churn"), "report")
    path = scratch_path(spark, "production")
    return scores.filter("class = '0'").withColumn("promoted", F.lit(M.promote_if(model, scores, path)))


@query("M12_train_pipeline")
def m12(spark, sf):
    rows = churn(spark, sf).select("c_custkey", "tenure", "monthly_charges", "c_acctbal", "n_orders", "churn")
    return M.train_pipeline(rows, "c_custkey", ["tenure", "monthly_charges", "c_acctbal", "n_orders"], "churn", scratch_path(spark, "pipeline"))


@query("I12_save_load_model")
def i12(spark, sf):
    train, test = churn_parts(spark, sf)
    path = scratch_path(spark, "model")
    save_model(CHURN_PREP.fit(train, LogisticRegression(featuresCol="features", labelCol="churn")), path)
    return load_model(path).transform(test).select("c_custkey", "churn", "prediction", vector_to_array("probability")[1].alias("probability"))
