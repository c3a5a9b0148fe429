"""Models: comparison, explanation and the gated training pipeline."""

from __future__ import annotations

import random
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    NaiveBayes,
    OneVsRest,
    RandomForestClassifier,
)
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA, OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import (
    DecisionTreeRegressor,
    GBTRegressor,
    LinearRegression,
    RandomForestRegressor,
)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mlspark.operators.clean import categories, most_frequent, require_columns
from mlspark.operators.metrics import accuracy, classification_report, regression_metrics
from mlspark.operators.sampling import split_random
from mlspark.session import written


# ---- column pipeline --------------------------------------------------------------------------------


def _quoted(value) -> str:
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'" if isinstance(value, str) else repr(value)


@dataclass(frozen=True)
class ColumnPipeline:
    """Per-type column treatment, learned from one table and saved with the model.

    Numbers: mean for missing, then z-score with population deviation.  Nominal: most frequent for
    missing, then one indicator per category, unseen ones all 0.  Ordinal: most frequent for missing,
    then the place in the given order, -1 for unseen.  ``passthrough`` columns are taken as they are.
    ``sparse`` keeps the nominal categories in an index saved with the model, for columns of many values;
    otherwise each category is an expression.  Both give the same vector.
    """

    numeric: Sequence[str] = ()
    nominal: Sequence[str] = ()
    ordinal: Mapping[str, Sequence[str]] = field(default_factory=dict)
    passthrough: Sequence[str] = ()
    output: str = "features"
    sparse: bool = False

    def stages(self, df: DataFrame) -> list[Transformer]:
        """Learned SQL projection and vector assembly; what reaches the driver is one row of statistics
        and the category lists."""
        exprs: list[tuple[str, str]] = []
        if self.numeric:
            n = F.count(F.lit(1))
            row = df.agg(
                *[F.avg(c).alias(f"m_{c}") for c in self.numeric],
                # filling with the mean leaves the squared deviations and raises the row count
                *[F.sqrt(F.var_pop(c) * F.count(c) / n).alias(f"s_{c}") for c in self.numeric],
            ).first()
            for c in self.numeric:
                mean, std = row[f"m_{c}"], row[f"s_{c}"] or 1.0
                exprs.append((f"num_{c}", f"(coalesce(CAST(`{c}` AS DOUBLE), {mean!r}D) - {mean!r}D) / {std!r}D"))
        fill = most_frequent(df, [*self.nominal, *self.ordinal])
        wide = list(self.nominal) if self.sparse else []
        known = categories(df, [c for c in self.nominal if c not in wide])
        for c in wide:
            exprs.append((f"str_{c}", f"CAST(coalesce(`{c}`, {_quoted(fill[c])}) AS STRING)"))
        for c in known:
            filled = f"coalesce(`{c}`, {_quoted(fill[c])})"
            for at, value in enumerate(known[c]):
                exprs.append((f"nom_{c}_{at}", f"CASE WHEN {filled} = {_quoted(value)} THEN 1D ELSE 0D END"))
        for c, order in self.ordinal.items():
            filled = f"coalesce(`{c}`, {_quoted(fill[c])})"
            cases = " ".join(f"WHEN {_quoted(v)} THEN {float(at)!r}D" for at, v in enumerate(order))
            exprs.append((f"ord_{c}", f"CASE {filled} {cases} ELSE -1D END"))
        statement = "SELECT *, " + ", ".join(f"{e} AS `{name}`" for name, e in exprs) + " FROM __THIS__"
        names = [f"nom_{name[4:]}" if name[4:] in wide and name.startswith("str_") else name for name, _ in exprs]
        project = [SQLTransformer(statement=statement)] if exprs else []
        if wide:
            # an index that is saved with the model, and sparse vectors; unseen ones are all 0
            texts, places, vectors = ([f"{kind}_{c}" for c in wide] for kind in ("str", "idx", "nom"))
            indexer = StringIndexer(inputCols=texts, outputCols=places, stringOrderType="alphabetAsc", handleInvalid="keep")
            index = indexer.fit(project[0].transform(df))
            # the index keeps one place more, for unseen values, which the encoder drops
            encoder = OneHotEncoder(inputCols=places, outputCols=vectors, dropLast=True)
            project += [index, encoder.fit(index.transform(project[0].transform(df)))]
        return [*project, VectorAssembler(inputCols=[*names, *self.passthrough], outputCol=self.output)]

    def fit(self, df: DataFrame, estimator=None) -> PipelineModel:
        """Pipeline of the column treatment and, when given, a fitted estimator."""
        prepared = self.stages(df)
        if estimator is None:
            return PipelineModel(prepared)
        return PipelineModel([*prepared, estimator.fit(PipelineModel(prepared).transform(df))])


# ---- feature models ----------------------------------------------------------------------------------


def geo_cluster(train: DataFrame, cols: Sequence[str], k: int = 6, out: str = "geo_cluster") -> PipelineModel:
    """Cluster number from a few columns; learned on the training table only."""
    assemble = VectorAssembler(inputCols=list(cols), outputCol="_geo")
    return Pipeline(stages=[assemble, KMeans(k=k, seed=42, featuresCol="_geo", predictionCol=out)]).fit(train)


def fit_pca(df: DataFrame, cols: Sequence[str], k: int = 2) -> PipelineModel:
    """Population z-scores, then the leading k directions as ``pca``."""
    scale = ColumnPipeline(numeric=list(cols), output="_scaled")
    prepared = scale.stages(df)
    scaled = PipelineModel(prepared).transform(df)
    return PipelineModel([*prepared, PCA(k=k, inputCol="_scaled", outputCol="pca").fit(scaled)])


def pca_restore(model: PipelineModel, df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Maps the ``pca`` coordinates back to scaled columns, one expression per column."""
    directions = model.stages[-1].pc.toArray()
    p = vector_to_array("pca")
    return df.select(
        *df.columns,
        *[sum((p[j] * F.lit(float(directions[i, j])) for j in range(directions.shape[1])), F.lit(0.0)).alias(f"restored_{c}") for i, c in enumerate(cols)],
    )


# ---- comparison ----------------------------------------------------------------------------------------


def classifiers(features: str, label: str, classes: int) -> dict:
    """Tree depth 5, ten trees of depth 5."""
    common = {"featuresCol": features, "labelCol": label}
    margin = LinearSVC(maxIter=50, regParam=0.01, **common)
    return {
        "Logistic Regression": LogisticRegression(maxIter=100, regParam=1e-3, **common),
        "Decision Tree": DecisionTreeClassifier(maxDepth=5, seed=42, **common),
        "Naive Bayes": NaiveBayes(modelType="gaussian", **common),
        "SVM": margin if classes == 2 else OneVsRest(classifier=margin, parallelism=4, **common),
        "Random Forest": RandomForestClassifier(numTrees=10, maxDepth=5, seed=42, **common),
    }


def compare_classifiers(datasets: Mapping[str, tuple[DataFrame, DataFrame, int]], features: str = "features", label: str = "label") -> DataFrame:
    """(dataset, model, accuracy) for every data set and model; a data set is (train, test, classes)."""
    out = None
    for name, (train, test, classes) in datasets.items():
        train, test = written(train, "train"), written(test, "test")
        for model_name, estimator in classifiers(features, label, classes).items():
            scored = estimator.fit(train).transform(test)
            row = accuracy(scored, label, "prediction").select(F.lit(name).alias("dataset"), F.lit(model_name).alias("model"), "accuracy")
            out = row if out is None else out.unionByName(row)
    return out


def regressors(raw: str, scaled: str, label: str, trees: int = 20) -> dict:
    def linear(**kw):
        return LinearRegression(featuresCol=scaled, labelCol=label, maxIter=100, **kw)

    def tree(kind, **kw):
        return kind(featuresCol=raw, labelCol=label, seed=42, **kw)

    return {
        "Linear Regression": linear(),
        "Ridge": linear(regParam=1e-3, elasticNetParam=0.0),
        "Lasso": linear(regParam=1.0, elasticNetParam=1.0),
        "Decision Tree": tree(DecisionTreeRegressor, maxDepth=10),
        "Random Forest": tree(RandomForestRegressor, numTrees=trees, maxDepth=8),
        "Gradient Boosting": tree(GBTRegressor, maxIter=trees, maxDepth=3),
    }


def compare_regressors(train: DataFrame, test: DataFrame, cols: Sequence[str], label: str, trees: int = 20) -> DataFrame:
    """(model, mse, r2); only the linear models see scaled columns, scaled by the training part."""
    scale = ColumnPipeline(numeric=list(cols), output="scaled")
    prepared = PipelineModel([*scale.stages(train), VectorAssembler(inputCols=list(cols), outputCol="raw")])
    train, test = (written(prepared.transform(d).select("raw", "scaled", label), "regression") for d in (train, test))
    out = None
    for name, estimator in regressors("raw", "scaled", label, trees).items():
        row = regression_metrics(estimator.fit(train).transform(test), label, "prediction").select(F.lit(name).alias("model"), "mse", "r2")
        out = row if out is None else out.unionByName(row)
    return out


# ---- classifiers with class weights -------------------------------------------------------------


def balanced_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """Row weight n / (classes * class size); the class table is one row per class."""
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    total = sizes.select(F.sum("_n") / F.count(F.lit(1))).scalar()
    weights = sizes.select(label, (total / F.col("_n")).alias(out))
    return df.join(weights, label)


def boosted_classifier(prep: ColumnPipeline, train: DataFrame, label: str, balanced: bool = True, **params) -> PipelineModel:
    """Boosted trees on the column pipeline, classes weighted to equal totals when ``balanced``."""
    data = balanced_weights(train, label) if balanced else train
    kw = {"weightCol": "weight"} if balanced else {}
    return prep.fit(data, GBTClassifier(featuresCol=prep.output, labelCol=label, seed=42, **kw, **params))


def forest_classifier(prep: ColumnPipeline, train: DataFrame, label: str, trees: int = 100, depth: int = 10) -> PipelineModel:
    return prep.fit(train, RandomForestClassifier(featuresCol=prep.output, labelCol=label, numTrees=trees, maxDepth=depth, seed=42))


# ---- explanation ------------------------------------------------------------------------------------------


def _named(spark: SparkSession, names: Sequence[str], values: Sequence[float], column: str) -> DataFrame:
    return spark.createDataFrame([(n, float(v)) for n, v in zip(names, values)], f"feature string, {column} double")


def importance_table(spark: SparkSession, model, names: Sequence[str]) -> DataFrame:
    """Features by falling importance."""
    return _named(spark, names, model.featureImportances.toArray(), "importance").orderBy(F.desc("importance"), "feature")


def coef_table(spark: SparkSession, model, names: Sequence[str], n: int = 10) -> DataFrame:
    """The n largest coefficients by absolute value."""
    return _named(spark, names, model.coefficients.toArray(), "coefficient").orderBy(F.abs("coefficient").desc(), "feature").limit(n)


def linear_contributions(df: DataFrame, key: str, coefficients: Mapping[str, float], means: Mapping[str, float]) -> DataFrame:
    """coefficient * (x - mean) per feature: sums to prediction minus mean prediction."""
    return df.select(key, *[(F.lit(float(b)) * (F.col(c) - F.lit(float(means[c])))).alias(f"shap_{c}") for c, b in coefficients.items()])


def shapley_contributions(
    df: DataFrame, key: str, cols: Sequence[str], background: Mapping[str, float], predict: Callable[[DataFrame], DataFrame], orders: int = 4, seed: int = 42
) -> DataFrame:
    """(key, feature, contribution) for any model, averaged over sampled feature orders.

    Feature values come from the row inside a prefix of an order and from the background outside.  Every prefix is
    scored once, next to the row, and a row's gains are taken there; only its sums per feature go to its key.
    Contributions of a row add up to its prediction minus the background prediction.
    """
    rng = random.Random(seed)
    plans = [rng.sample(list(cols), len(cols)) for _ in range(orders)]
    own = {c: f"_x{at}" for at, c in enumerate(cols)}
    rows = df.select(key, *[F.col(c).alias(x) for c, x in own.items()])
    # equal prefixes of two orders hold the same features and are scored together
    scores: dict[frozenset, str] = {}
    for prefix in (frozenset(plan[:i]) for plan in plans for i in range(len(cols) + 1)):
        if prefix not in scores:
            shown = {c: F.col(own[c]) if c in prefix else F.lit(float(background[c])) for c in cols}
            kept = [key, *own.values(), *scores.values()]
            scores[prefix] = f"_p{len(scores)}"
            rows = predict(rows.withColumns(shown)).select(*kept, F.col("prediction").alias(scores[prefix]))
    sums = []
    for at, c in enumerate(cols):
        steps = [(frozenset(plan[: plan.index(c) + 1]), frozenset(plan[: plan.index(c)])) for plan in plans]
        gains = F.array(*[F.col(scores[after]) - F.col(scores[before]) for after, before in steps])
        sums.append(F.filter(gains, lambda g: g.isNotNull()).alias(f"_g{at}"))
    gained = rows.select(key, *sums)
    parts = [
        part
        for at in range(len(cols))
        for part in (
            F.sum(F.aggregate(f"_g{at}", F.lit(0.0), lambda s, g: s + g)).alias(f"_s{at}"),
            F.sum(F.size(f"_g{at}")).alias(f"_n{at}"),
        )
    ]
    means = [F.struct(F.lit(c).alias("feature"), F.try_divide(f"_s{at}", f"_n{at}").alias("contribution")) for at, c in enumerate(cols)]
    return gained.groupBy(key).agg(*parts).select(key, F.inline(F.array(*means)))


# ---- gated pipeline -----------------------------------------------------------------------------------------

# fixed values: forest size and depth, the gate's class and threshold
FOREST = {"trees": 100, "depth": 10}
GATE_CLASS = "0"
GATE_F1 = 0.90


def gate_value(report: DataFrame, cls: str = GATE_CLASS, metric: str = "f1") -> float:
    row = report.filter(F.col("class") == cls).first()
    return float(row[metric]) if row else 0.0


def promote_if(model: PipelineModel, report: DataFrame, path: str, threshold: float = GATE_F1, cls: str = GATE_CLASS) -> bool:
    """Save the model as production model when the class reaches the threshold."""
    if gate_value(report, cls) < threshold:
        return False
    model.write().overwrite().save(path)
    return True


def train_pipeline(
    df: DataFrame, key: str, features: Sequence[str], label: str, folder: str, trees: int = FOREST["trees"], depth: int = FOREST["depth"], threshold: float = GATE_F1
) -> DataFrame:
    """Validate, split by class, scale and train a forest, evaluate, report, promote.

    Writes ``model``, ``evaluation`` and, past the gate, ``production`` below ``folder``; returns the
    report with the gate's decision.
    """
    require_columns(df, [key, *features, label])
    split = written(split_random(df.select(key, *features, label), key, 0.2, label), "split")
    train, test = split.filter("part = 'train'"), split.filter("part = 'test'")
    model = forest_classifier(ColumnPipeline(numeric=list(features)), train, label, trees, depth)
    model.write().overwrite().save(f"{folder}/model")
    scored = model.transform(test).withColumn("prediction", F.col("prediction").cast("int"))
    classification_report(scored, label, "prediction").write.mode("overwrite").json(f"{folder}/evaluation")
    report = df.sparkSession.read.schema("class string, precision double, recall double, f1 double, support long").json(f"{folder}/evaluation")
    promoted = promote_if(model, report, f"{folder}/production", threshold)
    return report.withColumn("promoted", F.lit(promoted))

