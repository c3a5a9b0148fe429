"""Anomaly detectors: rules, isolation forest, local outlier factor, boundary, votes, rebuild errors."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mlspark.operators.clean import rule_flags
from mlspark.operators.features import fit_minmax, minmax
from mlspark.operators.metrics import classification_report, quantile_threshold
from mlspark.operators.windows import collapse_adjacent, sequences
from mlspark.plans.neighbours import stack, vector_topk
from mlspark.plans.ordered import null_safe_join, row_index
from mlspark.session import written

# fixed values: (play time below, score above) of the threshold rules, and the overall score limit
SCORE_RULES = ((20, 2000), (60, 2500), (90, 2750))
SCORE_LIMIT = 3000


def play_rules(score: str, playtime: str, rules=SCORE_RULES, limit: float = SCORE_LIMIT) -> dict[str, Column]:
    """Strictly greater scores within a play time, above the limit, or without any play time."""
    out = {f"under_{t}": (F.col(playtime) < t) & (F.col(score) > s) for t, s in rules}
    out["over_limit"] = F.col(score) > limit
    out["unplayed"] = (F.col(playtime) == 0) & (F.col(score) != 0)
    return out


def rule_detector(df: DataFrame, score: str, playtime: str, rules=SCORE_RULES, limit: float = SCORE_LIMIT) -> DataFrame:
    return rule_flags(df, play_rules(score, playtime, rules, limit))


# ---- isolation forest ---------------------------------------------------------------------------------


def average_path(n: np.ndarray | float) -> np.ndarray:
    """Mean depth of an unsuccessful search among n rows."""
    n = np.asarray(n, dtype=float)
    safe = np.maximum(n, 2.0)
    return np.where(n > 2, 2 * (np.log(safe - 1) + np.euler_gamma) - 2 * (n - 1) / safe, np.where(n == 2, 1.0, 0.0))


NODES = "tree int, node int, feature int, split double, size int, depth int"


def _grow(seed: int, depth_limit: int):
    def grow(rows: pd.DataFrame) -> pd.DataFrame:
        tree = int(rows["tree"].iloc[0])
        data = stack(rows.sort_values("h")["x"])
        rng = np.random.default_rng([seed, tree])
        out = []
        todo = [(0, np.arange(len(data)), 0)]
        while todo:
            node, at, depth = todo.pop()
            part = data[at]
            spread = np.flatnonzero(part.max(0) > part.min(0))
            if depth >= depth_limit or len(at) <= 1 or not len(spread):
                out.append((tree, node, -1, 0.0, len(at), depth))
                continue
            feature = int(rng.choice(spread))
            split = float(rng.uniform(part[:, feature].min(), part[:, feature].max()))
            out.append((tree, node, feature, split, len(at), depth))
            left = part[:, feature] < split
            todo += [(2 * node + 1, at[left], depth + 1), (2 * node + 2, at[~left], depth + 1)]
        return pd.DataFrame(out, columns=["tree", "node", "feature", "split", "size", "depth"])

    return grow


def fit_isolation_forest(df: DataFrame, n: int, key: str, features: Sequence[str], trees: int = 100, sample: int = 256, seed: int = 1) -> pd.DataFrame:
    """Nodes of random-split trees for a table of ``n`` rows, each grown in its own task from at most ``sample`` hash-drawn rows.

    One hash per row keeps about ``2 * sample`` rows per tree whatever the table size; a second one names
    the row's tree.  Tables too small for disjoint samples offer each row to several trees.
    """
    wanted = 2 * sample * trees
    share = min(1.0, wanted / max(n, 1))
    offers = min(trees, max(1, -(-wanted // max(n, 1))))
    stride = next(s for s in range(max(1, trees * 2 // 5), 2 * trees + 2) if math.gcd(s, trees) == 1)
    x = F.array(*[F.col(c).cast("double") for c in features])
    kept_share = F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(1 << 40)) < F.lit(int(share * (1 << 40)))
    offered = (
        df.filter(kept_share)
        .select(F.col(key).alias("_k"), x.alias("x"), F.explode(F.sequence(F.lit(0), F.lit(offers - 1))).alias("_j"))
        .withColumn("tree", F.pmod(F.xxhash64("_k", F.lit(seed + 1)) + F.col("_j").cast("long") * stride, F.lit(trees)).cast("int"))
    )
    rows = offered.select("_k", "x", "tree", F.xxhash64("_k", "tree", F.lit(seed + 2)).alias("h"))
    first = W.partitionBy("tree").orderBy("h", "_k")
    kept = rows.withColumn("_rn", F.row_number().over(first)).filter(F.col("_rn") <= sample).select("tree", "h", "x")
    grow = _grow(seed, math.ceil(math.log2(sample)))
    # at most trees * (2 * sample - 1) nodes
    return kept.groupBy("tree").applyInPandas(grow, NODES).toPandas()


def isolation_score(nodes: pd.DataFrame):
    """UDF: 2 ** (-mean path / normal path) per row, walking all trees one level at a time."""
    width = int(nodes["node"].max()) + 1
    rank = {t: i for i, t in enumerate(sorted(set(nodes["tree"])))}
    at = nodes["tree"].map(rank).to_numpy() * width + nodes["node"].to_numpy()
    slots = len(rank) * width
    feature, split = np.zeros(slots, dtype=np.int64), np.zeros(slots)
    left, right, length = np.arange(slots), np.arange(slots), np.zeros(slots)
    inner = nodes["feature"].to_numpy() >= 0
    feature[at], split[at] = np.maximum(nodes["feature"].to_numpy(), 0), nodes["split"].to_numpy()
    # a leaf is its own child, so that every row can take the same number of steps
    start = at - nodes["node"].to_numpy()
    left[at[inner]] = (start + 2 * nodes["node"].to_numpy() + 1)[inner]
    right[at[inner]] = left[at[inner]] + 1
    length[at] = nodes["depth"].to_numpy() + average_path(nodes["size"].to_numpy())
    normal = float(average_path(nodes[nodes["node"] == 0]["size"].to_numpy()).mean()) or 1.0
    depth = int(nodes["depth"].max())
    roots = np.arange(len(rank)) * width

    def paths(x: np.ndarray) -> np.ndarray:
        node = np.broadcast_to(roots, (len(x), len(roots)))
        for _ in range(depth):
            node = np.where(np.take_along_axis(x, feature[node], 1) >= split[node], right[node], left[node])
        return length[node].mean(1)

    @F.pandas_udf(T.DoubleType())
    def score(rows: pd.Series) -> pd.Series:
        if not len(rows):
            return pd.Series([], dtype=float)
        x = stack(rows)
        mean = np.concatenate([paths(x[i:i + 2048]) for i in range(0, len(x), 2048)])
        return pd.Series(np.power(2.0, -mean / normal))

    return score


def isolation_forest(
    df: DataFrame, key: str, features: Sequence[str], contamination: float = 0.03, trees: int = 100, sample: int = 256, seed: int = 1
) -> DataFrame:
    """Adds ``score`` and ``anomaly`` (1 for rows above the exact (1 - contamination) quantile)."""
    n = df.count()
    nodes = fit_isolation_forest(df, n, key, features, trees, sample, seed)
    x = F.array(*[F.col(c).cast("double") for c in features])
    scored = written(df.withColumn("score", F.round(isolation_score(nodes)(x), 9)), "isolation")
    cut = quantile_threshold(scored, "score", 1 - contamination).scalar()
    return scored.withColumn("anomaly", (F.col("score") > cut).cast("int"))


# ---- local outlier factor --------------------------------------------------------------------------------


def _density(near: DataFrame, k_distance: DataFrame, out: str) -> DataFrame:
    """Inverse mean reachability distance of each query to its neighbours."""
    reach = near.join(k_distance, "base_id").select("query_id", F.greatest("dist", "k_dist").alias("reach"))
    return reach.groupBy("query_id").agg((F.lit(1.0) / (F.avg("reach") + 1e-10)).alias(out))


def lof(train: DataFrame, rows: DataFrame, k: int, key: str, vector: str, contamination: float = 0.05) -> DataFrame:
    """Novelty factor of ``rows`` against ``train``: (key, lof, anomaly).

    The cut is the (1 - contamination) quantile of the training rows' own factors.
    """
    inner = written(vector_topk(train, train, k, key, key, vector, exclude_self=True), "lof-inner")
    k_distance = inner.groupBy("query_id").agg(F.max("dist").alias("k_dist")).withColumnRenamed("query_id", "base_id")
    density = written(_density(inner, k_distance, "lrd").withColumnRenamed("query_id", "base_id"), "lof-density")

    def factor(near: DataFrame) -> DataFrame:
        own = _density(near, k_distance, "own")
        mean = near.join(density, "base_id").groupBy("query_id").agg(F.avg("lrd").alias("around"))
        return mean.join(own, "query_id").select("query_id", (F.col("around") / F.col("own")).alias("lof"))

    cut = quantile_threshold(factor(inner), "lof", 1 - contamination).scalar()
    outer = written(vector_topk(rows, train, k, key, key, vector), "lof-outer")
    return factor(outer).select(F.col("query_id").alias(key), "lof", (F.col("lof") > cut).cast("int").alias("anomaly"))


# ---- boundary of the normal class -------------------------------------------------------------------------


def fit_boundary(normal: DataFrame, features: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Mean and inverse covariance, from pairwise sums that Spark adds up (features squared numbers)."""
    pairs = [(a, b) for i, a in enumerate(features) for b in features[i:]]
    row = normal.agg(
        *[F.avg(c).alias(f"m_{c}") for c in features], *[F.covar_pop(a, b).alias(f"c_{a}_{b}") for a, b in pairs]
    ).first()
    mean = np.array([row[f"m_{c}"] for c in features])
    cov = np.zeros((len(features), len(features)))
    for a, b in pairs:
        i, j = features.index(a), features.index(b)
        cov[i, j] = cov[j, i] = row[f"c_{a}_{b}"]
    return mean, np.linalg.pinv(cov)


def boundary_distance(mean: np.ndarray, inverse: np.ndarray, features: Sequence[str]) -> Column:
    """Squared Mahalanobis distance as one generated expression."""
    off = [F.col(c) - F.lit(float(m)) for c, m in zip(features, mean)]
    total = F.lit(0.0)
    for i in range(len(features)):
        for j in range(len(features)):
            total = total + off[i] * off[j] * F.lit(float(inverse[i, j]))
    return total


def one_class_boundary(df: DataFrame, normal: Column, features: Sequence[str], nu: float = 0.05) -> DataFrame:
    """Distance from the normal class; rows beyond the (1 - nu) quantile of normal rows are anomalies."""
    features = list(features)
    mean, inverse = fit_boundary(df.filter(normal), features)
    scored = df.withColumn("distance", boundary_distance(mean, inverse, features))
    cut = quantile_threshold(scored.filter(normal), "distance", 1 - nu).scalar()
    return scored.withColumn("anomaly", (F.col("distance") > cut).cast("int"))


# ---- votes, rebuild errors ---------------------------------------------------------------------------------


def vote_ensemble(df: DataFrame, flags: Sequence[str], label: str, thresholds: Sequence[int] = (1, 2, 3)) -> DataFrame:
    """Classification report per vote threshold, all thresholds in one pass."""
    votes = sum((F.col(f).cast("int") for f in flags), F.lit(0))
    rows = df.select(F.col(label), votes.alias("votes"), F.explode(F.array(*[F.lit(t) for t in thresholds])).alias("threshold"))
    voted = rows.withColumn("prediction", (F.col("votes") >= F.col("threshold")).cast("int"))
    return classification_report(voted, label, "prediction", by=["threshold"])


def reconstruction_error(
    df: DataFrame, keys: Sequence[str], order: str, value: str, normal: Column, length: int = 3, components: int = 1
) -> DataFrame:
    """Mean squared error of rebuilding every window from a few directions learned on normal rows.

    Scaling to (-1, 1) and the directions see normal rows only; training windows are cut after the
    anomalies are taken out, so they bridge the gaps.
    """
    usual = df.filter(normal)
    scaled_by = minmax(value, fit_minmax(usual, [value])[value], (-1.0, 1.0))
    train = sequences(usual.withColumn("_v", scaled_by), keys, order, "_v", length)
    vectors = written(train.select("window"), "rebuild-train").select(array_to_vector("window").alias("x"))
    model = PCA(k=components, inputCol="x", outputCol="p").fit(vectors)
    directions = model.pc.toArray()
    centre = np.array(
        train.select(*[F.avg(F.col("window")[i]).alias(str(i)) for i in range(length)]).first(), dtype=float
    )

    @F.pandas_udf(T.DoubleType())
    def error(windows: pd.Series) -> pd.Series:
        if not len(windows):
            return pd.Series([], dtype=float)
        off = stack(windows) - centre
        return pd.Series(((off - (off @ directions) @ directions.T) ** 2).mean(1))

    every = sequences(df.withColumn("_v", scaled_by), keys, order, "_v", length)
    return every.select(*keys, order, error("window").alias("error"))


def detect_from_errors(
    df: DataFrame, keys: Sequence[str], order: str, error: str, percentile: float = 90, length: int = 3, max_gap: int = 2
) -> DataFrame:
    """Middle points of anomalous stretches: errors strictly above the percentile, shifted to the window
    centre, neighbours merged.  Positions count from 0."""
    indexed = written(row_index(df.select(*keys, order, error), keys, order, out="idx"), "positions")
    cuts = quantile_threshold(indexed, error, percentile / 100, keys)
    above = null_safe_join(indexed, cuts, keys).filter(F.col(error) > F.col("threshold"))
    candidates = written(above.select(*keys, (F.col("idx") - 1 + length // 2).alias("idx")), "candidates")
    return collapse_adjacent(candidates, keys, "idx", max_gap)


def rules_or_model(df: DataFrame, rules: Mapping[str, Column], model_flag: str) -> DataFrame:
    """-1 where a rule or the model fires, 1 elsewhere."""
    flagged = rule_flags(df, rules, tag="_rule")
    return flagged.withColumn("anomaly_prediction", F.when((F.col("_rule") == -1) | (F.col(model_flag) == 1), -1).otherwise(1)).drop("_rule")
