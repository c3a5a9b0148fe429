"""Feature propagation on a graph and node classification."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mlspark.plans.neighbours import vector_topk
from mlspark.session import written


def knn_graph(vectors: DataFrame, k: int, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Directed edges (src, dst) to the k nearest other rows."""
    near = vector_topk(vectors, vectors, k, key, key, vector, exclude_self=True)
    return near.select(F.col("query_id").alias("src"), F.col("base_id").alias("dst"))


def both_ways(edges: DataFrame) -> DataFrame:
    """Each edge once per direction, without loops."""
    back = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    return edges.select("src", "dst").unionByName(back).filter("src <> dst").distinct()


def propagate(vertices: DataFrame, edges: DataFrame, hops: int = 2, key: str = "id", features: str = "features") -> DataFrame:
    """Averages features over neighbours and self, normalised by both degrees, ``hops`` times.

    One hop is a join of the edges with the vertex vectors and a partial vector sum per target, so a hub
    is summed map-side before the shuffle.  ``edges`` holds both directions.
    """
    ids = vertices.select(F.col(key).alias("id"))
    loops = ids.select(F.col("id").alias("src"), F.col("id").alias("dst"))
    linked = edges.select("src", "dst").unionByName(loops)
    degree = linked.groupBy(F.col("dst").alias("id")).agg(F.count(F.lit(1)).alias("degree"))
    weighted = (
        linked.join(degree.select(F.col("id").alias("src"), F.col("degree").alias("ds")), "src")
        .join(degree.select(F.col("id").alias("dst"), F.col("degree").alias("dd")), "dst")
        .select("src", "dst", (F.lit(1.0) / F.sqrt(F.col("ds") * F.col("dd"))).alias("w"))
    )
    weighted = written(weighted, "edges")
    state = vertices.select(F.col(key).alias("id"), F.col(features).cast("array<double>").alias("h"))
    for hop in range(hops):
        sent = weighted.join(state.withColumnRenamed("id", "src"), "src").select("dst", "w", array_to_vector("h").alias("v"))
        total = sent.groupBy("dst").agg(Summarizer.sum(F.col("v"), F.col("w")).alias("s"))
        state = total.select(F.col("dst").alias("id"), vector_to_array("s").alias("h"))
        if hop < hops - 1:
            state = written(state, "hop")
    return state.select(F.col("id").alias(key), F.col("h").alias(features))


def classify_nodes(
    vertices: DataFrame,
    edges: DataFrame,
    hops: tuple[int, ...] = (0, 1, 2),
    key: str = "id",
    features: str = "features",
    label: str = "label",
    split: str = "split",
) -> DataFrame:
    """Logistic models on propagated features; the best hop count by validation accuracy is marked.

    ``split`` is train, val or test.  Returns (hops, val_accuracy, test_accuracy, chosen).
    """
    out = None
    info = vertices.select(key, label, split)
    for n in hops:
        h = propagate(vertices, edges, n, key, features) if n else vertices.select(key, F.col(features).cast("array<double>").alias(features))
        data = written(h.join(info, key).withColumn("x", array_to_vector(features)).drop(features), "nodes")
        model = LogisticRegression(featuresCol="x", labelCol=label, regParam=0.01, maxIter=100).fit(data.filter(F.col(split) == "train"))
        hit = (F.col("prediction") == F.col(label)).cast("int")
        row = model.transform(data).agg(
            F.lit(n).alias("hops"),
            F.avg(F.when(F.col(split) == "val", hit)).alias("val_accuracy"),
            F.avg(F.when(F.col(split) == "test", hit)).alias("test_accuracy"),
        )
        out = row if out is None else out.unionByName(row)
    best = out.select(F.min_by("hops", F.struct(-F.col("val_accuracy"), F.col("hops")))).scalar()
    return out.withColumn("chosen", F.col("hops") == best)
