"""Batch scoring with any model a user brings."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import DataFrame
from pyspark.sql import types as T


def predict_batch(
    df: DataFrame,
    make_predict: Callable[[], Callable],
    cols: Sequence[str],
    out: str = "prediction",
    kind: T.DataType | None = None,
    input_shapes: Sequence[Sequence[int] | None] | None = None,
    batch_size: int = 1024,
) -> DataFrame:
    """Adds the model's output.  ``make_predict`` loads the model, once per worker, and returns a
    function from NumPy batches to a NumPy batch."""
    score = predict_batch_udf(
        make_predict, return_type=kind or T.DoubleType(), batch_size=batch_size, input_tensor_shapes=input_shapes
    )
    return df.withColumn(out, score(*cols))
