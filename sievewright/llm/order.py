"""Dealing rows to buckets that ascend by a key, without running what stands above them twice."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bucket_bounds(df: DataFrame, key: str, n: int) -> np.ndarray:
    """Up to n - 1 ascending bounds from approximate quantiles of the key alone; a key equal to a bound is above it."""
    if n < 2:
        return np.empty(0, np.int64)
    shares = [k / n for k in range(1, n)]
    found = df.select(F.percentile_approx(F.col(key).cast("long"), F.array(*map(F.lit, shares)), 20_000).alias("q")).first().q
    return np.array(sorted({*(found or [])}), np.int64)


def bucket_of(df: DataFrame, key: str, bounds: np.ndarray, name: str = "bucket") -> DataFrame:
    """Adds the bucket by binary search in the JVM; 0 for null."""
    if not len(bounds):
        return df.withColumn(name, F.lit(0))
    from pyspark.ml.feature import Bucketizer

    held = "__key_as_double"
    splits = sorted({-float("inf"), *map(float, bounds), float("inf")})
    out = Bucketizer(splits=splits, inputCol=held, outputCol="__bucket", handleInvalid="keep").transform(df.withColumn(held, F.coalesce(F.col(key).cast("double"), F.lit(-float("inf")))))
    return out.withColumn(name, F.col("__bucket").cast("int")).drop(held, "__bucket")


