"""Writers for forecast outputs (ops A6-A8).

Outputs go under a shared folder: the ``output_dir`` given, else a
``outputs/`` folder next to the session's reliable checkpoint directory
(``spark.checkpoint.dir``), never a machine-local temporary folder.
Writes are ``overwrite`` of whole folders, so a retried job replaces a
partial attempt.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from shelfcast.session import ensure_checkpoint_dir


def output_path(spark: SparkSession, name: str, output_dir: str | None = None) -> str:
    base = output_dir or ensure_checkpoint_dir(spark).rstrip("/") + "/outputs"
    return f"{base}/{name}-{uuid.uuid4().hex[:8]}"


def sink_wide(df: DataFrame, path: str, sort_by: str = "id", read_back: bool = False):
    """The wide forecast as CSV with a header, sorted by id, no index.

    The sort is a range-partitioned global sort: each output file holds a
    key range and the files are in key order.
    """
    df.orderBy(sort_by).write.mode("overwrite").option("header", True).csv(path)
    if read_back:
        return df.sparkSession.read.schema(df.schema).option("header", True).csv(path)
    return path


def sink_per_variant(df: DataFrame, path: str, variant_col: str = "variant",
                     read_back: bool = False):
    """One output per multiplier variant: a ``variant=...`` folder each."""
    df.write.mode("overwrite").partitionBy(variant_col).parquet(path)
    if read_back:
        return df.sparkSession.read.parquet(path)
    return path


def sink_training_extract(df: DataFrame, base: str, read_back: bool = False):
    """Write a filtered training set under a name holding its column count."""
    path = f"{base}/df_train_{len(df.columns)}"
    df.write.mode("overwrite").parquet(path)
    if read_back:
        return df.sparkSession.read.parquet(path)
    return path
