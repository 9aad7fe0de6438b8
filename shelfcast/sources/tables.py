"""Scans of the driver's Parquet tables (and of delimited files, op A1-A5).

Every reader selects the columns it needs right after the scan so the
Parquet reader only decodes those (``ReadSchema`` in the plan).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shelfcast.session import table_path


_SCANS: dict[tuple, DataFrame] = {}


def table_version(spark: SparkSession, sf_dir: str, name: str) -> tuple:
    """Modification time and length of a table's file or folder; () if absent."""
    path = spark._jvm.org.apache.hadoop.fs.Path(table_path(sf_dir, name))
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return ()
    status = fs.getFileStatus(path)
    return status.getModificationTime(), status.getLen()


def read_table(spark: SparkSession, sf_dir: str, name: str,
               columns: list[str] | None = None) -> DataFrame:
    """Parquet table ``name`` under ``sf_dir``, pruned to ``columns``.

    The resolved scan (schema read from the file footers, file listing) is
    kept per session, path and table version, so repeated queries over the
    same files do not infer the schema again and rewritten files are listed
    anew.
    """
    path = table_path(sf_dir, name)
    key = (spark.sparkContext.applicationId, id(spark), path, table_version(spark, sf_dir, name))
    df = _SCANS.get(key)
    if df is None:
        df = spark.read.parquet(path)
        _SCANS[key] = df
    return df.select(*columns) if columns else df


def scan_typed(spark: SparkSession, path: str, schema: StructType,
               fmt: str = "csv") -> DataFrame:
    """A1: read with a declared schema (no inference pass over the data)."""
    reader = spark.read.schema(schema)
    if fmt == "csv":
        return reader.option("header", True).csv(path)
    return reader.format(fmt).load(path)


def scan_pruned(df: DataFrame, keys: list[str], prefix: str = "d_",
                first_day: int = 1, last_day: int | None = None) -> DataFrame:
    """A2: key columns plus the day columns ``d_first..d_last`` only.

    The projection is resolved before any action, so Catalyst prunes the
    unread day columns in the file scan.
    """
    days = []
    for c in df.columns:
        if c.startswith(prefix) and c[len(prefix):].isdigit():
            n = int(c[len(prefix):])
            if n >= first_day and (last_day is None or n <= last_day):
                days.append(c)
    return df.select(*keys, *days)


def scan_limited(df: DataFrame, order_by: list[str], n: int | None) -> DataFrame:
    """A3: first ``n`` rows in key order (``None`` keeps all rows).

    ``orderBy().limit()`` plans as a TakeOrderedAndProject (per-partition
    top-n, then a merge of n rows per partition), not a global sort.
    """
    if n is None:
        return df
    return df.orderBy(*order_by).limit(n)


def scan_inferred(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """A4: schema inferred from the data; pair with ``encode.narrow_types``."""
    if fmt == "csv":
        return spark.read.option("header", True).option("inferSchema", True).csv(path)
    return spark.read.format(fmt).load(path)


def scan_template(template: DataFrame, id_col: str = "id") -> DataFrame:
    """A5: the id list of a submission template."""
    return template.select(F.col(id_col).alias("id"))
