"""Small helpers shared by the operators."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfcast.session import ensure_checkpoint_dir

#: ASCII white space as a regular-expression class (blank and \\t..\\r).
BLANKS = r"[\x20\x09-\x0D]+"


#: Bytes of one Arrow batch, so that a Python task holds little at a time.
BATCH_BYTES = 8 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batch bound to ``BATCH_BYTES`` if it is above."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    number, unit = re.fullmatch(r"(-?\d+)\s*([a-z]*)", spark.conf.get(key).lower()).groups()
    size = int(number) * {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}.get(unit[:1], 1)
    if not 0 < size <= BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*cols) if cols else df


def written(df: DataFrame, label: str) -> DataFrame:
    """Write a frame once below ``spark.checkpoint.dir`` and read it back.

    Unlike ``checkpoint()`` the copy keeps Parquet statistics, so the planner
    knows its size (and broadcasts it only if it is small).
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_written(df: DataFrame) -> None:
    """Delete a table of ``written`` that nothing reads any more."""
    spark = df.sparkSession
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def blank_words(text) -> F.Column:
    """Words between ASCII white space, unchanged; null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANKS), "")


_CUT = 1 << 22


def byte_pieces(data: bytes, size: int = _CUT):
    """A text's bytes in pieces of about ``size``, cut after an ASCII blank.

    A run without blanks stays whole, so no word is ever cut.
    """
    at = 0
    while len(data) - at > size:
        end = at + size
        while end < len(data) and data[end] not in b" \t\n\r\x0b\x0c":
            end += 1
        yield data[at:end]
        at = end
    yield data[at:] if at else data
