"""Category encoding and type narrowing (ops J1-J6).

Codes are computed from the *distinct* values only (a partial aggregation of
all coded columns in one pass), numbered in sorted order by one distributed
row number and joined back; the planner picks the join from the measured
size of the code table.  There is one path for every cardinality.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.operators.ordering import global_row_number


def code_table(df: DataFrame, cols: list[str]) -> DataFrame:
    """(col, val, code, has_null): 0-based codes of the distinct non-NULL
    values of each string column in sorted order; one NULL-free row per value
    and, for a column that holds NULLs only, one row with a NULL value."""
    types = dict(df.dtypes)
    bad = [c for c in cols if types.get(c) != "string"]
    if bad:
        raise TypeError(f"category columns must be strings (cast them first): {bad}")
    pairs = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("_col"), F.col(c).alias("_val")) for c in cols])).alias("_p"))
    values = pairs.select("_p._col", "_p._val").distinct()
    # NULL sorts first within its column, so it takes the first number.
    numbered = global_row_number(values, ["_col", "_val"], out="_rn")
    first = numbered.groupBy("_col").agg(
        F.min("_rn").alias("_first"), F.max(F.col("_val").isNull().cast("int")).alias("_null"))
    return numbered.join(first, "_col").select(
        "_col", "_val", (F.col("_rn") - F.col("_first") - F.col("_null")).cast("int").alias("_code"),
        "_null")


def _attach(df: DataFrame, codes: DataFrame, col: str) -> DataFrame:
    mine = codes.where(F.col("_col") == col).select(
        F.col("_val").alias("_v"), "_code", "_null")
    # NULL meets the NULL row of the table, whose code is -1.
    return df.join(mine, F.col(col).eqNullSafe(F.col("_v")), "left").drop("_v")


def category_codes(df: DataFrame, cols: list[str], suffix: str = "") -> DataFrame:
    """Sorted category code as int; with NULLs present NULL -> 0 and
    values 1..k, without NULLs values 0..k-1 (code -1 for NULL, then the
    column minimum subtracted).

    The input is read once for the distinct values of all the columns and
    once by the final joins; it is never materialised itself.
    """
    codes = code_table(df, cols)
    out = df
    for c in cols:
        out = _attach(out, codes, c)
        out = out.withColumn(c + suffix, F.col("_code") + F.col("_null")).drop("_code", "_null")
    return out


def label_encode_keep_null(df: DataFrame, cols: list[str], suffix: str = "") -> DataFrame:
    """Codes 0..k-1 in sorted order for non-NULL values; NULL stays NULL."""
    codes = code_table(df, cols)
    out = df
    for c in cols:
        out = _attach(out, codes, c)
        out = out.withColumn(c + suffix, F.when(F.col("_code") >= 0, F.col("_code"))).drop("_code", "_null")
    return out


#: One column per value up to here; a wider set belongs in a vector.
MAX_COLUMNS = 4096


def one_hot(df: DataFrame, col: str, prefix: str | None = None,
            values: list | None = None, drop: bool = False) -> DataFrame:
    """J3 (``prefix`` given, e.g. ``store_``) / J4 (names are the values):
    one 0/1 byte column per value.

    The values become column names, so the schema holds them all.  Without
    ``values`` they are read from the data, at most ``MAX_COLUMNS`` + 1 of
    them: a wider set raises and belongs in ``one_hot_vector`` or
    ``one_hot_sparse``.
    """
    if values is None:
        found = df.select(col).where(F.col(col).isNotNull()).distinct().limit(MAX_COLUMNS + 1).collect()
        if len(found) > MAX_COLUMNS:
            raise ValueError(f"{col} has more than {MAX_COLUMNS} values: use one_hot_vector")
        values = sorted(r[0] for r in found)
    cols = [(F.col(col) == F.lit(v)).cast("byte").alias(f"{prefix or ''}{v}") for v in values]
    out = df.select("*", *cols)
    return out.drop(col) if drop else out


def one_hot_sparse(df: DataFrame, col: str, out: str = "one_hot") -> DataFrame:
    """J3/J4 for any number of values: struct(size, index) of the single 1 in
    sorted value order; index NULL for a NULL value.  Nothing is collected."""
    codes = code_table(df, [col])
    size = codes.agg(F.max("_code") + 1).scalar()
    coded = _attach(df, codes, col)
    return coded.withColumn(out, F.struct(
        size.alias("size"), F.when(F.col("_code") >= 0, F.col("_code")).alias("index"))).drop("_code", "_null")


def one_hot_vector(df: DataFrame, col: str, out: str = "one_hot") -> tuple[DataFrame, DataFrame]:
    """J3/J4 as an ML sparse vector for any number of values: (rows with the
    vector, dictionary (index, value)).

    The codes come from the distributed code table (no value reaches the
    driver, and the schema does not grow with them); a NULL value is the zero
    vector.  The dictionary is a table, not schema metadata.
    """
    from pyspark.ml.feature import OneHotEncoderModel, OneHotEncoder

    codes = code_table(df, [col])
    known = codes.where(F.col("_code") >= 0)
    size = (known.agg(F.max("_code")).first()[0] or 0) + 1
    coded = _attach(df, codes, col).withColumn("_at", F.when(F.col("_code") >= 0, F.col("_code")).otherwise(size).cast("double"))
    # The encoder learns only the number of codes: one row shows it the largest.
    largest = df.sparkSession.range(1).select(F.lit(float(size)).alias("_at"))
    encoder: OneHotEncoderModel = OneHotEncoder(inputCols=["_at"], outputCols=[out], dropLast=True).fit(largest)
    rows = encoder.transform(coded).drop("_code", "_null", "_at")
    return rows, known.select(F.col("_code").alias("index"), F.col("_val").alias("value"))


def binary_encode(df: DataFrame, col: str, bits: int = 10, prefix: str | None = None) -> DataFrame:
    """Integer -> ``bits`` columns holding its zero-padded binary digits,
    most significant first (the value modulo 2**bits, as the reference keeps
    the last ``bits`` characters)."""
    p = prefix or f"{col}_bin_"
    c = F.col(col).cast("long")
    return df.select("*", *[F.shiftright(c, bits - 1 - i).bitwiseAND(1).cast("byte")
                            .alias(f"{p}{i}") for i in range(bits)])


# --- J6 -------------------------------------------------------------------------

# Integer targets, narrowest first, with the limits the narrowing compares
# against (strictly inside), and the float target.
_INT_TYPES = [("tinyint", -128, 127), ("smallint", -32768, 32767),
              ("int", -2147483648, 2147483647)]
_FLOAT32_MAX = 3.4028234663852886e38


def narrow_plan(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """One row per numeric column: (column, min_value, max_value, narrow_type).

    A single aggregation computes every min and max; the choice is a CASE on
    those, so the plan stays lazy.
    """
    numeric = {"tinyint", "smallint", "int", "bigint", "float", "double"}
    fields = [(f.name, f.dataType.simpleString()) for f in df.schema.fields
              if f.dataType.simpleString() in numeric and (cols is None or f.name in cols)]
    aggs = []
    for name, _ in fields:
        aggs += [F.min(name).cast("double").alias(f"{name}__min"),
                 F.max(name).cast("double").alias(f"{name}__max")]
    mm = df.agg(*aggs)
    rows = []
    for name, typ in fields:
        lo, hi = F.col(f"{name}__min"), F.col(f"{name}__max")
        if typ in ("float", "double"):
            choice = F.when((lo > -_FLOAT32_MAX) & (hi < _FLOAT32_MAX), F.lit("float")) \
                .otherwise(F.lit("double"))
        else:
            choice = None
            for t, tlo, thi in _INT_TYPES:
                cond = (lo > tlo) & (hi < thi)
                choice = F.when(cond, F.lit(t)) if choice is None else choice.when(cond, F.lit(t))
            choice = choice.otherwise(F.lit("bigint"))
        rows.append(F.struct(F.lit(name).alias("column"), lo.alias("min_value"),
                             hi.alias("max_value"), choice.alias("narrow_type")))
    return mm.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def narrow_types(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Cast each numeric column to the narrowest type whose limits lie
    strictly outside its [min, max].  The plan has one row per column and is
    the only thing brought to the driver (a schema needs concrete types)."""
    plan = {r["column"]: r["narrow_type"] for r in narrow_plan(df, cols).collect()}
    return df.select(*[F.col(c).cast(plan[c]).alias(c) if c in plan else F.col(c)
                       for c in df.columns])
