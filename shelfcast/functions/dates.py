"""Date scalar functions (ops I1-I4, I12) as built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parse_date(col: str | Column, fmt: str | None = None) -> Column:
    """String -> date (``to_date``; an explicit format when given)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.to_date(c, fmt) if fmt else F.to_date(c)


def weekday_mon0(date: Column) -> Column:
    """Day of week with Monday = 0 (pandas ``dayofweek``)."""
    return F.weekday(date)


def date_parts(df: DataFrame, date_col: str = "date", keep_given: bool = True) -> DataFrame:
    """Wday, week, month, quarter, year, mday as short columns.

    With ``keep_given`` a part the table already holds (the calendar gives
    wday, month, year) is only cast, as the reference does; missing ones are
    derived from the date.  ``wday`` derived here is pandas' ``weekday``
    (Monday = 0); ``week`` is the ISO week.
    """
    d = F.col(date_col)
    derive = {
        "wday": F.weekday(d),
        "week": F.weekofyear(d),
        "month": F.month(d),
        "quarter": F.quarter(d),
        "year": F.year(d),
        "mday": F.dayofmonth(d),
    }
    out = df
    for name, expr in derive.items():
        src = F.col(name) if (keep_given and name in df.columns) else expr
        out = out.withColumn(name, src.cast("short"))
    return out


def period_flags(df: DataFrame, date_col: str = "date") -> DataFrame:
    """is_{year,quarter,month}_{start,end} as byte flags."""
    d = F.col(date_col)
    q_start = F.trunc(d, "quarter")
    flags = {
        "is_year_start": d == F.trunc(d, "year"),
        "is_year_end": (F.month(d) == 12) & (F.dayofmonth(d) == 31),
        "is_quarter_start": d == q_start,
        "is_quarter_end": d == F.date_sub(F.add_months(q_start, 3), 1),
        "is_month_start": F.dayofmonth(d) == 1,
        "is_month_end": d == F.last_day(d),
    }
    return df.select("*", *[v.cast("byte").alias(k) for k, v in flags.items()])


def is_weekend(date: Column) -> Column:
    """I4: Saturday or Sunday (Monday = 0 numbering: 5, 6) as a byte."""
    return F.weekday(date).isin(5, 6).cast("byte")


def date_offset(date: Column, days: int | Column) -> Column:
    """Date plus ``days`` (negative goes back)."""
    return F.date_add(date, days)


def horizon_dates(start: Column, horizon: int) -> Column:
    """The ``horizon`` dates from ``start`` as an array (explode it)."""
    return F.sequence(start, F.date_add(start, horizon - 1))
