"""Legacy date handling.

Teradata writes ``:col (DATE, FORMAT 'yyyymmdd')`` in its load statements;
``parse_date`` parses such text with the equivalent Spark pattern.  Two-digit
years follow the POSIX ``%y`` rule: 69-99 are 1969-1999, 00-68 are 2000-2068.

Teradata stores a DATE as the integer ``(year - 1900) * 10000 + month * 100 +
day``; 6000101 is its "end of time", 2500-01-01.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from loadwright.functions.columns import as_col

# The Teradata end-of-time date code and the date it stands for.
END_OF_TIME_CODE = 6000101
END_OF_TIME = _dt.date(2500, 1, 1)

# Two-digit years at or above this are 19xx, below are 20xx.
TWO_DIGIT_YEAR_PIVOT = 69


def spark_date_pattern(teradata_format: str) -> str:
    """Spark datetime pattern for a Teradata FORMAT string.

    ``yyyy`` / ``yy`` year, ``mm`` month, ``dd`` day of month, ``ddd`` day of
    year; any other character is a literal separator.
    """
    fmt = teradata_format.strip().strip("'\"").lower()
    out = []
    i = 0
    while i < len(fmt):
        if fmt.startswith("yyyy", i):
            out.append("yyyy")
            i += 4
        elif fmt.startswith("yy", i):
            out.append("yy")
            i += 2
        elif fmt.startswith("mm", i):
            out.append("MM")
            i += 2
        elif fmt.startswith("ddd", i):
            out.append("DDD")
            i += 3
        elif fmt.startswith("dd", i):
            out.append("dd")
            i += 2
        elif fmt[i].isalpha():
            raise ValueError(f"unsupported date format {teradata_format!r}")
        else:
            out.append("'" + fmt[i] + "'" if fmt[i] == "'" else fmt[i])
            i += 1
    return "".join(out)


def parse_date(c: str | Column, teradata_format: str) -> Column:
    """Text in a Teradata date FORMAT -> DATE; text that does not parse is NULL."""
    pattern = spark_date_pattern(teradata_format)
    col = as_col(c).cast("string")
    if "yyyy" in pattern or "yy" not in pattern:
        return F.to_date(F.try_to_timestamp(col, F.lit(pattern)))
    # Spark reads "yy" as 2000-2099; move the years at or above the pivot back
    # a century.
    parsed = F.to_date(F.try_to_timestamp(col, F.lit(pattern)))
    return F.when(
        F.year(parsed) >= 2000 + TWO_DIGIT_YEAR_PIVOT, F.add_months(parsed, -1200)
    ).otherwise(parsed)


def td_date_code(c: str | Column) -> Column:
    """DATE -> Teradata integer date code."""
    d = as_col(c)
    return (
        (F.year(d) - 1900) * 10000 + F.month(d) * 100 + F.dayofmonth(d)
    ).cast("int")


def decode_td_date(c: str | Column) -> Column:
    """Teradata integer date code -> DATE; a code that is no date is NULL."""
    code = as_col(c).cast("bigint")
    text = F.lpad((code + 19000000).cast("string"), 8, "0")
    return F.to_date(F.try_to_timestamp(text, F.lit("yyyyMMdd")))


def sentinel_date(c: str | Column) -> Column:
    """The end-of-time code 6000101 becomes DATE 2500-01-01.

    Any other integer code is decoded as a Teradata date.  The column holds
    integer codes; a DATE column has no sentinel and needs no call.
    The literal is used instead of ``from_unixtime`` so the result does not
    depend on the session time zone.
    """
    col = as_col(c)
    return F.when(col.cast("bigint") == END_OF_TIME_CODE, F.lit(END_OF_TIME)).otherwise(
        decode_td_date(col)
    )
