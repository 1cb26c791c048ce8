"""Legacy column types and how they land in Spark.

``spark_type`` maps a Teradata / MySQL column type to a Spark type;
``picture_type`` does the same for a COBOL PIC clause.  ``conform`` and
``conform_picture`` cast DataFrame columns with ``try_cast`` so that a value
that does not fit becomes NULL, as a Hive text table reads it, instead of
failing the job under ANSI mode.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Source type name -> target type.  These must equal the
# reference's type map.  VARCHAR maps to STRING; TIMESTAMP is a local
# date-time without zone, which is Spark's TIMESTAMP_NTZ.
#   BYTEINT   -> TINYINT
#   SMALLINT  -> SMALLINT
#   INTEGER   -> INT
#   INT       -> INT
#   BIGINT    -> BIGINT
#   DECIMAL   -> DECIMAL(p,s)
#   NUMERIC   -> DECIMAL(p,s)
#   FLOAT     -> DOUBLE
#   CHAR      -> CHAR(n), a string in DataFrames
#   VARCHAR   -> STRING
#   DATE      -> DATE
#   TIME      -> STRING
#   TIMESTAMP -> TIMESTAMP
_SCALAR_TYPES: dict[str, T.DataType] = {
    "BYTEINT": T.ByteType(),
    "SMALLINT": T.ShortType(),
    "INTEGER": T.IntegerType(),
    "INT": T.IntegerType(),
    "BIGINT": T.LongType(),
    "FLOAT": T.DoubleType(),
    "CHAR": T.StringType(),
    "VARCHAR": T.StringType(),
    "DATE": T.DateType(),
    "TIME": T.StringType(),
    "TIMESTAMP": T.TimestampNTZType(),
}
_DECIMAL_NAMES = ("DECIMAL", "NUMERIC")
# Hive's precision and scale for a DECIMAL declared without them.
_DEFAULT_DECIMAL = (10, 0)

_TYPE_RE = re.compile(r"^\s*([A-Za-z]+)\s*(?:\(\s*(\d+)\s*(?:,\s*(\d+)\s*)?\))?\s*$")


def spark_type(source_type: str) -> T.DataType:
    """Spark type for a legacy column type such as ``DECIMAL(9,2)``.

    The name is matched without regard to case.  Length / precision is kept
    for DECIMAL and dropped elsewhere (``int(11)``, ``TIMESTAMP(6)``).
    An unknown type raises ``ValueError``.
    """
    m = _TYPE_RE.match(source_type or "")
    if not m:
        raise ValueError(f"cannot read column type {source_type!r}")
    name = m.group(1).upper()
    if name in _DECIMAL_NAMES:
        if m.group(2) is None:
            return T.DecimalType(*_DEFAULT_DECIMAL)
        precision = int(m.group(2))
        scale = int(m.group(3) or 0)
        return T.DecimalType(precision, scale)
    if name in _SCALAR_TYPES:
        return _SCALAR_TYPES[name]
    raise ValueError(f"unsupported column type {source_type!r}")


def as_spark_type(t: str | T.DataType) -> T.DataType:
    return t if isinstance(t, T.DataType) else spark_type(t)


def cast_text(c: Column, dtype: T.DataType) -> Column:
    """Cast with Hive-text semantics: a value that does not parse is NULL.

    Strings pass unchanged, so an empty field stays an empty string.
    """
    if isinstance(dtype, T.StringType):
        return c
    return c.try_cast(dtype)


def conform(df: DataFrame, types: Mapping[str, str | T.DataType]) -> DataFrame:
    """Cast the named columns to their mapped types; bad values NULL.

    Columns not named are kept as they are, in place.
    """
    wanted = {k.lower(): as_spark_type(v) for k, v in types.items()}
    missing = set(wanted) - {c.lower() for c in df.columns}
    if missing:
        raise ValueError(f"conform: no column(s) {sorted(missing)}")
    out = []
    for name in df.columns:
        dtype = wanted.get(name.lower())
        if dtype is None:
            out.append(F.col(name))
        elif isinstance(dtype, T.StringType):
            out.append(F.col(name).cast("string").alias(name))
        else:
            out.append(F.col(name).try_cast(dtype).alias(name))
    return df.select(*out)


# ---------------------------------------------------------------- PIC

_PIC_GROUP = re.compile(r"([9X])\((\d+)\)")


def _expand_picture(pic: str) -> str:
    """``S9(3)V99`` -> ``S999V99``: repeat counts written out."""
    return _PIC_GROUP.sub(lambda m: m.group(1) * int(m.group(2)), pic)


def picture_type(pic: str) -> T.DataType:
    """Spark type for a COBOL PIC clause.

    ``X`` / ``X(n)`` is a string.  A numeric picture with ``i`` integer and
    ``f`` fraction digits is DECIMAL(i+f, f); with no fraction it is INT up
    to 9 digits, BIGINT up to 18, DECIMAL(n,0) beyond.  Usage clauses
    (``COMP``, ``COMP-3``) and the sign ``S`` do not change the type.
    """
    text = pic.strip().upper()
    text = re.sub(r"^PIC(TURE)?\s+", "", text)
    text = re.sub(r"\s+COMP(UTATIONAL)?(-\d)?\.?$", "", text).rstrip(".").strip()
    body = _expand_picture(text.replace(" ", ""))
    if re.fullmatch(r"X+", body):
        return T.StringType()
    m = re.fullmatch(r"S?(9*)(?:V(9*))?", body)
    if not m or not (m.group(1) or m.group(2)):
        raise ValueError(f"unsupported picture clause {pic!r}")
    i = len(m.group(1))
    f = len(m.group(2) or "")
    if f:
        return T.DecimalType(i + f, f)
    if i <= 9:
        return T.IntegerType()
    if i <= 18:
        return T.LongType()
    return T.DecimalType(i, 0)


def conform_picture(df: DataFrame, pictures: Mapping[str, str]) -> DataFrame:
    """Cast the named (text) columns by their PIC clause."""
    return conform(df, {c: picture_type(p) for c, p in pictures.items()})


def ddl_schema(columns: Mapping[str, str | T.DataType] | list) -> T.StructType:
    """StructType from ``{name: source_type}`` (or a list of pairs), names lower-cased."""
    items = columns.items() if isinstance(columns, Mapping) else columns
    return T.StructType(
        [T.StructField(name.lower(), as_spark_type(t), True) for name, t in items]
    )
