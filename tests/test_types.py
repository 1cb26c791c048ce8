import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import types as T

from loadwright.functions import dates as D
from loadwright.functions import types as TY
from tests.conftest import rows


@pytest.mark.parametrize(
    "src,expected",
    [
        ("BYTEINT", T.ByteType()),
        ("smallint", T.ShortType()),
        ("INTEGER", T.IntegerType()),
        ("int(11)", T.IntegerType()),
        ("BIGINT", T.LongType()),
        ("DECIMAL(18,4)", T.DecimalType(18, 4)),
        ("numeric(9)", T.DecimalType(9, 0)),
        ("DECIMAL", T.DecimalType(10, 0)),
        ("FLOAT", T.DoubleType()),
        ("CHAR(3)", T.StringType()),
        ("VARCHAR(200)", T.StringType()),
        ("DATE", T.DateType()),
        ("TIME(0)", T.StringType()),
        ("TIMESTAMP(6)", T.TimestampNTZType()),
    ],
)
def test_type_map(src, expected):
    assert TY.spark_type(src) == expected


def test_unknown_type_raises():
    with pytest.raises(ValueError):
        TY.spark_type("BLOB")
    with pytest.raises(ValueError):
        TY.spark_type("")


@pytest.mark.parametrize(
    "pic,expected",
    [
        ("S9(4) COMP", T.IntegerType()),
        ("S9(9)", T.IntegerType()),
        ("S9(12)", T.LongType()),
        ("S9(20)", T.DecimalType(20, 0)),
        ("X", T.StringType()),
        ("X(10)", T.StringType()),
        ("S9(5)V99 COMP-3.", T.DecimalType(7, 2)),
        ("S9(3)V9(4)", T.DecimalType(7, 4)),
        ("S999V99", T.DecimalType(5, 2)),
        ("PIC S9(7)V99", T.DecimalType(9, 2)),
    ],
)
def test_picture_type(pic, expected):
    assert TY.picture_type(pic) == expected


def test_picture_precision_keeps_all_digits(spark):
    df = spark.createDataFrame([("12345.67",), ("1.5",), ("x",)], "v string")
    out = TY.conform_picture(df, {"v": "S9(5)V99"})
    assert out.schema["v"].dataType == T.DecimalType(7, 2)
    assert rows(out) == [(None,), (Decimal("1.50"),), (Decimal("12345.67"),)]
    # five integer digits do not fit three
    out = TY.conform_picture(df, {"v": "S9(3)V99"})
    assert rows(out) == [(None,), (None,), (Decimal("1.50"),)]


def test_conform_bad_values_null(spark):
    df = spark.createDataFrame([("1", "2020-02-30", "abc", "1.239")], "a string, b string, c string, d string")
    out = TY.conform(df, {"a": "INTEGER", "b": "DATE", "c": "INTEGER", "d": "DECIMAL(5,2)"})
    assert out.collect()[0].asDict() == {"a": 1, "b": None, "c": None, "d": Decimal("1.24")}


@pytest.mark.parametrize(
    "fmt,text,expected",
    [
        ("yyyymmdd", "19980715", dt.date(1998, 7, 15)),
        ("yymmdd", "980715", dt.date(1998, 7, 15)),
        ("yymmdd", "010715", dt.date(2001, 7, 15)),
        ("yyyy-mm-dd", "1998-07-15", dt.date(1998, 7, 15)),
        ("yyyyddd", "1998196", dt.date(1998, 7, 15)),
        ("mm/dd/yyyy", "07/15/1998", dt.date(1998, 7, 15)),
        ("mm-dd-yyyy", "07-15-1998", dt.date(1998, 7, 15)),
        ("yyyymmdd", "19981345", None),
        ("yyyymmdd", "junk", None),
    ],
)
def test_parse_date(spark, fmt, text, expected):
    df = spark.createDataFrame([(text,)], "s string")
    assert df.select(D.parse_date("s", fmt).alias("d")).collect()[0].d == expected


def test_sentinel_and_td_codes(spark):
    df = spark.createDataFrame([(6000101,), (980715,), (1010715,), (None,)], "c int")
    got = rows(df.select("c", D.sentinel_date("c").alias("d")))
    assert got == [
        (None, None),
        (980715, dt.date(1998, 7, 15)),
        (1010715, dt.date(2001, 7, 15)),
        (6000101, dt.date(2500, 1, 1)),
    ]
