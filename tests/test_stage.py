import datetime as dt
from decimal import Decimal

from pyspark.sql import types as T

from loadwright.functions.types import ddl_schema
from loadwright.session import scratch_path
from loadwright.sources.stage import scan_stage, write_stage

SCHEMA = ddl_schema({"id": "INTEGER", "nm": "VARCHAR(10)", "dt": "DATE", "amt": "DECIMAL(5,2)"})

LINES = [
    "1|alpha|2020-01-31|12.50",  # clean
    "2|beta",  # short line: missing trailing fields
    "3|gamma|2020-02-01|1.00|extra|more",  # extra fields dropped
    "4|delta|2020-02-30|abc",  # bad date, bad number
    "5|\\N|\\N|\\N",  # explicit NULLs
    "6||||",  # empty strings
    '7|"quoted|2020-03-01|3',  # no quote handling: quote is data, field split at |
    "x|bad id|2020-03-02|123456.78",  # bad int, decimal overflow
]


def _write_lines(spark, name, lines):
    path = scratch_path(spark, name)
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    return path


def _stage_dir(spark):
    return _write_lines(spark, "stage_fixture", LINES)


def test_scan_stage_hive_text_rules(spark):
    df = scan_stage(spark, _stage_dir(spark), SCHEMA)
    assert df.schema == SCHEMA
    got = {(r.id if r.id is not None else r.nm): r.asDict() for r in df.collect()}
    assert got[1] == {"id": 1, "nm": "alpha", "dt": dt.date(2020, 1, 31), "amt": Decimal("12.50")}
    assert got[2] == {"id": 2, "nm": "beta", "dt": None, "amt": None}
    assert got[3] == {"id": 3, "nm": "gamma", "dt": dt.date(2020, 2, 1), "amt": Decimal("1.00")}
    assert got[4] == {"id": 4, "nm": "delta", "dt": None, "amt": None}
    assert got[5] == {"id": 5, "nm": None, "dt": None, "amt": None}
    assert got[6] == {"id": 6, "nm": "", "dt": None, "amt": None}
    assert got[7] == {"id": 7, "nm": '"quoted', "dt": dt.date(2020, 3, 1), "amt": Decimal("3.00")}
    assert got["bad id"] == {"id": None, "nm": "bad id", "dt": dt.date(2020, 3, 2), "amt": None}


def test_write_then_scan_round_trip(spark):
    schema = T.StructType(
        [T.StructField("k", T.LongType()), T.StructField("s", T.StringType()), T.StructField("v", T.DoubleType())]
    )
    df = spark.createDataFrame([(1, "a", 1.5), (2, None, None), (3, "", 0.1)], schema)
    path = scratch_path(spark, "roundtrip")
    write_stage(df, path)
    back = scan_stage(spark, path, schema)
    assert sorted(back.collect()) == sorted(df.collect())


def test_other_separator(spark):
    path = _write_lines(spark, "sep", ["1\ta.b", "2\t"])
    schema = ddl_schema({"k": "INTEGER", "s": "VARCHAR(5)"})
    got = sorted(scan_stage(spark, path, schema, sep="\t").collect())
    assert [tuple(r) for r in got] == [(1, "a.b"), (2, "")]
