"""Every query against its SQL on sf0.001 and on the edge cases, and on empty tables."""

import duckdb
import pytest

from loadwright.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


def normal(v):
    return "\0" if v is None else f"{v:.9g}" if isinstance(v, float) else str(v)


def table_rows(cols, records):
    return sorted(tuple(normal(r[c]) for c in cols) for r in records)


def by_sql(folder, sql):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels", "pages", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    rel = con.sql(sql)
    return rel.columns, [dict(zip(rel.columns, r, strict=True)) for r in rel.fetchall()]


@pytest.mark.parametrize("name", sorted(ORACLE))
@pytest.mark.parametrize("data", ["sf", "edge"])
def test_same_rows_as_sql(spark, edge_dir, name, data):
    folder = SF if data == "sf" else edge_dir
    df = QUERIES[name](spark, folder)
    cols, expected = by_sql(folder, ORACLE[name])
    assert sorted(cols) == sorted(df.columns)
    cols = sorted(cols)
    assert table_rows(cols, [r.asDict() for r in df.collect()]) == table_rows(cols, expected)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, empty_dir, name):
    assert QUERIES[name](spark, empty_dir).collect() == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_edge_cases_give_a_row_each(spark, edge_dir, name):
    df = QUERIES[name](spark, edge_dir)
    source = "pages" if "page_id" in df.columns else "documents"
    assert df.count() == spark.read.parquet(f"{edge_dir}/{source}.parquet").count()
