"""DuckDB SQL equal to each registered query (tables are pre-registered views)."""

from __future__ import annotations

_ORDERS_COLS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"
_LINE_COLS = (
    "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, "
    "l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"
)
_LINE_ORDER = (
    "l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, "
    "l_tax, l_returnflag, l_linestatus"
)
_LINE_ORDER_DESC = ", ".join(f"{c.strip()} DESC" for c in _LINE_ORDER.split(","))

# orders: base placed before 2000, stage placed from 1999 on, price + 100.
_ORDERS_CTE = f"""
ob AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01'),
os_raw AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 100 AS o_totalprice,
         o_orderdate, o_orderpriority
  FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01'),
os AS (
  SELECT {_ORDERS_COLS} FROM (
    SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY o_orderdate DESC) AS rn
    FROM os_raw) t WHERE rn = 1)
"""

_LINES_CTE = f"""
lb AS (SELECT * FROM lineitem WHERE l_shipdate < TIMESTAMP '2000-01-01'),
ls_raw AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity + 1 AS l_quantity,
         l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate
  FROM lineitem WHERE l_shipdate >= TIMESTAMP '1999-01-01'),
ls AS (
  SELECT {_LINE_COLS} FROM (
    SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                 ORDER BY {_LINE_ORDER_DESC}) AS rn
    FROM ls_raw) t WHERE rn = 1)
"""

_HOT_ORDER_DESC = _LINE_ORDER_DESC + ", l_orderkey DESC, l_linenumber DESC"
_HOT = "CASE WHEN l_returnflag = 'A' THEN CAST(-1 AS BIGINT) ELSE l_orderkey END AS hot_key"
_HOT_CTE = f"""
hb AS (SELECT *, {_HOT} FROM lineitem WHERE l_shipdate < TIMESTAMP '2000-01-01'),
hs_raw AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity + 1 AS l_quantity,
         l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate, {_HOT}
  FROM lineitem WHERE l_shipdate >= TIMESTAMP '1999-01-01'),
hs AS (
  SELECT {_LINE_COLS}, hot_key FROM (
    SELECT *, row_number() OVER (PARTITION BY hot_key ORDER BY {_HOT_ORDER_DESC}) AS rn
    FROM hs_raw) t WHERE rn = 1)
"""

_YEARS_CTE = f"""
oy AS (SELECT *, CAST(year(o_orderdate) AS INTEGER) AS o_year FROM orders),
ps AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, CAST(1.0 AS DOUBLE) AS o_totalprice,
         o_orderdate, o_orderpriority, o_year
  FROM oy WHERE o_year IN (1996, 1997) AND o_orderstatus = 'O'),
pm AS (
  SELECT {_ORDERS_COLS}, CAST(1999 AS INTEGER) AS o_year FROM ps)
"""

_UPSERT = f"""
WITH {_ORDERS_CTE}
SELECT * FROM ob WHERE NOT EXISTS (SELECT 1 FROM os WHERE os.o_orderkey = ob.o_orderkey)
UNION ALL SELECT * FROM os
"""

_DELETE_WHERE = """
SELECT * FROM lineitem
WHERE NOT COALESCE(l_returnflag = 'A' AND l_quantity < 10, FALSE)
"""

_EVENTS_UNION_DISTINCT = """
SELECT DISTINCT * FROM (
  SELECT * FROM events WHERE ts < TIMESTAMP '2024-01-20'
  UNION ALL
  SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-15') t
"""

_NULLIF_CUSTOMER = (
    "SELECT c_custkey, c_name, NULLIF(c_nationkey, 3) AS c_nationkey, c_acctbal, c_mktsegment "
    "FROM customer"
)

_ORDERS_BY_YEAR = "SELECT *, CAST(year(o_orderdate) AS INTEGER) AS o_year FROM orders"


def _partitioned(stage: str, scope: str) -> str:
    if scope == "table":
        touched = (
            f"SELECT o_year FROM {stage} UNION "
            f"SELECT o_year FROM oy WHERE o_orderkey IN (SELECT o_orderkey FROM {stage})"
        )
    else:
        touched = f"SELECT o_year FROM {stage}"
    return f"""
WITH {_YEARS_CTE}, touched AS ({touched})
SELECT * FROM oy WHERE o_year NOT IN (SELECT o_year FROM touched)
UNION ALL
SELECT * FROM oy b WHERE b.o_year IN (SELECT o_year FROM touched)
  AND NOT EXISTS (SELECT 1 FROM {stage} s WHERE s.o_orderkey = b.o_orderkey)
UNION ALL SELECT * FROM {stage}
"""


ORACLE: dict[str, str] = {
    # dedup / windows
    "latest_per_key": f"""
        SELECT {_LINE_COLS} FROM (
          SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                       ORDER BY {_LINE_ORDER_DESC}) AS rn
          FROM lineitem) t WHERE rn = 1""",
    "with_sequence": f"""
        SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                     ORDER BY {_LINE_ORDER}) AS row_num
        FROM lineitem""",
    "with_sequence_hot_key": f"""
        SELECT *, row_number() OVER (PARTITION BY hot_key
                                     ORDER BY {_LINE_ORDER}, l_orderkey, l_linenumber) AS row_num
        FROM (SELECT *, {_HOT} FROM lineitem) l""",
    "select_distinct": """
        SELECT DISTINCT l_returnflag, l_linestatus, CAST(year(l_shipdate) AS INTEGER) AS ship_year
        FROM lineitem""",
    "distinct_table": _EVENTS_UNION_DISTINCT,
    "distinct_keys": "SELECT DISTINCT o_custkey FROM orders",
    # joins
    "unaffected": f"""
        WITH {_ORDERS_CTE}
        SELECT * FROM ob WHERE NOT EXISTS (SELECT 1 FROM os_raw s WHERE s.o_orderkey = ob.o_orderkey)""",
    "new_rows": f"""
        WITH {_ORDERS_CTE}
        SELECT * FROM os_raw s WHERE NOT EXISTS (SELECT 1 FROM ob WHERE ob.o_orderkey = s.o_orderkey)""",
    "matched_rows": f"""
        WITH {_ORDERS_CTE}
        SELECT * FROM os_raw s WHERE EXISTS (SELECT 1 FROM ob WHERE ob.o_orderkey = s.o_orderkey)""",
    "pair": f"""
        WITH {_ORDERS_CTE}
        SELECT s.o_orderkey, b.o_totalprice AS old_price, s.o_totalprice AS new_price
        FROM os_raw s JOIN ob b ON s.o_orderkey = b.o_orderkey""",
    "affected_partitions": f"""
        WITH {_YEARS_CTE}
        SELECT * FROM oy WHERE o_year IN (SELECT o_year FROM ps)""",
    "unaffected_in_partitions": f"""
        WITH {_YEARS_CTE}
        SELECT * FROM oy b WHERE o_year IN (SELECT o_year FROM ps)
          AND NOT EXISTS (SELECT 1 FROM ps s WHERE s.o_orderkey = b.o_orderkey)""",
    "matching": """
        SELECT * FROM lineitem l WHERE EXISTS (
          SELECT 1 FROM orders o WHERE o.o_orderstatus = 'F' AND o.o_orderkey = l.l_orderkey)""",
    "not_in_null_aware": f"""
        WITH c AS ({_NULLIF_CUSTOMER}),
        s AS (
          SELECT NULLIF(s_nationkey, 5) AS s_nationkey,
                 CASE WHEN s_nationkey < 10 THEN 'HOUSEHOLD'
                      WHEN s_nationkey < 20 THEN 'MACHINERY' ELSE 'BUILDING' END AS s_segment
          FROM supplier)
        SELECT * FROM c
        WHERE c.c_nationkey NOT IN (SELECT s.s_nationkey FROM s WHERE s.s_segment = c.c_mktsegment)""",
    # filters
    "where_all": "SELECT * FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus <> 'F'",
    "where_range": "SELECT * FROM lineitem WHERE l_returnflag = 'A' AND l_quantity < 10",
    "exclude": f"SELECT * FROM ({_NULLIF_CUSTOMER}) c WHERE NOT COALESCE(c_nationkey < 10, FALSE)",
    # projections / scalar
    "conform": """
        SELECT TRY_CAST(CAST(c_custkey AS VARCHAR) AS BIGINT) AS c_custkey,
               c_name,
               TRY_CAST(CAST(c_nationkey AS VARCHAR) AS TINYINT) AS c_nationkey,
               TRY_CAST(CAST(c_acctbal AS VARCHAR) AS DECIMAL(7, 2)) AS c_acctbal,
               c_mktsegment,
               TRY_CAST(c_name AS INTEGER) AS name_as_int
        FROM customer""",
    "conform_picture": """
        SELECT p_partkey,
               TRY_CAST(CAST(p_retailprice AS VARCHAR) AS DECIMAL(7, 2)) AS price_7_2,
               TRY_CAST(CAST(p_retailprice AS VARCHAR) AS DECIMAL(5, 2)) AS price_5_2,
               TRY_CAST(CAST(p_size AS VARCHAR) AS INTEGER) AS size_int,
               p_name AS name_x
        FROM part""",
    "rename": """
        SELECT p_partkey AS mds_fam_id, p_name, p_brand, p_type, p_size, p_retailprice FROM part""",
    "lower_names": "SELECT * FROM part",
    "map_columns": """
        SELECT c_custkey AS cust_id, upper(c_name) AS cust_name, c_nationkey AS nation,
               c_acctbal * 2 AS balance
        FROM customer""",
    "concat_cols": "SELECT c_custkey, c_mktsegment || '-' || c_name AS seg_name FROM customer",
    "substr_col": "SELECT c_custkey, substr(c_name, 10, 9) AS name_no FROM customer",
    "parse_date": """
        SELECT o_orderkey,
               CAST(o_orderdate AS DATE) AS d_yyyymmdd,
               CAST(o_orderdate AS DATE) AS d_yymmdd,
               CAST(o_orderdate AS DATE) AS d_iso,
               CAST(o_orderdate AS DATE) AS d_yyyyddd,
               CAST(o_orderdate AS DATE) AS d_us,
               CAST(o_orderdate AS DATE) AS d_us_dash
        FROM orders""",
    "sentinel_date": """
        SELECT o_orderkey,
               CASE WHEN o_orderstatus = 'O' THEN DATE '2500-01-01'
                    ELSE CAST(o_orderdate AS DATE) END AS end_dt
        FROM orders""",
    "set_literal": """
        SELECT c_custkey, c_name, c_nationkey, CAST(0 AS DOUBLE) AS c_acctbal, c_mktsegment
        FROM customer""",
    "accumulate": f"""
        WITH {_ORDERS_CTE}
        SELECT s.o_orderkey, s.o_custkey, s.o_orderstatus,
               b.o_totalprice + s.o_totalprice AS o_totalprice, s.o_orderdate, s.o_orderpriority
        FROM os_raw s JOIN ob b ON s.o_orderkey = b.o_orderkey""",
    "fill_from_base": f"""
        WITH {_ORDERS_CTE}
        SELECT s.o_orderkey, b.o_custkey, b.o_orderstatus, s.o_totalprice, b.o_orderdate,
               b.o_orderpriority
        FROM os_raw s LEFT JOIN ob b ON s.o_orderkey = b.o_orderkey""",
    # load patterns
    "upsert": _UPSERT,
    "upsert_dedup": f"""
        WITH {_LINES_CTE}
        SELECT * FROM lb WHERE NOT EXISTS (
          SELECT 1 FROM ls WHERE ls.l_orderkey = lb.l_orderkey AND ls.l_linenumber = lb.l_linenumber)
        UNION ALL SELECT * FROM ls""",
    "upsert_accumulate": f"""
        WITH {_ORDERS_CTE}
        SELECT * FROM ob WHERE NOT EXISTS (SELECT 1 FROM os WHERE os.o_orderkey = ob.o_orderkey)
        UNION ALL
        SELECT * FROM os WHERE NOT EXISTS (SELECT 1 FROM ob WHERE ob.o_orderkey = os.o_orderkey)
        UNION ALL
        SELECT os.o_orderkey, os.o_custkey, os.o_orderstatus,
               ob.o_totalprice + os.o_totalprice AS o_totalprice, os.o_orderdate, os.o_orderpriority
        FROM os JOIN ob ON os.o_orderkey = ob.o_orderkey""",
    "latest_per_hot_key": f"""
        SELECT {_LINE_COLS}, hot_key FROM (
          SELECT *, row_number() OVER (PARTITION BY hot_key ORDER BY {_HOT_ORDER_DESC}) AS rn
          FROM (SELECT *, {_HOT} FROM lineitem) l) t WHERE rn = 1""",
    "upsert_hot_key": f"""
        WITH {_HOT_CTE}
        SELECT * FROM hb WHERE NOT EXISTS (SELECT 1 FROM hs WHERE hs.hot_key = hb.hot_key)
        UNION ALL SELECT * FROM hs""",
    "upsert_accumulate_hot_key": f"""
        WITH {_HOT_CTE}
        SELECT * FROM hb WHERE NOT EXISTS (SELECT 1 FROM hs WHERE hs.hot_key = hb.hot_key)
        UNION ALL
        SELECT * FROM hs WHERE NOT EXISTS (SELECT 1 FROM hb WHERE hb.hot_key = hs.hot_key)
        UNION ALL
        SELECT hs.l_orderkey, hs.l_partkey, hs.l_suppkey, hs.l_linenumber,
               hb.l_quantity + hs.l_quantity AS l_quantity, hs.l_extendedprice, hs.l_discount,
               hs.l_tax, hs.l_returnflag, hs.l_linestatus, hs.l_shipdate, hs.hot_key
        FROM hs JOIN hb ON hs.hot_key = hb.hot_key""",
    "upsert_partial": f"""
        WITH {_ORDERS_CTE}
        SELECT ob.o_orderkey, ob.o_custkey, ob.o_orderstatus,
               CASE WHEN os.o_orderkey IS NOT NULL THEN os.o_totalprice ELSE ob.o_totalprice END
                 AS o_totalprice,
               ob.o_orderdate, ob.o_orderpriority
        FROM ob LEFT JOIN os ON ob.o_orderkey = os.o_orderkey
        UNION ALL
        SELECT os.o_orderkey, NULL, NULL, os.o_totalprice, NULL, NULL
        FROM os WHERE NOT EXISTS (SELECT 1 FROM ob WHERE ob.o_orderkey = os.o_orderkey)""",
    "upsert_partitioned": _partitioned("ps", "partition"),
    "upsert_partition_move": _partitioned("pm", "partition"),
    "upsert_partitioned_table": _partitioned("pm", "table"),
    "update_where": """
        SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
               CASE WHEN l_returnflag = 'R' AND l_linestatus <> 'F' THEN CAST(0 AS DOUBLE)
                    ELSE l_discount END AS l_discount,
               l_tax, l_returnflag, l_linestatus, l_shipdate
        FROM lineitem""",
    "update_from": """
        SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
               l_discount,
               CASE WHEN EXISTS (SELECT 1 FROM orders o
                                 WHERE o.o_orderstatus = 'F' AND o.o_orderkey = l.l_orderkey)
                    THEN CAST(0 AS DOUBLE) ELSE l_tax END AS l_tax,
               l_returnflag, l_linestatus, l_shipdate
        FROM lineitem l""",
    "delete_where": _DELETE_WHERE,
    "delete_from": """
        SELECT * FROM lineitem l WHERE NOT EXISTS (
          SELECT 1 FROM orders o WHERE o.o_orderstatus = 'F' AND o.o_orderkey = l.l_orderkey)""",
    "append_distinct": _EVENTS_UNION_DISTINCT,
    "append_distinct_incremental": _EVENTS_UNION_DISTINCT,
    "full_refresh": """
        SELECT DISTINCT c_mktsegment, substr(c_name, 1, 8) AS name8,
               c_mktsegment || '-' || CAST(c_nationkey AS VARCHAR) AS seg_nation,
               CASE WHEN c_nationkey = 3 THEN DATE '2500-01-01' END AS end_dt
        FROM customer""",
    "insert_select": """
        SELECT c_custkey AS id, c_name AS name FROM customer
        UNION ALL SELECT s_suppkey, s_name FROM supplier""",
    "stack": f"""
        WITH {_ORDERS_CTE}
        SELECT * FROM ob WHERE NOT EXISTS (SELECT 1 FROM os_raw s WHERE s.o_orderkey = ob.o_orderkey)
        UNION ALL
        SELECT * FROM os_raw s WHERE NOT EXISTS (SELECT 1 FROM ob WHERE ob.o_orderkey = s.o_orderkey)
        UNION ALL
        SELECT * FROM os_raw s WHERE EXISTS (SELECT 1 FROM ob WHERE ob.o_orderkey = s.o_orderkey)""",
    "apply_load": _UPSERT,
    "apply_load_delete": _DELETE_WHERE,
    "run_load_upsert": _UPSERT,
    "upsert_bucketed": _UPSERT,
    "update_partitioned": f"""
        SELECT o_orderkey, o_custkey, o_orderstatus,
               CASE WHEN o_orderstatus = 'P' AND o_year = 1997 THEN CAST(0 AS DOUBLE)
                    ELSE o_totalprice END AS o_totalprice,
               o_orderdate, o_orderpriority, o_year
        FROM ({_ORDERS_BY_YEAR}) t""",
    "delete_partitioned": f"""
        SELECT * FROM ({_ORDERS_BY_YEAR}) t
        WHERE NOT COALESCE(o_orderdate < TIMESTAMP '1996-01-01'
                           OR (o_year = 1996 AND o_orderstatus = 'F'), FALSE)""",
    "run_load_partitioned": _partitioned("ps", "partition"),
    # sources / sinks
    "scan_stage": "SELECT * FROM customer",
    "history_load": "SELECT * FROM customer",
    "history_load_partitioned": "SELECT * FROM customer",
    "append": """
        SELECT * FROM customer
        UNION ALL SELECT s_suppkey, s_name, s_nationkey, s_acctbal, 'SUPPLIER' FROM supplier""",
    "append_partitioned": _ORDERS_BY_YEAR,
    "overwrite_partitions": f"""
        SELECT * FROM ({_ORDERS_BY_YEAR}) t
        WHERE o_year NOT IN (1996, 1997) OR o_orderstatus = 'F'""",
    "scan_base": "SELECT * FROM orders",
    "swap_in": "SELECT * FROM orders WHERE o_orderstatus = 'O'",
    "overwrite": """
        SELECT o_orderkey, o_custkey,
               CASE WHEN o_orderstatus = 'P' THEN 'F' ELSE o_orderstatus END AS o_orderstatus,
               o_totalprice, o_orderdate, o_orderpriority
        FROM orders""",
    "stream_upsert": _UPSERT,
    "global_sequence": "SELECT *, row_number() OVER (ORDER BY o_orderkey) AS row_num FROM orders",
    "with_sequence_hot_key_salted": """
        SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS row_num FROM orders""",
    "unaffected_null_keys": f"""
        WITH {_ORDERS_CTE}
        SELECT CASE WHEN o_orderstatus <> 'F' THEN o_orderkey END AS o_orderkey, * EXCLUDE (o_orderkey) FROM ob
        WHERE o_orderstatus = 'F' OR NOT EXISTS (SELECT 1 FROM os_raw s WHERE s.o_orderkey = ob.o_orderkey)""",
    "update_from_null_keys": f"""
        WITH {_ORDERS_CTE}
        SELECT CASE WHEN o_orderstatus <> 'F' THEN o_orderkey END AS o_orderkey, * EXCLUDE (o_orderkey)
          REPLACE (CASE WHEN o_orderstatus <> 'F' AND EXISTS (SELECT 1 FROM os_raw s WHERE s.o_orderkey = ob.o_orderkey)
            THEN 0.0 ELSE o_totalprice END AS o_totalprice) FROM ob""",
    "upsert_accumulate_partitioned": f"""
        WITH {_YEARS_CTE}, t AS (SELECT o_year FROM pm UNION SELECT o_year FROM oy WHERE o_orderkey IN (SELECT o_orderkey FROM pm))
        SELECT oy.* FROM oy WHERE o_year IN (SELECT o_year FROM t) AND o_orderkey NOT IN (SELECT o_orderkey FROM pm)
        UNION ALL
        SELECT pm.* REPLACE (oy.o_totalprice + pm.o_totalprice AS o_totalprice) FROM pm JOIN oy ON pm.o_orderkey = oy.o_orderkey""",
    "upsert_partial_partitioned": f"""
        WITH {_YEARS_CTE}
        SELECT oy.* REPLACE (coalesce(ps.o_totalprice, oy.o_totalprice) AS o_totalprice)
        FROM oy LEFT JOIN ps ON ps.o_orderkey = oy.o_orderkey WHERE oy.o_year IN (SELECT o_year FROM ps)""",
    "upsert_type_kept": f"""
        SELECT * REPLACE (CAST(o_custkey AS INTEGER) AS o_custkey), 'int' AS type FROM ({_UPSERT})""",
    "insert_select_partitioned": f"""
        WITH {_YEARS_CTE} SELECT * FROM oy UNION ALL SELECT * FROM pm""",
    "stream_history": f"""
        WITH {_ORDERS_CTE} SELECT * FROM ob UNION ALL SELECT * FROM os_raw""",
}
ORACLE["swap_recovered"] = ORACLE["upsert_accumulate"]
ORACLE["upsert_accumulate_one_pass"] = ORACLE["upsert_accumulate_hot_key"]
ORACLE["upsert_partial_one_pass"] = ORACLE["upsert_partial"]
ORACLE["run_load_upsert_detects_partition"] = ORACLE["upsert_partitioned_table"]
ORACLE["upsert_touched_files"] = ORACLE["upsert_accumulate"]
ORACLE["delete_touched_files"] = "SELECT * FROM orders WHERE NOT COALESCE(o_orderkey < 1000 AND o_orderstatus <> 'O', FALSE)"
ORACLE["append_replayed"] = """
    SELECT c_custkey AS id, c_name AS name FROM customer
    UNION ALL SELECT s_suppkey, s_name FROM supplier
    UNION ALL SELECT c_custkey, c_name FROM customer"""
ORACLE["swap_recovered_folder"] = "SELECT * FROM orders WHERE o_orderstatus = 'O'"
ORACLE["affected_partitions_wide"] = """
    SELECT *, CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS o_month
    FROM orders WHERE month(o_orderdate) % 2 = 1"""
ORACLE["not_in_one_pass"] = ORACLE["not_in_null_aware"]
ORACLE["upsert_not_in"] = f"""
    WITH {_ORDERS_CTE},
    b AS (SELECT * REPLACE (nullif(o_orderstatus, 'P') AS o_orderstatus) FROM ob),
    s AS (SELECT * REPLACE (nullif(o_orderstatus, 'F') AS o_orderstatus) FROM os)
    SELECT * FROM b WHERE b.o_orderstatus NOT IN (SELECT s.o_orderstatus FROM s WHERE s.o_orderkey = b.o_orderkey)
    UNION ALL SELECT * FROM s"""
ORACLE["update_from_mapped"] = """
    SELECT * REPLACE (CASE WHEN l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')
                           THEN CAST(0 AS DOUBLE) ELSE l_discount END AS l_discount)
    FROM lineitem"""
