"""Independent DuckDB SQL for every relational query in the registry.

The CTEs below derive the basket tables from the driver's views (orders,
lineitem, part, events) exactly as ``cartlake.sources.fixtures`` does with
Spark; each query body then states the operator in plain SQL.  Types are cast
to Spark's result types (int / bigint / double / float).
"""

from __future__ import annotations

FIXTURE_CTES = """
f_orders AS (
  SELECT o_orderkey::INTEGER AS order_id, o_custkey::INTEGER AS user_id,
         CASE WHEN rn < mx THEN 'prior' WHEN o_custkey % 2 = 0 THEN 'train' ELSE 'test' END AS eval_set,
         rn::INTEGER AS order_number, dayofweek(o_orderdate)::INTEGER AS order_dow,
         (o_orderkey % 24)::INTEGER AS order_hour_of_day,
         date_diff('day', prev::DATE, o_orderdate::DATE)::INTEGER AS days_since_prior
  FROM (SELECT *, row_number() OVER w AS rn, count(*) OVER (PARTITION BY o_custkey) AS mx,
               lag(o_orderdate) OVER w AS prev
        FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey))
),
f_lines AS (
  SELECT o.order_id, l.l_partkey::INTEGER AS product_id, o.user_id, o.eval_set, o.order_number,
         row_number() OVER (PARTITION BY l.l_orderkey
                            ORDER BY l.l_linenumber, l.l_partkey, l.l_suppkey)::INTEGER AS add_to_cart_order
  FROM (SELECT l_orderkey, l_partkey, min(l_linenumber) AS l_linenumber, min(l_suppkey) AS l_suppkey
        FROM lineitem GROUP BY 1, 2) l
  JOIN f_orders o ON o.order_id = l.l_orderkey
),
f_op AS (
  SELECT order_id, product_id, add_to_cart_order,
         CASE WHEN row_number() OVER (PARTITION BY user_id, product_id ORDER BY order_number) > 1
              THEN 'true' ELSE 'false' END AS reordered,
         eval_set
  FROM f_lines
),
f_op_prior AS (SELECT order_id, product_id, add_to_cart_order, reordered FROM f_op WHERE eval_set = 'prior'),
f_op_train AS (SELECT order_id, product_id, add_to_cart_order, reordered FROM f_op WHERE eval_set = 'train'),
f_opn_prior AS (
  SELECT order_id, product_id, add_to_cart_order,
         (CASE WHEN lower(reordered) = 'true' THEN 1 WHEN lower(reordered) = 'false' THEN 0 END)::INTEGER AS reordered
  FROM f_op_prior),
f_opn_train AS (
  SELECT order_id, product_id, add_to_cart_order,
         (CASE WHEN lower(reordered) = 'true' THEN 1 WHEN lower(reordered) = 'false' THEN 0 END)::INTEGER AS reordered
  FROM f_op_train),
f_order_products AS (SELECT * FROM f_opn_prior UNION ALL SELECT * FROM f_opn_train),
f_opp AS (
  SELECT o.*, op.product_id, op.add_to_cart_order, op.reordered
  FROM f_orders o JOIN f_order_products op ON o.order_id = op.order_id
  WHERE o.eval_set = 'prior'),
f_products AS (
  SELECT p_partkey::INTEGER AS product_id, p_name AS product_name, p_size::INTEGER AS aisle_id,
         replace(p_brand, 'Brand#', '')::INTEGER AS department_id
  FROM part),
f_aisles AS (SELECT DISTINCT aisle_id, 'aisle ' || aisle_id::VARCHAR AS aisle FROM f_products),
f_departments AS (SELECT DISTINCT department_id, 'department ' || department_id::VARCHAR AS department
                  FROM f_products),
f_target AS (SELECT *, 0::DOUBLE AS updated_at FROM f_products),
f_updates AS (
  SELECT (CASE WHEN p_partkey % 20 = 0 THEN p_partkey ELSE p_partkey + 1000000 END)::INTEGER AS product_id,
         CASE WHEN p_partkey % 40 = 0 THEN NULL ELSE 'new ' || p_name END AS product_name,
         (p_size + 1)::INTEGER AS aisle_id, 99::INTEGER AS department_id, 1::DOUBLE AS updated_at
  FROM part WHERE p_partkey % 10 = 0),
f_flags AS (
  SELECT l_orderkey::INTEGER AS order_id, l_partkey::INTEGER AS product_id,
         l_linenumber::INTEGER AS add_to_cart_order,
         CASE WHEN l_returnflag = 'R' THEN 'TRUE' WHEN l_returnflag = 'A' THEN 'False'
              WHEN l_linestatus = 'F' THEN 'unknown' END AS reordered
  FROM lineitem),
f_history AS (
  SELECT ts AS made_current_at, event_id AS snapshot_id,
         CASE WHEN event_id > 0 THEN event_id - 1 END AS parent_id, true AS is_current_ancestor
  FROM events),
f_snapshots AS (
  SELECT ts AS committed_at, event_id AS snapshot_id,
         CASE WHEN event_id > 0 THEN event_id - 1 END AS parent_id, event_type AS operation,
         'snap-' || event_id::VARCHAR || '.avro' AS manifest_list,
         CASE WHEN event_id % 7 = 0 THEN MAP {}::MAP(VARCHAR, VARCHAR)
              ELSE MAP {'spark.app.id': 'app-' || user_id::VARCHAR} END AS summary
  FROM events),
f_changes AS (
  SELECT p_partkey::INTEGER AS product_id, 'v1 ' || p_name AS product_name, p_size::INTEGER AS aisle_id,
         1::INTEGER AS department_id, 1::DOUBLE AS updated_at, 'U' AS op, 1::BIGINT AS seq
  FROM part WHERE p_partkey % 5 = 0
  UNION ALL
  SELECT p_partkey::INTEGER, 'v2 ' || p_name, (p_size + 1)::INTEGER, 1, 2::DOUBLE, 'U', 2 FROM part
  WHERE p_partkey % 10 = 0
  UNION ALL
  SELECT p_partkey::INTEGER, NULL, NULL, NULL, 3::DOUBLE, 'D', 3 FROM part WHERE p_partkey % 15 = 0
  UNION ALL
  SELECT (p_partkey + 1000000)::INTEGER, 'new ' || p_name, p_size::INTEGER, 2, 1::DOUBLE, 'I', 1 FROM part
  WHERE p_partkey % 25 = 0),
f_latest AS (
  SELECT * FROM f_changes QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY seq DESC) = 1),
f_applied AS (
  SELECT product_id, product_name, aisle_id, department_id, updated_at FROM f_latest WHERE op <> 'D'
  UNION ALL
  SELECT * FROM f_target t
  WHERE NOT EXISTS (SELECT 1 FROM f_latest l WHERE l.product_id = t.product_id))
"""


def with_fixtures(body: str) -> str:
    return "WITH " + FIXTURE_CTES.strip() + "\n" + body.strip()


# Fixed test clock for stamped columns (epoch seconds).
TEST_EPOCH = 1_700_000_000.0

_PRD = """
SELECT product_id, count(*)::BIGINT AS total_purchases,
       sum(CASE WHEN reordered = 1 THEN 1 ELSE 0 END)::BIGINT AS total_reorders,
       sum(CASE WHEN seq = 1 THEN 1 ELSE 0 END)::BIGINT AS first_time_purchases,
       sum(CASE WHEN seq = 2 THEN 1 ELSE 0 END)::BIGINT AS second_time_purchases
FROM (SELECT *, row_number() OVER (PARTITION BY user_id, product_id ORDER BY order_number) AS seq FROM f_opp)
GROUP BY product_id
"""

_UF1 = """
SELECT user_id, max(order_number)::INTEGER AS max_order_num,
       sum(days_since_prior)::BIGINT AS sum_days_since_prior_order,
       avg(days_since_prior)::DOUBLE AS avg_days_since_prior_order
FROM f_orders GROUP BY user_id
"""

_UF2 = """
SELECT user_id, count(product_id)::BIGINT AS total_number_products,
       count(DISTINCT product_id)::BIGINT AS total_number_distinct_products,
       (sum(CASE WHEN reordered = 1 THEN 1 ELSE 0 END)::DOUBLE
          / nullif(count(CASE WHEN order_number > 1 THEN 1 END), 0))::DOUBLE AS user_reorder_ratio
FROM f_opp GROUP BY user_id
"""

_UP = """
SELECT user_id, product_id, count(order_id)::BIGINT AS total_number_orders,
       min(order_number)::INTEGER AS min_order_number, max(order_number)::INTEGER AS max_order_number,
       avg(add_to_cart_order)::DOUBLE AS avg_add_to_cart_order
FROM f_opp GROUP BY user_id, product_id
"""

_MERGED = """
SELECT * FROM f_updates
UNION ALL
SELECT * FROM f_target t WHERE NOT EXISTS (SELECT 1 FROM f_updates u WHERE u.product_id = t.product_id)
"""

_MESSY = """
, m_target AS (
  SELECT * FROM f_target UNION ALL SELECT NULL, product_name, aisle_id, department_id, updated_at FROM f_target WHERE product_id % 60 = 1),
m_updates AS (
  SELECT * FROM f_updates
  UNION ALL SELECT NULL, product_name, aisle_id, department_id, updated_at FROM f_target WHERE product_id % 50 = 7
  UNION ALL SELECT (product_id + 2000000)::INTEGER, product_name, aisle_id, department_id, stamp::DOUBLE
            FROM f_target, (VALUES (2), (3)) times(stamp) WHERE product_id % 30 = 11)
SELECT * FROM m_updates
UNION ALL
SELECT * FROM m_target t WHERE NOT EXISTS (SELECT 1 FROM m_updates u WHERE u.product_id = t.product_id)
"""

_KEYED = """
, m_changes AS (
  SELECT * FROM f_changes
  UNION ALL SELECT NULL, product_name, aisle_id, department_id, updated_at, 'U', product_id FROM f_target WHERE product_id % 100 = 3),
m_latest AS (SELECT * FROM m_changes QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY seq DESC) = 1)
SELECT product_id, product_name, aisle_id, department_id, updated_at FROM m_latest WHERE op <> 'D'
UNION ALL
SELECT * FROM f_target t WHERE NOT EXISTS (SELECT 1 FROM m_latest l WHERE l.product_id IS NOT DISTINCT FROM t.product_id)
"""

#: table -> (rows, its columns in the order of their names; those with * are floating-point)
_BASKET = "add_to_cart_order order_id product_id reordered"
_SILVER_COLUMNS = {
    "products": "aisle_id department_id product_id product_name", "aisles": "aisle aisle_id",
    "departments": "department department_id",
    "orders": "days_since_prior eval_set order_dow order_hour_of_day order_id order_number user_id",
    "order_products__prior": _BASKET, "order_products__train": _BASKET, "order_products": _BASKET,
    "order_products_prior": "add_to_cart_order days_since_prior eval_set order_dow order_hour_of_day order_id order_number product_id reordered user_id",
    "user_features_1": "avg_days_since_prior_order* max_order_num sum_days_since_prior_order user_id",
    "user_features_2": "total_number_distinct_products total_number_products user_id user_reorder_ratio*",
    "up_features": "avg_add_to_cart_order* max_order_number min_order_number product_id total_number_orders user_id",
    "prd_features": "first_time_purchases product_id second_time_purchases total_purchases total_reorders",
}
_SILVER = {
    "products": "SELECT * FROM f_products", "aisles": "SELECT * FROM f_aisles", "departments": "SELECT * FROM f_departments",
    "orders": "SELECT * FROM f_orders", "order_products__prior": "SELECT * FROM f_opn_prior",
    "order_products__train": "SELECT * FROM f_opn_train", "order_products": "SELECT * FROM f_order_products",
    "order_products_prior": "SELECT * FROM f_opp", "user_features_1": _UF1, "user_features_2": _UF2, "up_features": _UP,
    "prd_features": _PRD,
}


def _digests(tables: dict[str, str]) -> str:
    """The content digest of each table, in plain SQL."""
    def text(column: str) -> str:
        value = f"floor({column[:-1]} * 1000000 + 0.5)::BIGINT" if column.endswith("*") else column
        return f"coalesce({value}::VARCHAR, '\u2205')"

    def one(name: str, rows: str) -> str:
        line = " || '|' || ".join(text(c) for c in _SILVER_COLUMNS[name].split())
        return (f"SELECT '{name}' AS table_name, count(*)::BIGINT AS n_rows, "
                f"coalesce(sum(('0x' || substr(md5({line}), 1, 15))::BIGINT), 0)::VARCHAR AS digest FROM ({rows})")
    return " UNION ALL ".join(one(*x) for x in tables.items())


ORACLE_BODIES: dict[str, str] = {
    # ---- projections / filters
    "normalize_bool_flag": """
        SELECT order_id, product_id, add_to_cart_order,
               (CASE WHEN lower(reordered) = 'true' THEN 1 WHEN lower(reordered) = 'false' THEN 0 END)::INTEGER
                 AS reordered
        FROM f_flags""",
    "filter_eq": "SELECT * FROM f_orders WHERE eval_set = 'prior'",
    "filter_not_null": "SELECT * FROM f_orders WHERE days_since_prior IS NOT NULL",
    "filter_or": "SELECT * FROM f_products WHERE product_id < 25 OR product_id = 140 OR product_id > 1900",
    "filter_range": "SELECT * FROM f_products WHERE product_id > 120 AND product_id < 170",
    "case_flag_else": """
        SELECT order_id, product_id, (CASE WHEN reordered = 1 THEN 1 ELSE 0 END)::INTEGER AS reordered_flag
        FROM f_opp""",
    "case_flag_null": """
        SELECT order_id, product_id, (CASE WHEN order_number > 1 THEN 1 END)::INTEGER AS repeat_order_flag
        FROM f_opp""",
    "literal_column": f"SELECT *, {TEST_EPOCH}::DOUBLE AS updated_at FROM f_products",
    # ---- union / join
    "order_products_union": "SELECT * FROM f_order_products",
    "order_products_prior": "SELECT * FROM f_opp",
    # ---- aggregates
    "user_features_1": _UF1,
    "user_features_2": _UF2,
    "up_features": _UP,
    "prd_features": _PRD,
    "product_seq_time": """
        SELECT *, row_number() OVER (PARTITION BY user_id, product_id
                                     ORDER BY order_number, order_id, add_to_cart_order)
                    AS product_seq_time
        FROM f_opp""",
    "product_seq_time_hot": """
        SELECT *, row_number() OVER (PARTITION BY user_id, product_id ORDER BY order_number, order_id, add_to_cart_order)
                    AS product_seq_time
        FROM (SELECT * REPLACE (CASE WHEN order_id % 3 = 0 THEN 0 ELSE user_id END AS user_id,
                                CASE WHEN order_id % 3 = 0 THEN 0 ELSE product_id END AS product_id,
                                CASE WHEN order_id % 3 = 0 THEN 1 ELSE order_number END AS order_number) FROM f_opp)""",
    "count_non_null": """
        SELECT user_id, count(days_since_prior)::BIGINT AS n_known_gaps FROM f_orders GROUP BY user_id""",
    "count_star": """
        SELECT order_id, count(*)::BIGINT AS basket_size FROM f_order_products GROUP BY order_id""",
    "conditional_sum": """
        SELECT order_id, sum(CASE WHEN reordered = 1 THEN 1 ELSE 0 END)::BIGINT AS reordered_items
        FROM f_order_products GROUP BY order_id""",
    "guarded_ratio": """
        SELECT order_id,
               (sum(CASE WHEN reordered = 1 THEN 1 ELSE 0 END)::DOUBLE
                  / nullif(count(CASE WHEN order_number > 1 THEN 1 END), 0))::DOUBLE AS reorder_ratio
        FROM f_opp GROUP BY order_id""",
    "count_distinct": """
        SELECT product_id, count(DISTINCT user_id)::BIGINT AS distinct_buyers FROM f_opp GROUP BY product_id""",
    # ---- metadata join / ordering
    "snapshot_audit_join": """
        SELECT h.made_current_at, s.operation, h.snapshot_id, h.is_current_ancestor,
               s.summary['spark.app.id'] AS spark_app_id
        FROM f_history h JOIN f_snapshots s ON h.snapshot_id = s.snapshot_id
        ORDER BY made_current_at""",
    "order_by": "SELECT * FROM f_history ORDER BY made_current_at",
    "limit_show": "SELECT * FROM f_products ORDER BY product_id LIMIT 5",
    # ---- row-level changes
    "merge_upsert": _MERGED,
    "merge_upsert_messy": _MESSY,
    "upsert_flow": """
        , u_updates AS (
          SELECT * FROM f_updates
          UNION ALL VALUES (88, 'pearl barley', 4, 7, 2::DOUBLE), (5000001, 'buckwheat', 5, 7, 2::DOUBLE))
        SELECT * FROM u_updates
        UNION ALL
        SELECT * FROM f_target t WHERE NOT EXISTS (SELECT 1 FROM u_updates u WHERE u.product_id = t.product_id)""",
    "delete_point": "SELECT * FROM f_products WHERE product_id <> 140",
    "delete_where": "SELECT * FROM f_orders WHERE NOT coalesce(days_since_prior > 20, false)",
    "update_round": """
        SELECT event_id, round_even(value::FLOAT, 0)::FLOAT AS value FROM events""",
    "alter_column_type": """
        SELECT event_id, (value::FLOAT)::INTEGER AS value FROM events""",
    "alter_column_type_bigint": """
        SELECT event_id, (value::FLOAT)::BIGINT AS value FROM events""",
    # ---- quality checks
    "check_primary_key": """
        SELECT table_name, key_columns, sum(n)::BIGINT AS n_rows,
               coalesce(sum(CASE WHEN k IS NULL THEN n END), 0)::BIGINT AS n_null_keys,
               count(CASE WHEN k IS NOT NULL AND n > 1 THEN 1 END)::BIGINT AS n_duplicate_keys
        FROM (SELECT 'orders' AS table_name, 'order_id' AS key_columns, order_id AS k, count(*) AS n
              FROM f_orders GROUP BY order_id
              UNION ALL SELECT 'products', 'product_id', product_id, count(*) FROM f_products GROUP BY product_id
              UNION ALL SELECT 'aisles', 'aisle_id', aisle_id, count(*) FROM f_aisles GROUP BY aisle_id
              UNION ALL SELECT 'departments', 'department_id', department_id, count(*)
                        FROM f_departments GROUP BY department_id
              UNION ALL SELECT 'product_updates', 'product_id', product_id, count(*)
                        FROM f_updates GROUP BY product_id)
        GROUP BY table_name, key_columns""",
    "check_composite_key": """
        SELECT table_name, key_columns, sum(n)::BIGINT AS n_rows,
               coalesce(sum(CASE WHEN knull THEN n END), 0)::BIGINT AS n_null_keys,
               count(CASE WHEN NOT knull AND n > 1 THEN 1 END)::BIGINT AS n_duplicate_keys
        FROM (SELECT 'order_products' AS table_name, 'order_id,product_id' AS key_columns,
                     (order_id IS NULL OR product_id IS NULL) AS knull, count(*) AS n
              FROM f_order_products GROUP BY order_id, product_id
              UNION ALL
              SELECT 'lineitem', 'order_id,product_id', (order_id IS NULL OR product_id IS NULL), count(*)
              FROM f_flags GROUP BY order_id, product_id)
        GROUP BY table_name, key_columns""",
    "check_not_null": """
        SELECT 'orders' AS table_name, c AS column_name, n_rows::BIGINT AS n_rows, n_nulls::BIGINT AS n_nulls
        FROM (SELECT count(*) AS n_rows,
                     count(*) - count(user_id) AS user_id, count(*) - count(eval_set) AS eval_set,
                     count(*) - count(order_number) AS order_number, count(*) - count(order_dow) AS order_dow,
                     count(*) - count(order_hour_of_day) AS order_hour_of_day FROM f_orders)
        UNPIVOT (n_nulls FOR c IN (user_id, eval_set, order_number, order_dow, order_hour_of_day))
        UNION ALL
        SELECT 'product_updates', c, n_rows, n_nulls
        FROM (SELECT count(*) AS n_rows, count(*) - count(product_name) AS product_name,
                     count(*) - count(aisle_id) AS aisle_id, count(*) - count(department_id) AS department_id
              FROM f_updates)
        UNPIVOT (n_nulls FOR c IN (product_name, aisle_id, department_id))
        UNION ALL
        SELECT 'order_products_raw', c, n_rows, n_nulls
        FROM (SELECT count(*) AS n_rows, count(*) - count(order_id) AS order_id,
                     count(*) - count(product_id) AS product_id,
                     count(*) - count(add_to_cart_order) AS add_to_cart_order,
                     count(*) - count(reordered) AS reordered FROM f_flags)
        UNPIVOT (n_nulls FOR c IN (order_id, product_id, add_to_cart_order, reordered))""",
    "checked_full_load": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, 'not_null' AS \"check\", '{c}' AS column_name, count(*)::BIGINT AS n_rows, "
        f"NULL::INTEGER AS max_length, NULL::INTEGER AS longest, (count(*) - count({c}))::BIGINT AS n_violations FROM {view}"
        for t, view, cols in (("orders", "f_orders", ["user_id", "eval_set", "order_number", "order_dow", "order_hour_of_day"]),
                              ("product_updates", "f_updates", ["product_name", "aisle_id", "department_id"]),
                              ("order_products_raw", "f_flags", ["order_id", "product_id", "add_to_cart_order", "reordered"]),
                              ("documents", "documents", ["text", "lang"])) for c in cols) + " UNION ALL " + " UNION ALL ".join(
        f"SELECT '{t}', 'max_length', '{c}', count(*)::BIGINT, {n}, max(length({c}))::INTEGER, "
        f"count(CASE WHEN length({c}) > {n} THEN 1 END)::BIGINT FROM {view}"
        for t, view, c, n in (("orders", "f_orders", "eval_set", 20), ("product_updates", "f_updates", "product_name", 255),
                              ("documents", "documents", "text", 2000), ("documents", "documents", "source", 8))),
    "check_max_length": """
        SELECT 'orders' AS table_name, 'eval_set' AS column_name, 20 AS max_length,
               max(length(eval_set))::INTEGER AS longest,
               count(CASE WHEN length(eval_set) > 20 THEN 1 END)::BIGINT AS n_too_long FROM f_orders
        UNION ALL
        SELECT 'products', 'product_name', 255, max(length(product_name))::INTEGER,
               count(CASE WHEN length(product_name) > 255 THEN 1 END)::BIGINT FROM f_products
        UNION ALL
        SELECT 'aisles', 'aisle', 255, max(length(aisle))::INTEGER,
               count(CASE WHEN length(aisle) > 255 THEN 1 END)::BIGINT FROM f_aisles
        UNION ALL
        SELECT 'departments', 'department', 255, max(length(department))::INTEGER,
               count(CASE WHEN length(department) > 255 THEN 1 END)::BIGINT FROM f_departments
        UNION ALL
        SELECT 'product_updates', 'product_name', 255, max(length(product_name))::INTEGER,
               count(CASE WHEN length(product_name) > 255 THEN 1 END)::BIGINT FROM f_updates""",
    "check_orphans": """
        SELECT table_name, column_name, parent_table, parent_column,
               count(*) FILTER (WHERE orphan)::BIGINT AS n_orphan_keys,
               coalesce(sum(n) FILTER (WHERE orphan), 0)::BIGINT AS n_orphan_rows
        FROM (
          SELECT 'products' AS table_name, 'aisle_id' AS column_name, 'aisles' AS parent_table,
                 'aisle_id' AS parent_column, c.n,
                 NOT EXISTS (SELECT 1 FROM f_aisles p WHERE p.aisle_id = c.k) AS orphan
          FROM (SELECT aisle_id AS k, count(*) AS n FROM f_products WHERE aisle_id IS NOT NULL GROUP BY 1) c
          UNION ALL
          SELECT 'products', 'department_id', 'departments', 'department_id', c.n,
                 NOT EXISTS (SELECT 1 FROM f_departments p WHERE p.department_id = c.k)
          FROM (SELECT department_id AS k, count(*) AS n FROM f_products WHERE department_id IS NOT NULL
                GROUP BY 1) c
          UNION ALL
          SELECT 'order_products', 'order_id', 'orders', 'order_id', c.n,
                 NOT EXISTS (SELECT 1 FROM f_orders p WHERE p.order_id = c.k)
          FROM (SELECT order_id AS k, count(*) AS n FROM f_order_products WHERE order_id IS NOT NULL
                GROUP BY 1) c
          UNION ALL
          SELECT 'order_products', 'product_id', 'products', 'product_id', c.n,
                 NOT EXISTS (SELECT 1 FROM f_products p WHERE p.product_id = c.k)
          FROM (SELECT product_id AS k, count(*) AS n FROM f_order_products WHERE product_id IS NOT NULL
                GROUP BY 1) c
          UNION ALL
          SELECT 'product_updates', 'aisle_id', 'aisles', 'aisle_id', c.n,
                 NOT EXISTS (SELECT 1 FROM f_aisles p WHERE p.aisle_id = c.k)
          FROM (SELECT aisle_id AS k, count(*) AS n FROM f_updates WHERE aisle_id IS NOT NULL GROUP BY 1) c
          UNION ALL
          SELECT 'product_updates', 'department_id', 'departments', 'department_id', c.n,
                 NOT EXISTS (SELECT 1 FROM f_departments p WHERE p.department_id = c.k)
          FROM (SELECT department_id AS k, count(*) AS n FROM f_updates WHERE department_id IS NOT NULL
                GROUP BY 1) c)
        GROUP BY table_name, column_name, parent_table, parent_column""",
    "apply_changes": "SELECT * FROM f_applied",
    "apply_changes_stream": "SELECT * FROM f_applied",
    "apply_changes_keyed": _KEYED,
    # ---- sources / sinks: round trips compare with the table that was written
    "csv_typed_load": """
        SELECT order_id, user_id, eval_set, order_number, order_dow, order_hour_of_day,
               days_since_prior::FLOAT AS days_since_prior
        FROM f_orders""",
    "csv_quoted_load": r"""
        SELECT doc_id, CASE WHEN doc_id % 5 = 1 THEN '' WHEN doc_id % 5 <> 2 THEN regexp_replace(text, '\r', ' ', 'g') END AS text, lang
        FROM documents""",
    "csv_gzip_load": """
        SELECT order_id, product_id, add_to_cart_order, (reordered = 'true') AS reordered FROM f_op_prior""",
    "external_parquet_table": "SELECT * FROM f_op_prior",
    "parquet_landing_write": "SELECT * FROM f_orders",
    "landing_byte_cap": "SELECT * FROM documents",
    "drop_and_create_target": "SELECT * FROM f_op_prior",
    "partitioned_landing": "SELECT * FROM f_orders",
    "partition_reload": """
        SELECT * REPLACE ((order_hour_of_day + CASE WHEN eval_set = 'train' THEN 100 ELSE 0 END)::INTEGER AS order_hour_of_day) FROM f_orders""",
    "drop_create_table": "SELECT * FROM f_orders",
    "dated_batch_export": "SELECT * FROM f_op_prior",
    "select_tables_like": _digests({"order_products__prior": "SELECT * FROM f_op_prior", "order_products__train": "SELECT * FROM f_op_train"}),
    "create_or_replace_table": f"SELECT *, {TEST_EPOCH}::DOUBLE AS updated_at FROM f_products",
    "publish_all": _digests(_SILVER),
}


def oracle_sql() -> dict[str, str]:
    return {k: with_fixtures(v) for k, v in ORACLE_BODIES.items()}
