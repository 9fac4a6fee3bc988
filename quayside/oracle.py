"""For each registered query, the same question in SQL for another engine to answer.

Written by hand from the meaning of each query, not generated from the
specifications, so that the two sides check each other.
"""

from __future__ import annotations

# What counts as a number, a date and time, and an empty field.
NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
SHORT_INTEGER = r"^\s*[+-]?[0-9]{1,18}\s*$"
INTEGER = r"^\s*[+-]?[0-9]+\s*$"
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
)

# The spoiled tables, all columns as text.
SPOILED = """
WITH t_region AS (SELECT r_regionkey::VARCHAR AS r_regionkey, r_name FROM region),
t_nation AS (
  SELECT n_nationkey::VARCHAR AS n_nationkey, n_name, n_regionkey::VARCHAR AS n_regionkey FROM nation
),
t_customer AS (
  SELECT c_custkey::VARCHAR AS c_custkey,
         CASE WHEN c_custkey % 50 = 0 THEN c_name || 'x' ELSE c_name END AS c_name,
         c_nationkey::VARCHAR AS c_nationkey,
         CASE WHEN c_custkey % 89 = 0 THEN 'abc' ELSE c_acctbal::VARCHAR END AS c_acctbal,
         c_mktsegment
  FROM customer
),
t_supplier AS (
  SELECT s_suppkey::VARCHAR AS s_suppkey, s_name, s_nationkey::VARCHAR AS s_nationkey,
         s_acctbal::VARCHAR AS s_acctbal
  FROM supplier
),
t_part AS (
  SELECT p_partkey::VARCHAR AS p_partkey, p_name,
         CASE WHEN p_partkey % 54 = 0 THEN NULL ELSE p_brand END AS p_brand,
         CASE WHEN p_partkey % 54 = 0 THEN NULL ELSE p_type END AS p_type,
         CASE WHEN p_partkey % 54 = 0 THEN NULL WHEN p_partkey % 101 = 0 THEN 'x'
              ELSE p_size::VARCHAR END AS p_size,
         CASE WHEN p_partkey % 997 = 0 THEN NULL ELSE p_retailprice END::VARCHAR AS p_retailprice
  FROM part
),
t_orders AS (
  SELECT o_orderkey::VARCHAR AS o_orderkey, o_custkey::VARCHAR AS o_custkey, o_orderstatus,
         o_totalprice::VARCHAR AS o_totalprice,
         CASE WHEN o_orderkey % 211 = 0 THEN '1998/10/03' ELSE o_orderdate::VARCHAR END AS o_orderdate,
         o_orderpriority
  FROM orders
),
t_lineitem AS (
  SELECT (CASE WHEN l_linenumber = 7 THEN -1 WHEN l_suppkey % 33 = 0 THEN NULL
               ELSE l_orderkey END)::VARCHAR AS l_orderkey,
         (CASE WHEN l_orderkey % 97 = 0 THEN NULL WHEN l_partkey % 71 = 0 THEN -1
               ELSE l_partkey END)::VARCHAR AS l_partkey,
         (CASE WHEN l_suppkey % 71 = 0 THEN -1 ELSE l_suppkey END)::VARCHAR AS l_suppkey,
         l_linenumber::VARCHAR AS l_linenumber, l_quantity::VARCHAR AS l_quantity,
         l_extendedprice::VARCHAR AS l_extendedprice, l_discount::VARCHAR AS l_discount,
         l_tax::VARCHAR AS l_tax, l_returnflag, l_linestatus, l_shipdate::VARCHAR AS l_shipdate
  FROM lineitem
)
"""


def _number(c: str) -> str:
    return f"regexp_matches({c}, '{NUMBER}')"


def _not_number(c: str) -> str:
    return f"({c} IS NOT NULL AND NOT {_number(c)})"


def _value(c: str) -> str:
    return f"(CASE WHEN {_number(c)} THEN TRY_CAST({c} AS DOUBLE) END)"


def _out_of_range(c: str, kind: str) -> str:
    return (
        f"({_number(c)} AND NOT contains({c}, '.') AND "
        f"(CASE WHEN regexp_matches({c}, '{INTEGER}') THEN TRY_CAST({c} AS {kind}) END) IS NULL)"
    )


def _too_fine(c: str) -> str:
    """Rounding to two places changes the number."""
    return (
        f"(TRY_CAST({c} AS DECIMAL(38,18)) <> TRY_CAST({c} AS DECIMAL(38,2)) "
        f"OR (TRY_CAST({c} AS DECIMAL(38,18)) = 0 AND TRY_CAST({c} AS DOUBLE) <> 0))"
    )


def _bad_time(c: str) -> str:
    return f"({c} IS NOT NULL AND try_strptime({c}, '%Y-%m-%d %H:%M:%S') IS NULL)"


# table, rule, columns, severity, violation, rule that silences it (as a violation)
def _rule_list() -> list[tuple[str, str, str, str, str, str | None]]:
    rules: list[tuple[str, str, str, str, str, str | None]] = []

    def add(table, rule, column, broken, severity="error", silencer=None):
        rules.append((table, rule, column, severity, broken, silencer))

    for table in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem"):
        add(table, "columns_present", "*", "false")
    for table, columns in {
        "region": "r_regionkey r_name",
        "nation": "n_nationkey n_name n_regionkey",
        "customer": "c_custkey c_name c_nationkey c_acctbal",
        "supplier": "s_suppkey s_name s_nationkey s_acctbal",
        "part": "p_partkey",
        "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate",
        "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_shipdate",
    }.items():
        for c in columns.split():
            add(table, "not_null", c, f"{c} IS NULL")
    add("customer", "exact_width", "c_name", "length(c_name) <> 18")
    add("supplier", "exact_width", "s_name", "length(s_name) <> 18")
    add("customer", "max_width", "c_mktsegment", "length(c_mktsegment) > 10")
    add("part", "max_width", "p_name", "length(p_name) > 64")
    add("orders", "max_width", "o_orderstatus", "length(o_orderstatus) > 16")
    for table, column, kind in (
        ("region", "r_regionkey", "INTEGER"), ("nation", "n_nationkey", "INTEGER"),
        ("nation", "n_regionkey", "INTEGER"), ("customer", "c_custkey", "BIGINT"),
        ("customer", "c_nationkey", "INTEGER"), ("supplier", "s_suppkey", "BIGINT"),
        ("supplier", "s_nationkey", "INTEGER"), ("part", "p_partkey", "BIGINT"),
        ("part", "p_size", "INTEGER"), ("orders", "o_orderkey", "BIGINT"),
        ("orders", "o_custkey", "BIGINT"), ("lineitem", "l_orderkey", "BIGINT"),
        ("lineitem", "l_partkey", "BIGINT"), ("lineitem", "l_suppkey", "BIGINT"),
        ("lineitem", "l_linenumber", "SMALLINT"),
    ):
        add(table, "integer", column, _not_number(column))
        add(table, "decimal_point", column, f"contains({column}, '.')", silencer=_not_number(column))
        add(table, "numeric_range", column, _out_of_range(column, kind))
    for table, column in (("part", "p_size"), ("lineitem", "l_linenumber")):
        add(table, "below_minimum", column, f"{_value(column)} < 1", silencer=_not_number(column))
    for table, column in (
        ("customer", "c_acctbal"), ("supplier", "s_acctbal"), ("part", "p_retailprice"),
        ("orders", "o_totalprice"), ("lineitem", "l_quantity"), ("lineitem", "l_extendedprice"),
        ("lineitem", "l_discount"), ("lineitem", "l_tax"),
    ):
        add(table, "decimal", column, _not_number(column))
        add(table, "below_minimum", column, f"{_value(column)} < 0", silencer=_not_number(column))
        add(
            table, "numeric_range", column,
            f"({_number(column)} AND TRY_CAST({column} AS DECIMAL(10,2)) IS NULL)",
        )
        add(table, "excess_scale", column, f"({_number(column)} AND {_too_fine(column)})", "warn")
    add("orders", "timestamp", "o_orderdate", _bad_time("o_orderdate"))
    add("lineitem", "timestamp", "l_shipdate", _bad_time("l_shipdate"))
    add("orders", "domain", "o_orderstatus", "o_orderstatus NOT IN ('F', 'O', 'P')")
    add("lineitem", "domain", "l_returnflag", "l_returnflag NOT IN ('A', 'N', 'R')")
    add("lineitem", "domain", "l_linestatus", "l_linestatus NOT IN ('F', 'O')")
    return rules


def _count(broken: str, silencer: str | None) -> str:
    count = f"count(*) FILTER (WHERE {broken})"
    if silencer is None:
        return count
    return f"CASE WHEN count(*) FILTER (WHERE {silencer}) = 0 THEN {count} END"


def _rule_counts(*wanted: tuple[str, tuple[str, ...]]) -> str:
    """SELECTs of (rule, columns, n_rows, n_violations) for some rules of some tables."""
    parts = [
        f"SELECT '{rule}' AS rule, '{column}' AS columns, count(*) AS n_rows, "
        f"{_count(broken, silencer)} AS n_violations FROM t_{table}"
        for table, rule, column, _, broken, silencer in _rule_list()
        if any(table == t and rule in r for t, r in wanted)
    ]
    return SPOILED + "\nUNION ALL\n".join(parts)


EDGES = (
    ("nation", "n_regionkey", "region", "r_regionkey"),
    ("customer", "c_nationkey", "nation", "n_nationkey"),
    ("supplier", "s_nationkey", "nation", "n_nationkey"),
    ("orders", "o_custkey", "customer", "c_custkey"),
    ("lineitem", "l_orderkey", "orders", "o_orderkey"),
    ("lineitem", "l_partkey", "part", "p_partkey"),
    ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
)

KEYS = {
    "region": "r_regionkey",
    "nation": "n_nationkey",
    "customer": "c_custkey",
    "supplier": "s_suppkey",
    "part": "p_partkey",
    "orders": "o_orderkey",
    "lineitem": "l_orderkey, l_linenumber",
}


def _orphans(child: str, column: str, parent: str, parent_column: str) -> str:
    return (
        f"(SELECT count(*) FROM {child} c WHERE NOT EXISTS "
        f"(SELECT 1 FROM {parent} p WHERE p.{parent_column} = c.{column}))"
    )


def _duplicate_rows(table: str, key: str) -> str:
    return (
        f"(SELECT coalesce(sum(n), 0) FROM (SELECT count(*) AS n FROM {table} "
        f"GROUP BY {key} HAVING count(*) > 1))"
    )


def _report() -> str:
    parts = [
        f"SELECT '{table}' AS table_name, '{rule}' AS rule, '{column}' AS columns, "
        f"'{severity}' AS severity, count(*) AS n_rows, {_count(broken, silencer)} AS n_violations FROM t_{table}"
        for table, rule, column, severity, broken, silencer in _rule_list()
    ]
    for table, key in KEYS.items():
        parts.append(
            f"SELECT '{table}', 'primary_key', '{key.replace(', ', '+')}', 'error', count(*), "
            f"{_duplicate_rows('t_' + table, key)}::BIGINT FROM t_{table}"
        )
    for child, column, parent, parent_column in EDGES:
        parts.append(
            f"SELECT '{child}', 'foreign_key', '{column}->{parent}.{parent_column}', 'error', count(*), "
            f"{_orphans('t_' + child, column, 't_' + parent, parent_column)} FROM t_{child}"
        )
    return SPOILED + "\nUNION ALL\n".join(parts)


def _profile(source: str, table: str, columns: str) -> str:
    """One row per column of a table of text columns."""
    parts = []
    for c in columns.split():
        whole = f"regexp_matches({c}, '{SHORT_INTEGER}')"
        moment = f"(try_strptime({c}, '%Y-%m-%d %H:%M:%S') IS NOT NULL)"
        parts.append(
            f"SELECT '{table}' AS table_name, '{c}' AS column_name, count(*) AS n_rows, "
            f"count(*) FILTER (WHERE {c} IS NULL) AS n_nulls, "
            f"round(100.0::DOUBLE * (count(*) FILTER (WHERE {c} IS NULL))::DOUBLE / count(*)::DOUBLE, 2) AS null_percent, "
            f"count(DISTINCT {c}) AS n_distinct, "
            f"(count(*) FILTER (WHERE {c} IS NULL) = 0 AND count(DISTINCT {c}) = count(*)) AS is_key, "
            f"min(length({c}))::INTEGER AS min_length, max(length({c}))::INTEGER AS max_length, "
            f"CASE WHEN bool_and({whole}) THEN 'int' WHEN bool_and({_number(c)}) THEN 'decimal' "
            f"WHEN bool_and({moment}) THEN 'timestamp' ELSE 'string' END AS likely_type, "
            f"min({c}) AS example FROM {source}"
        )
    return "\nUNION ALL\n".join(parts)


def _as_text(table: str, columns: str) -> str:
    return f"(SELECT {', '.join(f'{c}::VARCHAR AS {c}' for c in columns.split())} FROM {table})"


CUSTOMER = "c_custkey c_name c_nationkey c_acctbal c_mktsegment"
PART = "p_partkey p_name p_brand p_type p_size p_retailprice"
ORDERS = "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority"
LINEITEM = (
    "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax "
    "l_returnflag l_linestatus l_shipdate"
)

PICKED = """
WITH picked AS (
  SELECT * FROM orders ORDER BY md5('42:' || o_orderkey::VARCHAR), o_orderkey::VARCHAR LIMIT 300
),
s_lineitem AS (SELECT * FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM picked)),
s_customer AS (SELECT * FROM customer WHERE c_custkey IN (SELECT o_custkey FROM picked)),
s_supplier AS (SELECT * FROM supplier WHERE s_suppkey IN (SELECT l_suppkey FROM s_lineitem))
"""

MONEY = "DECIMAL(20,2)"

TYPED_LINEITEM = """
SELECT l_orderkey::VARCHAR::BIGINT AS l_orderkey, l_partkey::VARCHAR::BIGINT AS l_partkey,
       l_suppkey::VARCHAR::BIGINT AS l_suppkey, l_linenumber::VARCHAR::SMALLINT AS l_linenumber,
       l_quantity::VARCHAR::DECIMAL(10,2) AS l_quantity,
       l_extendedprice::VARCHAR::DECIMAL(10,2) AS l_extendedprice,
       l_discount::VARCHAR::DECIMAL(10,2) AS l_discount, l_tax::VARCHAR::DECIMAL(10,2) AS l_tax,
       l_returnflag, l_linestatus, l_shipdate
FROM lineitem
"""

LISTINGS = """
SELECT p_partkey, CASE WHEN p_partkey % 54 = 0 THEN NULL ELSE p_brand END AS p_brand,
       CASE WHEN p_partkey % 54 = 0 THEN NULL ELSE p_type END AS p_type,
       CASE WHEN p_partkey % 997 = 0 THEN NULL ELSE p_retailprice END AS p_retailprice
FROM part
"""

LISTINGS_FLAGGED = f"""
SELECT p_partkey, p_brand, p_type, p_retailprice, missing_fields, missing_fields = '' AS is_complete
FROM (SELECT *, concat_ws('+', CASE WHEN p_brand IS NULL THEN 'p_brand' END,
                          CASE WHEN p_type IS NULL THEN 'p_type' END,
                          CASE WHEN p_retailprice IS NULL THEN 'p_retailprice' END) AS missing_fields
      FROM ({LISTINGS}))
"""

CENTROIDS = """
SELECT user_id, count(*) AS n_points,
       sum(value::DECIMAL(18,8))::DOUBLE / count(value) AS lat,
       sum(hour(ts)::DECIMAL(18,8))::DOUBLE / count(ts) AS lng
FROM events GROUP BY user_id
"""

CUSTOMER_VALUE = f"""
SELECT o_custkey, count(*) AS n_orders, coalesce(sum(total), 0)::{MONEY} AS lifetime_value,
       count(*) > 1 AS is_repeat
FROM orders LEFT JOIN (
  SELECT l_orderkey, sum(l_extendedprice::DECIMAL(10,2)) AS total FROM lineitem GROUP BY l_orderkey
) ON l_orderkey = o_orderkey
GROUP BY o_custkey
"""


def _sales(key: str) -> str:
    return (
        f"SELECT {key}, count(*) AS n_items, sum(l_extendedprice::DECIMAL(10,2))::{MONEY} AS revenue, "
        f"sum(l_quantity::DECIMAL(10,2))::{MONEY} AS quantity FROM lineitem GROUP BY {key}"
    )


def _events_per_user(order: str) -> str:
    return (
        "SELECT event_id, ts, user_id, event_type, value, props FROM (SELECT *, row_number() OVER "
        f"(PARTITION BY user_id ORDER BY {order}, event_id) AS rn FROM events) WHERE rn <= 3"
    )


def _cardinality() -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{child}.{column}->{parent}.{parent_column}' AS edge, count(*) AS n_parents, "
        f"count(*) FILTER (WHERE n IS NULL) AS childless_parents, coalesce(max(n), 0) AS max_children "
        f"FROM (SELECT DISTINCT {parent_column} FROM {parent}) LEFT JOIN "
        f"(SELECT {column}, count(*) AS n FROM {child} GROUP BY {column}) ON {column} = {parent_column}"
        for child, column, parent, parent_column in EDGES
    )


def _sample_orphans() -> str:
    # Each edge is counted on the sampled tables themselves.
    tables = {
        "orders": "picked", "lineitem": "s_lineitem", "customer": "s_customer", "supplier": "s_supplier",
        "part": "s_part", "nation": "s_nation", "region": "s_region",
    }
    head = PICKED + """,
s_part AS (SELECT * FROM part WHERE p_partkey IN (SELECT l_partkey FROM s_lineitem)),
s_nation AS (SELECT * FROM nation WHERE n_nationkey IN (
  SELECT c_nationkey FROM s_customer UNION SELECT s_nationkey FROM s_supplier)),
s_region AS (SELECT * FROM region WHERE r_regionkey IN (SELECT n_regionkey FROM s_nation))
"""
    return head + "\nUNION ALL\n".join(
        f"SELECT '{c}.{k}->{p}.{pk}' AS edge, count(*) AS n_rows, "
        f"{_orphans(tables[c], k, tables[p], pk)} AS n_orphans FROM {tables[c]}"
        for c, k, p, pk in EDGES
    )


DRAWN = "drawn AS (SELECT * FROM customer ORDER BY md5('42:' || c_custkey::VARCHAR), c_custkey::VARCHAR LIMIT 50)"

# By shape: tables of keys, their references, and how many rows each table has.
SHAPES = {
    "two_references": (
        f"""
WITH {DRAWN}, s_transfer AS (
  SELECT o_orderkey AS k, o_custkey AS payer, o_custkey * 7 % 100 + 1 AS payee FROM orders
  WHERE o_custkey IN (SELECT c_custkey FROM drawn) OR o_custkey * 7 % 100 + 1 IN (SELECT c_custkey FROM drawn)
), s_customer AS (
  SELECT c_custkey AS k FROM customer WHERE c_custkey IN (
    SELECT c_custkey FROM drawn UNION SELECT payer FROM s_transfer UNION SELECT payee FROM s_transfer)
)""",
        ("customer", "transfer"),
        (("transfer", "payer", "customer"), ("transfer", "payee", "customer")),
    ),
    "self_reference": (
        f"""
WITH RECURSIVE {DRAWN}, s_customer(k) AS (
  SELECT c_custkey FROM drawn UNION SELECT k // 2 FROM s_customer WHERE k >= 2
), s_orders AS (SELECT o_orderkey AS k FROM orders WHERE o_custkey IN (SELECT c_custkey FROM drawn))""",
        ("customer", "orders"),
        (("orders", "o_custkey", "customer"), ("customer", "c_boss", "customer")),
    ),
    "reference_cycle": (
        f"""
WITH RECURSIVE {DRAWN}, drawn_part AS (
  SELECT p_partkey FROM part WHERE p_partkey // 2 + 1 IN (SELECT c_custkey FROM drawn)
), reached(t, k) AS (
  (SELECT 'customer', c_custkey FROM drawn
   UNION ALL SELECT 'part', p_partkey FROM drawn_part
   UNION ALL SELECT 'supplier', s_suppkey FROM supplier WHERE s_suppkey * 3 IN (SELECT p_partkey FROM drawn_part))
  UNION
  SELECT CASE t WHEN 'customer' THEN 'supplier' WHEN 'supplier' THEN 'part' ELSE 'customer' END,
         CASE t WHEN 'customer' THEN k % 10 + 1 WHEN 'supplier' THEN k * 3 ELSE k // 2 + 1 END
  FROM reached
), s_customer AS (SELECT k FROM reached WHERE t = 'customer'),
s_supplier AS (SELECT k FROM reached WHERE t = 'supplier'),
s_part AS (SELECT k FROM reached WHERE t = 'part')""",
        ("customer", "supplier", "part"),
        (("customer", "c_suppkey", "supplier"), ("supplier", "s_partkey", "part"), ("part", "p_custkey", "customer")),
    ),
}
SHAPE_KEYS = {
    "customer": "c_custkey", "transfer": "o_orderkey", "orders": "o_orderkey", "supplier": "s_suppkey", "part": "p_partkey",
}


def _sample_shape(shape: str) -> str:
    head, tables, _ = SHAPES[shape]
    return head + "\n" + "\nUNION ALL\n".join(f"SELECT '{t}' AS table_name, k AS key FROM s_{t}" for t in tables)


def _shape_orphans() -> str:
    # No row of a sample lacks what it refers to; the rows are counted on the samples.
    parts = []
    for shape, (head, _, edges) in SHAPES.items():
        counted = " UNION ALL ".join(
            f"SELECT '{c}.{column}->{p}.{SHAPE_KEYS[p]}' AS edge, count(*) AS n_rows FROM s_{c}" for c, column, p in edges
        )
        known = "'self_reference', 'customer.c_boss->customer.c_custkey'"
        parts.append(
            f"SELECT '{shape}' AS shape, edge, n_rows, CASE WHEN ('{shape}', edge) = ({known}) THEN 1 ELSE 0 END "
            f"AS n_orphans FROM ({head} {counted})"
        )
    return "\nUNION ALL\n".join(parts)


def _expected() -> str:
    sizes = {
        "region": 5, "nation": 25, "customer": 1_500, "supplier": 100,
        "part": 2_000, "orders": 15_000, "lineitem": 60_000,
    }
    return "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, 'warn' AS severity, count(*) AS n_rows, "
        f"abs(count(*) - {n}) AS difference FROM {t}"
        for t, n in sizes.items()
    )


def statements() -> dict[str, str]:
    tokens = ", ".join("'" + t + "'" for t in NULL_TOKENS)
    lineitem_edges = [e for e in EDGES if e[0] == "lineitem"]
    dates_blanked = """
SELECT o_orderkey,
       CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderdate END AS approved,
       CASE WHEN o_orderstatus IN ('F', 'P') THEN o_orderdate END AS posted,
       CASE WHEN o_orderstatus = 'F' THEN o_orderdate END AS delivered
FROM orders"""
    examples = "\nUNION ALL\n".join(
        [
            "SELECT 'not_null' AS rule, 'l_orderkey' AS columns, 'NULL' AS value FROM t_lineitem WHERE l_orderkey IS NULL",
            "SELECT 'not_null', 'l_partkey', 'NULL' FROM t_lineitem WHERE l_partkey IS NULL",
            "SELECT 'primary_key', 'l_orderkey+l_linenumber', coalesce(l_orderkey, 'NULL') || ' | ' || l_linenumber "
            "FROM t_lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1",
        ]
        + [
            f"SELECT 'foreign_key', '{c}->{p}.{pc}', coalesce({c}, 'NULL') FROM t_lineitem c "
            f"WHERE NOT EXISTS (SELECT 1 FROM t_{p} p WHERE p.{pc} = c.{c})"
            for _, c, p, pc in lineitem_edges
        ]
    )
    sql = {
        "land_orders_text": """
SELECT o_orderkey::VARCHAR AS o_orderkey, o_custkey::VARCHAR AS o_custkey, o_orderstatus,
       o_totalprice::VARCHAR AS o_totalprice, o_orderdate::VARCHAR AS o_orderdate, o_orderpriority,
       'orders.parquet' AS _source_file, '2024-01-01 00:00:00' AS _ingested_at
FROM orders""",
        "land_orders_csv": """
SELECT o_orderkey::VARCHAR AS o_orderkey, o_custkey::VARCHAR AS o_custkey, o_orderstatus,
       o_totalprice::VARCHAR AS o_totalprice, o_orderdate::VARCHAR AS o_orderdate, o_orderpriority,
       '2024-01-01 00:00:00' AS _ingested_at
FROM orders""",
        "csv_roundtrip": "SELECT doc_id, text, lang, source, n_chars FROM documents",
        "csv_records_per_file": "SELECT count(*) AS n_records FROM documents",
        "null_token_fields": f"""
SELECT p_partkey, CASE WHEN p_brand NOT IN ({tokens}) THEN p_brand END AS p_brand,
       CASE WHEN p_type NOT IN ({tokens}) THEN p_type END AS p_type
FROM (SELECT p_partkey,
             CASE WHEN p_partkey % 54 = 0 THEN 'NA' WHEN p_partkey % 55 = 0 THEN '' ELSE p_brand END AS p_brand,
             CASE WHEN p_partkey % 56 = 0 THEN 'None' ELSE p_type END AS p_type
      FROM part)""",
        "stage_lineitem_typed": TYPED_LINEITEM,
        "publish_staging": TYPED_LINEITEM,
        "stage_star_files": TYPED_LINEITEM,
        "published_tables": "\nUNION ALL\n".join(
            f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in KEYS
        ),
        "check_not_null": _rule_counts(("lineitem", ("not_null",))),
        "check_primary_key_lineitem": """
SELECT sum(n)::BIGINT AS n_rows, sum(CASE WHEN n > 1 THEN n ELSE 0 END)::BIGINT AS duplicate_rows,
       count(*) FILTER (WHERE n > 1) AS duplicate_keys
FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)""",
        "check_primary_key_orders": """
SELECT sum(n)::BIGINT AS n_rows, sum(CASE WHEN n > 1 THEN n ELSE 0 END)::BIGINT AS duplicate_rows,
       count(*) FILTER (WHERE n > 1) AS duplicate_keys
FROM (SELECT count(*) AS n FROM orders GROUP BY o_orderkey)""",
        "check_width": _rule_counts(("customer", ("exact_width", "max_width"))),
        "check_integer": _rule_counts(("part", ("integer", "decimal_point"))),
        "check_decimal_point": """
SELECT 'integer' AS rule, 'p_partkey' AS columns, count(*) AS n_rows, 0 AS n_violations FROM part
UNION ALL SELECT 'decimal_point', 'p_partkey', count(*), 0 FROM part
UNION ALL SELECT 'integer', 'p_size', count(*), 0 FROM part
UNION ALL SELECT 'decimal_point', 'p_size', count(*), count(*) FILTER (WHERE p_partkey % 53 = 0) FROM part""",
        "check_decimal": _rule_counts(
            ("customer", ("decimal", "below_minimum", "excess_scale")),
            ("supplier", ("decimal", "below_minimum", "excess_scale")),
        ),
        "check_timestamp": _rule_counts(("orders", ("timestamp",))),
        "check_domain": """
SELECT 'domain' AS rule, 'event_type' AS columns, count(*) AS n_rows,
       count(*) FILTER (WHERE event_type NOT IN ('click', 'error', 'purchase', 'view')) AS n_violations
FROM events""",
        "check_numeric_range": """
SELECT 'numeric_range' AS rule, 'as_small' AS columns, count(*) AS n_rows,
       count(*) FILTER (WHERE TRY_CAST((l_orderkey * 1000000)::VARCHAR AS SMALLINT) IS NULL) AS n_violations FROM lineitem
UNION ALL
SELECT 'numeric_range', 'as_int', count(*),
       count(*) FILTER (WHERE TRY_CAST((l_orderkey * 1000000)::VARCHAR AS INTEGER) IS NULL) FROM lineitem
UNION ALL
SELECT 'numeric_range', 'as_money', count(*),
       count(*) FILTER (WHERE TRY_CAST((l_orderkey * 1000000)::VARCHAR AS DECIMAL(10,2)) IS NULL) FROM lineitem""",
        "check_excess_scale": f"""
SELECT 'excess_scale' AS rule, 'amount' AS columns, count(*) AS n_rows,
       count(*) FILTER (WHERE {_too_fine('amount')}) AS n_violations
FROM (SELECT CASE WHEN l_orderkey % 97 = 0 THEN '12345e-4' WHEN l_partkey % 71 = 0 THEN '1.2345e0'
             WHEN l_suppkey % 33 = 0 THEN '1200E-4' WHEN l_partkey % 53 = 0 THEN '0.125'
             WHEN l_partkey % 54 = 0 THEN '1.500' WHEN l_partkey % 55 = 0 THEN '1e-30'
             ELSE l_extendedprice::VARCHAR END AS amount FROM lineitem)""",
        "check_row_rules": """
SELECT 'below_minimum' AS rule, 'l_linenumber' AS columns, count(*) AS n_rows,
       count(*) FILTER (WHERE l_linenumber < 1) AS n_violations FROM lineitem
UNION ALL
SELECT 'shipped_after_order', 'l_shipdate+o_orderdate', count(*),
       count(*) FILTER (WHERE l_shipdate < o_orderdate)
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey""",
        "check_foreign_keys": SPOILED + "\nUNION ALL\n".join(
            f"SELECT '{c}.{k}->{p}.{pk}' AS edge, count(*) AS n_rows, "
            f"{_orphans('t_' + c, k, 't_' + p, pk)} AS n_orphans FROM t_{c}"
            for c, k, p, pk in lineitem_edges
        ),
        "orphan_order_keys": SPOILED + """
SELECT coalesce(l_orderkey, 'NULL') AS order_key, count(*) AS n FROM t_lineitem c
WHERE NOT EXISTS (SELECT 1 FROM t_orders p WHERE p.o_orderkey = c.l_orderkey)
GROUP BY l_orderkey""",
        "violation_examples": SPOILED + f"""
, found AS (SELECT DISTINCT * FROM ({examples}))
SELECT rule, columns, value, example_no::INTEGER AS example_no FROM (
  SELECT *, row_number() OVER (PARTITION BY rule, columns ORDER BY value) AS example_no FROM found
) WHERE example_no <= 3""",
        "validation_report": _report(),
        "problem_totals": f"""
SELECT table_name, max(n_rows) AS n_rows,
       count(*) FILTER (WHERE severity = 'error' AND n_violations > 0) AS n_problems,
       coalesce(sum(n_violations) FILTER (WHERE severity = 'error' AND n_violations > 0), 0)::BIGINT AS n_violations
FROM ({_report()}) GROUP BY table_name""",
        "expected_counts": _expected(),
        "bucketed_reference_check": """
WITH used AS (SELECT l_orderkey AS k, count(*) AS n FROM lineitem GROUP BY 1)
SELECT 'rows' AS measure, count(*) AS value FROM lineitem
UNION ALL SELECT 'orphans', count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
UNION ALL SELECT 'parents', count(DISTINCT o_orderkey) FROM orders
UNION ALL SELECT 'childless', count(DISTINCT o_orderkey) FROM orders WHERE o_orderkey NOT IN (SELECT k FROM used)
UNION ALL SELECT 'most children', max(n) FROM used WHERE k IN (SELECT o_orderkey FROM orders)""",
        "key_index_appends": """
WITH batches AS (
  SELECT 0 AS batch, l_orderkey AS k, l_linenumber AS i FROM lineitem WHERE l_orderkey % 3 = 0
  UNION ALL SELECT 1, l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey % 3 = 1 OR l_orderkey % 30 = 0
  UNION ALL SELECT 2, l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey % 3 = 2
), steps AS (SELECT unnest([0, 1, 2, 3])::INTEGER AS step),
counted AS (SELECT step, k, i, count(*) AS n FROM steps JOIN batches ON batch <= step GROUP BY ALL)
SELECT step, sum(n)::BIGINT AS n_rows, coalesce(sum(n) FILTER (n > 1), 0)::BIGINT AS duplicate_rows,
       count(*) FILTER (n > 1) AS duplicate_keys
FROM counted GROUP BY step""",
        "csv_intake": "SELECT doc_id, text, lang, source, n_chars FROM documents",
        "diverted_records": """
SELECT CASE WHEN o_orderkey % 107 = 0 AND o_orderkey % 103 <> 0 THEN 'not UTF-8'
            WHEN o_orderkey % 101 = 0 OR o_orderkey % 103 = 0 THEN 'wrong number of fields' ELSE 'landed' END AS outcome,
       count(*) AS n_records, sum(o_orderkey)::BIGINT AS key_sum
FROM orders GROUP BY 1""",
        "sample_orders": PICKED + "SELECT * FROM picked",
        "sample_lineitem": PICKED + "SELECT * FROM s_lineitem",
        "sample_customer": PICKED + "SELECT * FROM s_customer",
        "sample_part": PICKED + "SELECT * FROM part WHERE p_partkey IN (SELECT l_partkey FROM s_lineitem)",
        "sample_supplier": PICKED + "SELECT * FROM s_supplier",
        "sample_nation": PICKED + """
SELECT * FROM nation WHERE n_nationkey IN (
  SELECT c_nationkey FROM s_customer UNION SELECT s_nationkey FROM s_supplier)""",
        "sample_orphans": _sample_orphans(),
        "sampled_files": PICKED + """,
s_part AS (SELECT * FROM part WHERE p_partkey IN (SELECT l_partkey FROM s_lineitem)),
s_nation AS (SELECT * FROM nation WHERE n_nationkey IN (
  SELECT c_nationkey FROM s_customer UNION SELECT s_nationkey FROM s_supplier)),
s_region AS (SELECT * FROM region)
""" + "\nUNION ALL\n".join(
            f"SELECT '{t}' AS table_name, (SELECT count(*) FROM {t}) AS source_rows, "
            f"(SELECT count(*) FROM {s}) AS sample_rows, true AS is_measured"
            for t, s in [("orders", "picked"), *[(t, f"s_{t}") for t in KEYS if t != "orders"]]
        ),
        "stage_check_only": "\nUNION ALL\n".join(
            f"SELECT '{t}' AS table_name, count(*) AS n_rows, 0 AS n_problems, 0 AS n_published FROM {t}" for t in KEYS
        ),
        **{f"sample_{shape}": _sample_shape(shape) for shape in SHAPES},
        "sample_shape_orphans": _shape_orphans(),
        "events_three_per_user": _events_per_user("value::VARCHAR"),
        "events_three_per_user_numeric": _events_per_user("value"),
        "sample_event_points": PICKED + """
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id::VARCHAR) AS rn FROM events
) WHERE rn <= 3 AND user_id IN (SELECT c_custkey FROM s_customer)""",
        "nations_in_use": """
SELECT c_nationkey AS nation_key FROM customer UNION SELECT s_nationkey FROM supplier""",
        "profile_customer": _profile(_as_text("customer", CUSTOMER), "customer", CUSTOMER),
        "profile_part": SPOILED + _profile("t_part", "part", PART),
        "profile_orders": _profile(_as_text("orders", ORDERS), "orders", ORDERS),
        "profile_lineitem": _profile(_as_text("lineitem", LINEITEM), "lineitem", LINEITEM),
        "profile_lineitem_approximate": f"""
SELECT * EXCLUDE (n_distinct) REPLACE (NULL::BOOLEAN AS is_key)
FROM ({_profile(_as_text("lineitem", LINEITEM), "lineitem", LINEITEM)})""",
        "profile_merged": f"""
SELECT * EXCLUDE (n_distinct) REPLACE (NULL::BOOLEAN AS is_key), true AS is_close
FROM ({_profile(_as_text("lineitem", LINEITEM), "lineitem", LINEITEM)})""",
        "profile_estimates": "\nUNION ALL\n".join(
            f"SELECT '{c}' AS column_name, true AS is_close" for c in LINEITEM.split()
        ),
        "null_patterns": SPOILED + """
SELECT null_columns, count(*) AS n_rows FROM (
  SELECT concat_ws('+', CASE WHEN p_brand IS NULL THEN 'p_brand' END,
                   CASE WHEN p_type IS NULL THEN 'p_type' END, CASE WHEN p_size IS NULL THEN 'p_size' END,
                   CASE WHEN p_retailprice IS NULL THEN 'p_retailprice' END) AS null_columns
  FROM t_part) GROUP BY null_columns""",
        "relationship_cardinality": _cardinality(),
        "duplicate_documents": """
SELECT sha256(text) AS text_sha256, count(*) AS n FROM documents GROUP BY text HAVING count(*) > 1""",
        "latest_documents": """
SELECT doc_id, text, lang, source, n_chars FROM (
  SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id DESC) AS rn FROM documents) WHERE rn = 1""",
        "latest_event_per_user": """
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS rn FROM events) WHERE rn = 1""",
        "user_centroids": CENTROIDS,
        "customer_centroids": f"""
SELECT c_custkey, c_nationkey, n_points, lat, lng
FROM customer LEFT JOIN ({CENTROIDS}) ON user_id = c_custkey""",
        "order_totals": f"""
SELECT l_orderkey, count(*) AS n_items, sum(l_extendedprice::DECIMAL(10,2))::{MONEY} AS price,
       sum(l_quantity::DECIMAL(10,2))::{MONEY} AS quantity
FROM lineitem GROUP BY l_orderkey""",
        "event_mix": f"""
SELECT user_id, count(*) AS n_payments, sum(value::DECIMAL(10,2))::{MONEY} AS total,
       count(*) FILTER (WHERE event_type NOT IN ('click', 'error', 'purchase', 'view')) AS n_other_methods,
       max(length(props))::INTEGER AS max_instalments,
       coalesce(string_agg(DISTINCT event_type, '+' ORDER BY event_type)
         FILTER (WHERE event_type IN ('click', 'error', 'purchase', 'view')), '') AS methods
FROM events GROUP BY user_id""",
        "ship_delay": """
SELECT date_diff('day', o_orderdate::DATE, l_shipdate::DATE)::INTEGER AS days_late, count(*) AS n_items
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""",
        "order_stage": f"""
SELECT o_orderkey, CASE WHEN delivered IS NOT NULL THEN 'delivered' WHEN posted IS NOT NULL THEN 'posted'
       WHEN approved IS NOT NULL THEN 'approved' ELSE 'not_approved' END AS stage
FROM ({dates_blanked})""",
        "customer_value": CUSTOMER_VALUE,
        "part_sales": _sales("l_partkey"),
        "supplier_sales": _sales("l_suppkey"),
        "best_parts": _sales("l_partkey") + " ORDER BY revenue DESC, l_partkey LIMIT 10",
        "customer_nation_names": """
SELECT c_custkey, c.c_nationkey, coalesce(n_name, c.c_nationkey::VARCHAR) AS nation
FROM (SELECT c_custkey, CASE WHEN c_custkey % 50 = 0 THEN -1 ELSE c_nationkey END AS c_nationkey FROM customer) c
LEFT JOIN nation ON n_nationkey = c.c_nationkey""",
        "part_listing_flag": LISTINGS_FLAGGED,
        "part_listing_fill": f"""
SELECT p_partkey, coalesce(p_brand, 'unknown') AS p_brand, coalesce(p_type, 'unknown') AS p_type,
       coalesce(p_retailprice, 0.0) AS p_retailprice, missing_fields, is_complete
FROM ({LISTINGS_FLAGGED})""",
        "part_listing_drop": f"SELECT * FROM ({LISTINGS_FLAGGED}) WHERE is_complete",
        "mart_fact_lineitem": f"""
SELECT date_trunc('month', o_orderdate)::DATE AS order_month, p_brand, s_nationkey, count(*) AS n_items,
       sum(l_quantity::DECIMAL(10,2))::{MONEY} AS quantity,
       sum(l_extendedprice::DECIMAL(10,2))::{MONEY} AS revenue
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN part ON l_partkey = p_partkey
LEFT JOIN supplier ON l_suppkey = s_suppkey
GROUP BY 1, 2, 3""",
        "mart_dim_customer": f"""
SELECT c_custkey, c_name, c_nationkey, coalesce(n_name, c_nationkey::VARCHAR) AS nation,
       coalesce(n_orders, 0) AS n_orders, coalesce(lifetime_value, 0)::{MONEY} AS lifetime_value,
       coalesce(is_repeat, false) AS is_repeat
FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN ({CUSTOMER_VALUE}) ON o_custkey = c_custkey""",
        "mart_orders": f"""
WITH o AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS order_status,
         o_orderdate AS order_purchase_timestamp,
         CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderdate END AS order_approved_at,
         CASE WHEN o_orderstatus IN ('F', 'P') THEN o_orderdate END AS order_delivered_carrier_date,
         CASE WHEN o_orderstatus = 'F' THEN o_orderdate END AS order_delivered_customer_date,
         o_orderdate - INTERVAL 3 DAY AS order_estimated_delivery_date
  FROM orders
), t AS (
  SELECT l_orderkey AS order_id, count(*) AS n_items,
         sum(l_extendedprice::DECIMAL(10,2) + l_quantity::DECIMAL(10,2))::{MONEY} AS total
  FROM lineitem GROUP BY 1
), e AS (
  SELECT *, CASE event_type WHEN 'click' THEN 'credit_card' WHEN 'view' THEN 'boleto'
                 WHEN 'purchase' THEN 'voucher' ELSE event_type END AS kind FROM events
), p AS (
  SELECT user_id AS order_id, count(*) AS n_payments, sum(value::DECIMAL(10,2))::{MONEY} AS paid,
         count(*) FILTER (WHERE kind NOT IN ('credit_card', 'boleto', 'voucher')) AS n_other_methods,
         max(length(props))::INTEGER AS max_instalments,
         concat_ws('+', CASE WHEN bool_or(kind = 'credit_card') THEN 'credit_card' END,
                   CASE WHEN bool_or(kind = 'boleto') THEN 'boleto' END,
                   CASE WHEN bool_or(kind = 'voucher') THEN 'voucher' END) AS methods
  FROM e GROUP BY 1
), r AS (
  SELECT order_id, review_score FROM (
    SELECT user_id AS order_id, event_id % 5 + 1 AS review_score,
           row_number() OVER (PARTITION BY user_id ORDER BY date_trunc('second', ts) DESC, event_id % 5) AS rn
    FROM events) WHERE rn = 1
)
SELECT o.*, CASE WHEN order_delivered_customer_date IS NOT NULL THEN 'delivered'
                 WHEN order_delivered_carrier_date IS NOT NULL THEN 'posted'
                 WHEN order_approved_at IS NOT NULL THEN 'approved' ELSE 'not_approved' END AS stage,
       date_diff('day', order_estimated_delivery_date::DATE, order_delivered_customer_date::DATE)::INTEGER AS days_late,
       n_items, total, n_payments, paid, n_other_methods, max_instalments, methods, review_score
FROM o LEFT JOIN t USING (order_id) LEFT JOIN p USING (order_id) LEFT JOIN r USING (order_id)""",
        "mart_order_items": f"""
SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id,
       l_extendedprice::DECIMAL(10,2) AS price, l_quantity::DECIMAL(10,2) AS freight_value,
       o_custkey AS customer_id, o_orderstatus AS order_status, day AS order_date, stage
FROM lineitem LEFT JOIN (
  SELECT orders.*, o_orderdate::DATE AS day,
         CASE WHEN o_orderstatus = 'F' THEN 'delivered' WHEN o_orderstatus = 'P' THEN 'posted'
              WHEN o_orderpriority <> '5-LOW' THEN 'approved' ELSE 'not_approved' END AS stage
  FROM orders) ON o_orderkey = l_orderkey""",
        "mart_reviews": """
SELECT review_id, order_id, review_score, review_answer_timestamp FROM (
  SELECT event_id // 2 AS review_id, user_id AS order_id, event_id % 5 + 1 AS review_score,
         strftime(ts, '%Y-%m-%d %H:%M:%S') AS review_answer_timestamp,
         row_number() OVER (PARTITION BY event_id // 2
                            ORDER BY date_trunc('second', ts) DESC, user_id, event_id % 5) AS rn
  FROM events) WHERE rn = 1""",
        "mart_people": f"""
WITH placed AS (
  SELECT c_custkey // 3 AS customer_unique_id, o_orderkey, o_orderdate, c_custkey % 100 AS customer_zip_code_prefix,
         c_mktsegment AS customer_city, c_nationkey AS customer_state, total
  FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN (
    SELECT l_orderkey, sum(l_extendedprice::DECIMAL(10,2) + l_quantity::DECIMAL(10,2)) AS total
    FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey
), valued AS (
  SELECT customer_unique_id, count(*) AS n_orders, coalesce(sum(total), 0)::{MONEY} AS lifetime_value,
         count(*) > 1 AS is_repeat FROM placed GROUP BY 1
), home AS (
  SELECT * FROM (SELECT customer_unique_id, customer_zip_code_prefix, customer_city, customer_state,
    row_number() OVER (PARTITION BY customer_unique_id ORDER BY o_orderdate DESC, customer_zip_code_prefix,
                       customer_city, customer_state) AS rn FROM placed) WHERE rn = 1
)
SELECT customer_unique_id, n_orders, lifetime_value, is_repeat, customer_zip_code_prefix, customer_city,
       customer_state, lat, lng
FROM valued JOIN home USING (customer_unique_id)
LEFT JOIN ({CENTROIDS}) ON user_id = customer_zip_code_prefix""",
        "mart_products": f"""
SELECT product_id, product_category_name, product_name_length, product_description_length, product_photos_qty,
       coalesce(n_name, product_category_name) AS category, missing_fields, missing_fields = '' AS is_complete
FROM (
  SELECT *, concat_ws('+', CASE WHEN product_category_name IS NULL THEN 'product_category_name' END,
                      CASE WHEN product_name_length IS NULL THEN 'product_name_lenght' END,
                      CASE WHEN product_description_length IS NULL THEN 'product_description_lenght' END,
                      CASE WHEN product_photos_qty IS NULL THEN 'product_photos_qty' END) AS missing_fields
  FROM (SELECT p_partkey AS product_id, (p_partkey % 40)::VARCHAR AS product_category_name,
               CASE WHEN p_partkey % 54 = 0 THEN NULL WHEN p_partkey % 101 = 0 THEN 'x'
                    ELSE p_size::VARCHAR END AS product_name_length,
               CASE WHEN p_partkey % 54 <> 0 THEN length(p_brand) END::INTEGER AS product_description_length,
               CASE WHEN p_partkey % 54 <> 0 THEN length(p_type) END::INTEGER AS product_photos_qty
        FROM part)
) LEFT JOIN nation ON n_nationkey::VARCHAR = product_category_name""",
        "mart_sellers": f"""
SELECT s_suppkey AS seller_id, s_nationkey AS seller_zip_code_prefix, lat, lng
FROM supplier LEFT JOIN ({CENTROIDS}) ON user_id = s_nationkey""",
        "mart_dim_date": """
SELECT d::DATE AS date, year(d)::INTEGER AS year, quarter(d)::INTEGER AS quarter, month(d)::INTEGER AS month,
       day(d)::INTEGER AS day, (isodow(d) - 1)::INTEGER AS weekday, isodow(d) >= 6 AS is_weekend
FROM (SELECT unnest(generate_series(min(o_orderdate)::DATE, max(o_orderdate)::DATE, INTERVAL 1 DAY)) AS d FROM orders)""",
        "manifest_comparison": """
SELECT * FROM (VALUES ('customer.parquet', 'ok', NULL), ('lineitem.parquet', 'ok', NULL),
  ('nation.parquet', 'ok', NULL), ('orders.parquet', 'changed', 'rows'), ('part.parquet', 'unlisted', NULL),
  ('parts.parquet', 'missing', NULL), ('region.parquet', 'ok', NULL), ('supplier.parquet', 'ok', NULL)
) AS found(file_name, status, differs)""",
        "file_manifest_totals": "\nUNION ALL\n".join(
            f"SELECT '{t}.parquet' AS table_file, count(*) AS n_rows, true AS has_bytes, true AS has_digests FROM {t}"
            for t in KEYS
        ),
        "table_file_completeness": "\nUNION ALL\n".join(
            f"SELECT '{t}.parquet' AS file_name, count(*) AS n_rows, 'present' AS status FROM {t}" for t in KEYS
        )
        + "\nUNION ALL\nSELECT 'geolocation.parquet', 0, 'missing'",
    }
    return sql
