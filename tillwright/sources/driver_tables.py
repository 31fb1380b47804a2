"""Landing rows derived from the benchmark star schema, with the defects the quality rules look for.

The SQL uses only functions that Spark and other SQL engines share, so one text serves the Spark queries
and their checks. ``{ts}`` stands for the engine's zone-less timestamp type.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tillwright.sources.landing import pack

_DAY = "substr(cast(cast({0} as date) as string), 1, 10)"
_SHIP_DAY = _DAY.format("l_shipdate")
_ORDER_DAY = _DAY.format("o_orderdate")


def _month_first(day: str, sep: str) -> str:
    return f"substr({day}, 6, 2) || '{sep}' || substr({day}, 9, 2) || '{sep}' || substr({day}, 1, 4)"


_ORDER_MDY = _month_first("d", "/")
_HOUR = "lpad(cast(k % 24 as string), 2, '0')"

CUSTOMERS = """
WITH people AS (
  SELECT c_custkey AS k, r_regionkey AS rg,
    CASE WHEN c_custkey % 97 <> 5 THEN 'C-' || lpad(cast(c_custkey as string), 9, '0') END AS id,
    CASE WHEN c_custkey % 89 <> 3 THEN c_name END AS nm,
    CASE WHEN r_regionkey <> 4 AND c_custkey % 11 <> 0
         THEN 'u' || cast(c_custkey as string) || '@example.com' END AS email,
    CASE WHEN c_custkey % 83 = 1 THEN 'Gov' ELSE
      CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'CONS' WHEN 'BUILDING' THEN 'corp ' WHEN 'FURNITURE' THEN 'HO'
        WHEN 'HOUSEHOLD' THEN 'Cosumer' ELSE 'Home Office' END END AS seg,
    'City' || cast(n_nationkey as string) AS town, n_name AS land,
    CASE WHEN c_custkey % 79 = 2 THEN 'X' ELSE
      CASE r_regionkey WHEN 0 THEN 'S' WHEN 1 THEN 'W' WHEN 2 THEN 'East' WHEN 3 THEN 'CENTRAL'
        ELSE 'North' END END AS area
  FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey
)
SELECT CASE WHEN rg IN (0, 3, 4) THEN id END AS customer_id, CASE WHEN rg = 1 THEN id END AS customerid,
  CASE WHEN rg = 2 THEN id END AS cust_id, cast(NULL as string) AS customer_identifier,
  nm AS customer_name, cast(NULL as string) AS full_name,
  email AS customer_email, cast(NULL as string) AS email_address,
  seg AS segment, cast(NULL as string) AS customer_segment,
  CASE WHEN rg = 3 THEN land ELSE town END AS city, CASE WHEN rg = 3 THEN town ELSE land END AS state,
  area AS region,
  'Region' || cast(rg + 1 as string) || '/customers_' || cast(rg + 1 as string) || '.csv' AS _source_file,
  cast('2024-01-01 00:0' || cast(rg as string) || ':00' as {ts}) AS _load_timestamp
FROM people
UNION ALL
SELECT NULL, NULL, NULL, id, NULL, nm, NULL, email, NULL, seg, town, land, area,
  'Region6/customers_6.csv', cast('2024-01-01 00:05:00' as {ts})
FROM people WHERE k % 2 = 0
"""

ORDERS = f"""
WITH o AS (
  SELECT o_orderkey AS k, o_custkey, o_orderstatus, substr(o_orderpriority, 1, 1) AS pr, {_ORDER_DAY} AS d
  FROM {{orders}}
)
SELECT CASE WHEN k % 101 <> 7 THEN 'O-' || cast(k as string) END AS order_id,
  CASE WHEN k % 103 <> 9 THEN 'C-' || lpad(cast(o_custkey as string), 9, '0') END AS customer_id,
  CASE WHEN k % 7 <> 0 THEN 'V-' || cast(k % 100 as string) END AS vendor_id,
  CASE WHEN k % 107 = 4 THEN 'Drone' ELSE
    CASE pr WHEN '1' THEN '1st' WHEN '2' THEN '2nd Class' WHEN '3' THEN ' Std ' WHEN '4' THEN 'Same Day'
      ELSE 'First Class' END END AS ship_mode,
  CASE WHEN k % 109 = 2 THEN 'lost' ELSE
    CASE o_orderstatus WHEN 'F' THEN 'Delivered ' WHEN 'O' THEN 'SHIPPED' ELSE 'processing' END END AS order_status,
  CASE WHEN k % 113 = 3 THEN 'not a date' WHEN k % 127 = 1 THEN NULL
    WHEN k % 5 = 0 THEN {_ORDER_MDY} || ' ' || {_HOUR} || ':30'
    WHEN k % 5 = 1 THEN d || ' ' || {_HOUR} || ':30'
    WHEN k % 5 = 2 THEN {_ORDER_MDY}
    WHEN k % 5 = 3 THEN d
    ELSE d || 'T' || {_HOUR} || ':30:15' END AS order_purchase_date,
  'Region' || cast(1 + 2 * (k % 3) as string) || '/orders_' || cast(1 + k % 3 as string) || '.csv' AS _source_file,
  cast('2024-01-01 00:0' || cast(k % 3 as string) || ':00' as {{ts}}) AS _load_timestamp
FROM o
"""

TRANSACTIONS = """
WITH l AS (
  SELECT l_orderkey % 3 AS sp, l_orderkey * 7 + l_linenumber AS m, l_linenumber AS n, l_suppkey,
    CASE WHEN (l_orderkey * 7 + l_linenumber) % 131 <> 1 THEN 'O-' || cast(l_orderkey as string) END AS oid,
    CASE WHEN (l_orderkey * 7 + l_linenumber) % 137 <> 2 THEN 'P-' || cast(l_partkey as string) END AS pid,
    cast(l_extendedprice as decimal(18,2)) AS price, cast(l_discount as decimal(4,2)) AS disc,
    cast(cast(l_quantity as bigint) as string) AS qty
  FROM {lineitem}
)
SELECT CASE WHEN sp = 0 THEN oid END AS order_id, CASE WHEN sp = 1 THEN oid END AS order_id_v1,
  CASE WHEN sp = 2 THEN oid END AS order_id_v2,
  CASE WHEN sp = 0 THEN pid END AS product_id, CASE WHEN sp = 1 THEN pid END AS product_id_v1,
  CASE WHEN sp = 2 THEN pid END AS product_id_v2,
  'V-' || cast(l_suppkey as string) AS vendor_id,
  CASE WHEN n % 3 = 0 THEN '$' ELSE '' END || CASE WHEN m % 139 = 3 THEN '-' ELSE '' END
    || cast(price as string) || CASE WHEN n % 3 = 2 THEN ' USD' ELSE '' END AS sales,
  CASE WHEN m % 149 = 4 THEN '0' WHEN m % 151 = 5 THEN 'abc' ELSE qty END AS quantity,
  CASE WHEN m % 157 = 6 THEN '1.5' WHEN n % 2 = 0 THEN cast(cast(disc * 100 as int) as string) || '%'
    ELSE cast(disc as string) END AS discount,
  cast(cast(price * (cast(0.30 as decimal(4,2)) - disc) as decimal(18,2)) as string) AS profit,
  CASE n % 4 WHEN 0 THEN 'card' WHEN 1 THEN 'cash' WHEN 2 THEN 'transfer' ELSE 'voucher' END AS payment_type,
  'Region' || cast(2 + 2 * sp as string) || '/transactions_' || cast(1 + sp as string) || '.csv' AS _source_file,
  cast('2024-01-01 00:0' || cast(sp as string) || ':00' as {ts}) AS _load_timestamp
FROM l
"""

RETURNS = f"""
WITH l AS (
  SELECT l_orderkey * 7 + l_linenumber AS m, l_linenumber AS n, l_suppkey % 4 AS why, l_orderkey,
    cast(cast(l_extendedprice as decimal(18,2)) * (cast(1 as decimal(4,2)) - cast(l_discount as decimal(4,2)))
      as decimal(18,2)) AS net,
    {_SHIP_DAY} AS d
  FROM {{lineitem}} WHERE l_returnflag = 'R'
), v AS (
  SELECT n, CASE WHEN m % 131 <> 1 THEN 'O-' || cast(l_orderkey as string) END AS oid,
    CASE WHEN m % 13 = 0 THEN '?' ELSE CASE why WHEN 0 THEN 'Damaged' WHEN 1 THEN 'Wrong Item' WHEN 2 THEN 'Late'
      ELSE 'Changed Mind' END END AS reason,
    CASE WHEN m % 163 = 7 THEN 'Lost' ELSE CASE n % 4 WHEN 0 THEN 'APPRVD' WHEN 1 THEN 'Approved'
      WHEN 2 THEN 'PENDG' ELSE 'rjctd ' END END AS status,
    CASE WHEN m % 167 = 8 THEN '?' WHEN m % 173 = 9 THEN '-5.00' WHEN m % 179 = 10 THEN 'n/a'
      ELSE cast(net as string) END AS refund,
    CASE WHEN m % 181 = 11 THEN 'soon' WHEN m % 4 = 0 THEN d WHEN m % 4 = 1 THEN {_month_first("d", "-")}
      WHEN m % 4 = 2 THEN {_month_first("d", "/")} ELSE d || 'T08:00:00' END AS day
  FROM l
)
SELECT CASE WHEN n % 2 = 0 THEN oid END AS order_id_v1, CASE WHEN n % 2 = 1 THEN oid END AS order_id_v2,
  CASE WHEN n % 2 = 0 THEN reason END AS return_reason_v1, CASE WHEN n % 2 = 1 THEN reason END AS return_reason_v2,
  CASE WHEN n % 2 = 0 THEN status END AS return_status_v1, CASE WHEN n % 2 = 1 THEN status END AS return_status_v2,
  CASE WHEN n % 3 = 0 THEN refund END AS refund_amount_v1, CASE WHEN n % 3 = 1 THEN refund END AS refund_amount_v2,
  CASE WHEN n % 3 = 2 THEN refund END AS refund_amount_v3,
  CASE WHEN n % 3 = 0 THEN day END AS return_date_v1, CASE WHEN n % 3 = 1 THEN day END AS return_date_v2,
  CASE WHEN n % 3 = 2 THEN day END AS return_date_v3,
  CASE WHEN n % 2 = 0 THEN 'Region6/returns_1.json' ELSE 'returns_2.json' END AS _source_file,
  cast('2024-01-01 00:0' || cast(n % 2 as string) || ':00' as {{ts}}) AS _load_timestamp
FROM v
"""

PRODUCTS = """
SELECT CASE WHEN p_partkey % 191 <> 12 THEN ' P-' || cast(p_partkey as string) || ' ' END AS product_id,
  CASE WHEN p_partkey % 193 <> 13 THEN p_name END AS product_name, p_brand AS brand, p_type AS category,
  'S' || cast(p_size as string) AS sub_category,
  CASE WHEN p_partkey % 10 = 3 THEN 'bad'
    WHEN p_partkey % 4 = 0 THEN '1.' || lpad(cast(p_partkey as string), 6, '0') || 'E+11'
    ELSE cast(100000000000 + p_partkey as string) END AS upc,
  'products.json' AS _source_file, cast('2024-01-01 00:00:00' as {ts}) AS _load_timestamp
FROM {part}
"""

VENDORS = """
SELECT CASE WHEN s_suppkey % 97 = 50 THEN '' ELSE 'V-' || cast(s_suppkey as string) END AS vendor_id,
  CASE WHEN s_suppkey % 89 = 40 THEN '' ELSE s_name END AS vendor_name,
  'vendors.csv' AS _source_file, cast('2024-01-01 00:00:00' as {ts}) AS _load_timestamp
FROM {supplier}
"""

RAW_SQL = {
    "customers": (CUSTOMERS, ("customer", "nation", "region")),
    "orders": (ORDERS, ("orders",)),
    "transactions": (TRANSACTIONS, ("lineitem",)),
    "returns": (RETURNS, ("lineitem",)),
    "products": (PRODUCTS, ("part",)),
    "vendors": (VENDORS, ("supplier",)),
}


@lru_cache(maxsize=None)
def _schema(path: str) -> StructType:
    """Read once per file from its footer; it would cost a job for every query otherwise."""
    return SparkSession.active().read.parquet(path).schema


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    return spark.read.schema(_schema(path)).parquet(path)


def raw(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    text, tables = RAW_SQL[entity]
    frames = {t: table(spark, sf_dir, t) for t in tables}
    return spark.sql(text.replace("{ts}", "timestamp_ntz"), **frames)


def landing(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    return pack(raw(spark, sf_dir, entity), entity)


def other_engine_sql(entity: str) -> str:
    """The same text for an engine where the tables are registered under their own names."""
    text, tables = RAW_SQL[entity]
    return text.format(ts="timestamp", **{t: t for t in tables})
