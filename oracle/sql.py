"""SQL texts that compute the registered queries on another engine (DuckDB), for checking only.

They share with the package the derivation of the raw tables, the fixed values, and nothing else: windows,
joins to code lists and list functions are used where the package aggregates, looks up maps or scores rows.
Each relation is a CTE; a query is assembled from the CTEs it needs.
"""

from __future__ import annotations

import re

from tillwright import fixed_values as fv
from tillwright.operators.rules import RULES, rules_for
from tillwright.sources.driver_tables import RAW_SQL, other_engine_sql

NOT_WORD = r"[^\p{L}\p{N}]+"
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def _values(pairs: dict[str, str]) -> str:
    return ", ".join(f"('{a}', '{b}')" for a, b in pairs.items())


def _in(items) -> str:
    return "(" + ", ".join(f"'{i}'" for i in items) + ")"


def _num(expr: str) -> str:
    return f"CASE WHEN regexp_matches({expr}, '{NUMBER}') THEN TRY_CAST(trim({expr}) AS DOUBLE) END"


def _money(expr: str) -> str:
    return f"CAST(ROUND(SUM(CAST({expr} AS DECIMAL(18,4))), 2) AS DOUBLE)"


def _quot(top: str, bottom: str, places: int = 2) -> str:
    return (
        f"CAST(ROUND(CAST(CAST({top} AS DOUBLE) / NULLIF(CAST({bottom} AS DOUBLE), 0) AS DECIMAL(38,6)), {places}) AS DOUBLE)"
    )


def _pct(top: str, bottom: str) -> str:
    return _quot(f"CAST({top} AS DOUBLE) * 100", bottom)


def _avg(expr: str, places: int = 2) -> str:
    return _quot(f"SUM(CAST({expr} AS DECIMAL(18,4)))", f"COUNT({expr})", places)


def _dec(expr: str) -> str:
    return f"CAST(CAST({expr} AS DECIMAL(38,2)) AS VARCHAR)"


def _violations(tests: dict[str, str]) -> str:
    items = ", ".join(f"CASE WHEN {test} THEN '{name}' END" for name, test in tests.items())
    return f"list_filter([{items}], lambda x: x IS NOT NULL) AS violations"


CTES: dict[str, str] = {f"raw_{e}": other_engine_sql(e) for e in RAW_SQL}

CTES["segment_codes"] = f"SELECT * FROM (VALUES {_values(fv.SEGMENT_CODES)}) t(code, label)"
CTES["region_codes"] = f"SELECT * FROM (VALUES {_values(fv.REGION_CODES)}) t(code, label)"
CTES["status_codes"] = f"SELECT * FROM (VALUES {_values(fv.RETURN_STATUS_CODES)}) t(code, label)"
CTES["ship_codes"] = f"SELECT * FROM (VALUES {_values(fv.SHIP_MODE_CODES)}) t(code, label)"

CTES["typed_customers"] = """
SELECT c.customer_id, c.customer_name, c.customer_email, COALESCE(s.label, TRIM(c.seg)) AS segment,
  c.city, c.state, COALESCE(r.label, TRIM(c.region)) AS region, c._source_file, c._load_timestamp
FROM (
  SELECT COALESCE(customer_id, customerid, cust_id, customer_identifier) AS customer_id,
    COALESCE(customer_name, full_name) AS customer_name, COALESCE(customer_email, email_address) AS customer_email,
    COALESCE(segment, customer_segment) AS seg, region, _source_file, _load_timestamp,
    IF(regexp_matches(_source_file, 'region.*4', 'i'), state, city) AS city,
    IF(regexp_matches(_source_file, 'region.*4', 'i'), city, state) AS state
  FROM raw_customers
) c LEFT JOIN segment_codes s ON s.code = UPPER(TRIM(c.seg)) LEFT JOIN region_codes r ON r.code = UPPER(TRIM(c.region))
"""
CTES["typed_orders"] = """
SELECT order_id, customer_id, vendor_id, COALESCE(s.label, TRIM(ship_mode)) AS ship_mode,
  LOWER(TRIM(order_status)) AS order_status, order_purchase_date AS _raw_order_date,
  try_strptime(order_purchase_date, ['%m/%d/%Y %H:%M', '%Y-%m-%d %H:%M', '%m/%d/%Y', '%Y-%m-%d', '%Y-%m-%dT%H:%M:%S'])
    AS order_purchase_date, _source_file, _load_timestamp
FROM raw_orders LEFT JOIN ship_codes s ON s.code = TRIM(ship_mode)
"""
CTES["typed_transactions"] = f"""
SELECT COALESCE(order_id, order_id_v1, order_id_v2) AS order_id,
  COALESCE(product_id, product_id_v1, product_id_v2) AS product_id, vendor_id,
  sales AS _raw_sales, discount AS _raw_discount,
  TRY_CAST(regexp_replace(sales, '[^-0-9.]', '', 'g') AS DOUBLE) AS sales,
  CAST(TRY_CAST(quantity AS DECIMAL(38,0)) AS BIGINT) AS quantity,
  CASE WHEN contains(discount, '%') THEN ({_num("replace(discount, '%', '')")}) / 100 ELSE {_num("discount")} END AS discount,
  {_num("profit")} AS profit, payment_type, _source_file, _load_timestamp
FROM raw_transactions
"""
CTES["typed_returns"] = f"""
SELECT v.order_id, IF(v.reason = '?', 'Unknown', v.reason) AS return_reason,
  COALESCE(s.label, TRIM(v.status)) AS return_status, v.refund AS _raw_refund, v.day AS _raw_return_date,
  {_num("v.refund")} AS refund_amount,
  CAST(try_strptime(v.day, ['%Y-%m-%d', '%m-%d-%Y', '%m/%d/%Y', '%Y-%m-%dT%H:%M:%S']) AS DATE) AS return_date,
  v._source_file, v._load_timestamp
FROM (
  SELECT IFNULL(order_id_v1, order_id_v2) AS order_id, IFNULL(return_reason_v1, return_reason_v2) AS reason,
    IFNULL(return_status_v1, return_status_v2) AS status,
    COALESCE(refund_amount_v1, refund_amount_v2, refund_amount_v3) AS refund,
    COALESCE(return_date_v1, return_date_v2, return_date_v3) AS day, _source_file, _load_timestamp
  FROM raw_returns
) v LEFT JOIN status_codes s ON s.code = UPPER(TRIM(v.status))
"""
CTES["typed_products"] = f"""
SELECT TRIM(product_id) AS product_id, TRIM(product_name) AS product_name, TRIM(brand) AS brand,
  TRIM(category) AS category, TRIM(sub_category) AS sub_category,
  CAST(CAST({_num("upc")} AS HUGEINT) AS VARCHAR) AS upc, _source_file, _load_timestamp
FROM raw_products
"""
CTES["typed_vendors"] = """
SELECT TRIM(vendor_id) AS vendor_id, TRIM(vendor_name) AS vendor_name, _source_file, _load_timestamp FROM raw_vendors
"""

# A violation is named "<field>:<issue>".
TESTS = {
    "customers": {
        "customer_id:missing_value": "customer_id IS NULL",
        "customer_name:missing_value": "customer_name IS NULL",
        "segment:invalid_value": f"COALESCE(segment, '') NOT IN {_in(fv.SEGMENTS)}",
        "region:invalid_value": f"COALESCE(region, '') NOT IN {_in(fv.REGIONS)}",
    },
    "orders": {
        "order_id:missing_value": "order_id IS NULL",
        "customer_id:missing_value": "customer_id IS NULL",
        "ship_mode:invalid_value": f"COALESCE(ship_mode, '') NOT IN {_in(fv.SHIP_MODES)}",
        "order_status:invalid_value": f"COALESCE(order_status, '') NOT IN {_in(fv.ORDER_STATUSES)}",
        "order_purchase_date:parse_failure": "order_purchase_date IS NULL AND _raw_order_date IS NOT NULL",
    },
    "transactions": {
        "order_id:missing_value": "order_id IS NULL",
        "product_id:missing_value": "product_id IS NULL",
        "sales:out_of_range": "COALESCE(sales, -1) < 0",
        "quantity:out_of_range": "COALESCE(quantity, 0) <= 0",
        "discount:out_of_range": "COALESCE(discount, -1) < 0 OR discount > 1",
    },
    "returns": {
        "order_id:missing_value": "order_id IS NULL",
        "refund_amount:out_of_range": "COALESCE(refund_amount, CASE WHEN COALESCE(_raw_refund, '?') = '?' THEN 0 ELSE -1 END) < 0",
        "return_status:invalid_value": f"COALESCE(return_status, '') NOT IN {_in(fv.RETURN_STATUSES)}",
        "return_reason:invalid_value": "COALESCE(return_reason, 'Unknown') = 'Unknown'",
        "return_date:parse_failure": "return_date IS NULL AND _raw_return_date IS NOT NULL",
    },
    "products": {
        "product_id:missing_value": "product_id IS NULL",
        "product_name:missing_value": "product_name IS NULL",
    },
    "vendors": {
        "vendor_id:missing_value": "COALESCE(vendor_id, '') = ''",
        "vendor_name:missing_value": "COALESCE(vendor_name, '') = ''",
    },
}
KEYS = {
    "customers": "customer_id", "orders": "order_id", "transactions": "order_id",
    "returns": "order_id", "products": "product_id", "vendors": "vendor_id",
}
TYPED_COLUMNS = {
    "customers": "customer_id, customer_name, customer_email, segment, city, state, region",
    "orders": "order_id, customer_id, vendor_id, ship_mode, order_status, CAST(order_purchase_date AS VARCHAR) AS order_purchase_date",
    "transactions": "order_id, product_id, vendor_id, sales, quantity, discount, profit, payment_type",
    "returns": "order_id, return_reason, return_status, refund_amount, CAST(return_date AS VARCHAR) AS return_date",
    "products": "product_id, product_name, brand, category, sub_category, upc",
    "vendors": "vendor_id, vendor_name",
}
RAW_COLUMNS = {
    "orders": ", _raw_order_date", "transactions": ", _raw_sales, _raw_discount",
    "returns": ", _raw_refund, _raw_return_date",
}
LINEAGE = "_source_file, CAST(_load_timestamp AS VARCHAR) AS _load_timestamp"

for _e, _tests in TESTS.items():
    CTES[f"judged_{_e}"] = f"SELECT *, {_violations(_tests)} FROM typed_{_e}"
    CTES[f"ok_{_e}"] = f"SELECT * EXCLUDE (violations) FROM judged_{_e} WHERE len(violations) = 0"

CTES["rejects"] = " UNION ALL ".join(
    f"SELECT 'clean_{e}' AS source_table, {KEYS[e]} AS record_key, UNNEST(violations) AS v, _source_file, _load_timestamp FROM judged_{e}"
    for e in TESTS
)
CTES["audit"] = " UNION ALL ".join(
    f"SELECT '{e}' AS entity, COUNT(*) AS bronze_count, COUNT(*) FILTER (len(violations) = 0) AS silver_count, "
    f"COUNT(*) FILTER (len(violations) > 0) AS rejected_count FROM judged_{e}"
    for e in TESTS
)
CTES["customers_d"] = """
SELECT md5(customer_id) AS customer_sk, customer_id, customer_name, customer_email, segment, city, state, region
FROM ok_customers
QUALIFY ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY _load_timestamp DESC,
  (customer_email IS NULL), _source_file DESC, customer_name DESC NULLS LAST, customer_email DESC NULLS LAST) = 1
"""
CTES["products_d"] = """
SELECT md5(product_id) AS product_sk, product_id, MAX(product_name) AS product_name, MAX(brand) AS brand,
  MAX(category) AS category, MAX(sub_category) AS sub_category, MAX(upc) AS upc
FROM ok_products GROUP BY product_id
"""
CTES["vendors_d"] = "SELECT md5(vendor_id) AS vendor_sk, vendor_id, MAX(vendor_name) AS vendor_name FROM ok_vendors GROUP BY vendor_id"
CTES["dates_d"] = """
SELECT md5(CAST(CAST(day AS DATE) AS VARCHAR)) AS date_sk, CAST(day AS DATE) AS date_key,
  CAST(date_part('year', day) AS INTEGER) AS year, CAST(date_part('quarter', day) AS INTEGER) AS quarter,
  CAST(date_part('month', day) AS INTEGER) AS month, strftime(day, '%b') AS month_name,
  CAST(date_part('day', day) AS INTEGER) AS day, CAST(dayofweek(day) AS INTEGER) AS day_of_week,
  dayofweek(day) IN (0, 6) AS is_weekend
FROM (
  SELECT UNNEST(generate_series(date_trunc('year', lo), date_trunc('year', hi) + INTERVAL 1 YEAR, INTERVAL 1 DAY)) AS day
  FROM (SELECT MIN(d) AS lo, MAX(d) AS hi FROM (
    SELECT CAST(order_purchase_date AS DATE) AS d FROM ok_orders UNION ALL SELECT return_date FROM ok_returns))
)
"""
CTES["sold"] = """
SELECT o.order_id, c.customer_sk, o.customer_id, p.product_sk, t.product_id, v.vendor_sk,
  IFNULL(o.vendor_id, t.vendor_id) AS vendor_id, d.date_sk AS order_date_sk,
  CAST(o.order_purchase_date AS DATE) AS order_date_key, t.sales, t.quantity, t.discount, t.profit, o.ship_mode,
  o.order_status, o.order_purchase_date, t.payment_type, o._load_timestamp, o._source_file AS order_file,
  t._source_file AS line_file
FROM ok_transactions t JOIN ok_orders o USING (order_id) LEFT JOIN customers_d c ON c.customer_id = o.customer_id
  LEFT JOIN products_d p ON p.product_id = t.product_id
  LEFT JOIN vendors_d v ON v.vendor_id = IFNULL(o.vendor_id, t.vendor_id)
  LEFT JOIN dates_d d ON d.date_key = CAST(o.order_purchase_date AS DATE)
"""
CTES["sent_back"] = """
SELECT r.order_id, c.customer_sk, o.customer_id, d.date_sk AS return_date_sk, r.return_date AS return_date_key,
  r.refund_amount, r.return_reason, r.return_status, r.return_date, o.vendor_id, r._load_timestamp
FROM ok_returns r LEFT JOIN ok_orders o USING (order_id) LEFT JOIN customers_d c ON c.customer_id = o.customer_id
  LEFT JOIN dates_d d ON d.date_key = r.return_date
"""
CTES["allocated"] = """
SELECT *, CAST(ROUND(CAST(refund_amount * allocation_weight AS DECIMAL(38,6)), 2) AS DOUBLE) AS allocated_refund
FROM (
  SELECT s.order_id, s.product_sk, s.product_id, r.return_date_sk, r.return_date_key, r.return_reason, r.return_status,
    CAST(r.refund AS DOUBLE) AS refund_amount, CAST(s.amount AS DOUBLE) AS line_sales,
    CAST(SUM(s.amount) OVER w AS DOUBLE) AS total_order_sales,
    CAST(s.amount AS DOUBLE) / NULLIF(CAST(SUM(s.amount) OVER w AS DOUBLE), 0) AS allocation_weight, r._load_timestamp
  FROM (SELECT order_id, product_sk, MAX(product_id) AS product_id, SUM(CAST(sales AS DECIMAL(18,4))) AS amount
        FROM sold GROUP BY ALL) s
  JOIN (SELECT order_id, MAX(return_date_sk) AS return_date_sk, MAX(return_date_key) AS return_date_key,
          MAX(return_reason) AS return_reason, MAX(return_status) AS return_status,
          SUM(CAST(refund_amount AS DECIMAL(18,4))) AS refund, MAX(_load_timestamp) AS _load_timestamp
        FROM sent_back GROUP BY order_id) r USING (order_id)
  WINDOW w AS (PARTITION BY s.order_id)
)
"""
CTES["sold_to"] = """
SELECT s.*, c.segment, c.region, d.year, d.month, d.month_name FROM sold s JOIN customers_d c USING (customer_sk)
LEFT JOIN dates_d d ON d.date_sk = s.order_date_sk
"""
CTES["sent_back_by"] = """
SELECT r.* EXCLUDE (customer_id), c.customer_id, c.customer_name, c.segment, c.region
FROM sent_back r JOIN customers_d c USING (customer_sk)
"""
CTES["monthly"] = f"""
SELECT year, month, month_name, region, COUNT(DISTINCT order_id) AS order_count, {_money("sales")} AS total_revenue,
  {_money("profit")} AS total_profit, CAST(SUM(quantity) AS BIGINT) AS total_quantity,
  COUNT(DISTINCT customer_id) AS unique_customers, {_avg("sales")} AS avg_order_value
FROM sold_to WHERE year IS NOT NULL GROUP BY ALL
"""
CTES["vendor_rates"] = f"""
SELECT v.vendor_id, v.vendor_name, a.total_orders, a.total_sales,
  IFNULL(b.n, 0) AS return_order_count, IFNULL(b.refunded, 0.0) AS total_refunded,
  {_pct("IFNULL(b.n, 0)", "a.total_orders")} AS return_rate_pct
FROM vendors_d v
JOIN (SELECT vendor_id, COUNT(DISTINCT order_id) AS total_orders, {_money("sales")} AS total_sales FROM sold GROUP BY 1) a
  USING (vendor_id)
LEFT JOIN (SELECT vendor_id, COUNT(DISTINCT order_id) AS n, {_money("refund_amount")} AS refunded FROM sent_back GROUP BY 1) b
  USING (vendor_id)
"""
CTES["slow"] = f"""
SELECT *, PERCENT_RANK() OVER (PARTITION BY region ORDER BY total_quantity) <= 0.25 AS is_slow_moving
FROM (
  SELECT p.product_id, p.product_name, p.brand, s.region, {_money("s.sales")} AS total_sales,
    CAST(SUM(s.quantity) AS BIGINT) AS total_quantity, COUNT(DISTINCT s.order_id) AS order_count,
    {_money("s.profit")} AS total_profit
  FROM sold_to s JOIN products_d p USING (product_sk) GROUP BY ALL
)
"""
CTES["history"] = f"""
SELECT customer_id, customer_name, segment, region, COUNT(*) AS total_returns,
  {_money("refund_amount")} AS total_refund_value, {_avg("refund_amount")} AS avg_refund_per_return,
  COUNT(DISTINCT return_reason) AS distinct_reason_count,
  array_to_string(list_sort(list_distinct(list(return_reason))), ', ') AS return_reasons,
  COUNT(*) FILTER (return_status = 'Approved') AS approved_count,
  {_pct("COUNT(*) FILTER (return_status = 'Approved')", "COUNT(*)")} AS approval_rate_pct,
  MIN(return_date) AS first_return_date, MAX(return_date) AS last_return_date
FROM sent_back_by GROUP BY ALL
"""
CTES["impact"] = f"""
SELECT p.product_id, p.product_name, p.brand, x.region, COUNT(*) AS return_line_count,
  {_money("a.allocated_refund")} AS total_return_cost, {_avg("a.allocated_refund")} AS avg_return_cost,
  CAST(ROUND(SUM(CAST(a.allocation_weight AS DECIMAL(18,10))), 4) AS DOUBLE) AS total_allocation_weight
FROM allocated a JOIN (SELECT DISTINCT order_id, product_sk, region FROM sold_to) x USING (order_id, product_sk)
  JOIN products_d p USING (product_sk)
GROUP BY ALL
"""
CTES["thresholds"] = """
SELECT GREATEST(quantile_cont(total_returns, 0.75), 3) AS p75_returns,
  quantile_cont(total_refund_value, 0.75) AS p75_refund, quantile_cont(avg_refund_per_return, 0.75) AS p75_avg_refund
FROM history
"""
CTES["scores"] = """
SELECT *, list_sum([pts.n, pts.r, pts.a, pts.ok, pts.why]) AS anomaly_score, array_to_string(list_filter([
  CASE WHEN pts.n > 0 THEN 'high_return_count (20)' END, CASE WHEN pts.r > 0 THEN 'high_total_refund (25)' END,
  CASE WHEN pts.a > 0 THEN 'high_avg_refund (20)' END, CASE WHEN pts.ok > 0 THEN 'high_approval_rate (15)' END,
  CASE WHEN pts.why > 0 THEN 'multiple_reasons (20)' END], lambda x: x IS NOT NULL), ', ') AS rules_violated
FROM (
  SELECT h.*, {
    'n': IF(total_returns > (SELECT p75_returns FROM thresholds), 20, 0),
    'r': IF(total_refund_value > (SELECT p75_refund FROM thresholds), 25, 0),
    'a': IF(avg_refund_per_return > (SELECT p75_avg_refund FROM thresholds), 20, 0),
    'ok': IF(approval_rate_pct > 90 AND total_returns >= 2, 15, 0),
    'why': IF(distinct_reason_count >= 3, 20, 0)} AS pts
  FROM history h
)
"""
CTES["kpi_docs"] = f"""
SELECT 'revenue_performance' AS insight_type, '{{"grand_total_revenue":' || {_dec("SUM(revenue)")} || ',"grand_total_profit":'
  || {_dec("SUM(profit)")} || ',"grand_total_units":' || SUM(units) || ',"by_region":[' || string_agg(
    '{{"region":"' || region || '","revenue":' || {_dec("revenue")} || ',"profit":' || {_dec("profit")} || '}}', ',' ORDER BY region)
  || ']}}' AS kpi_data
FROM region_kpis
UNION ALL
SELECT 'vendor_return_rate', '{{"vendor":"' || vendor_name || '","total_sales":' || {_dec("total_sales")}
  || ',"return_rate":' || {_dec("return_rate_pct")} || ',"total_refunded":' || {_dec("total_refunded")} || '}}'
FROM vendor_rates
UNION ALL
SELECT 'slow_moving_inventory', '{{"total_return_cost":' || (SELECT {_dec("ROUND(SUM(CAST(total_return_cost AS DECIMAL(18,4))), 2)")} FROM impact)
  || ',"avg_return_cost":' || (SELECT {_dec(_avg("avg_return_cost"))} FROM impact) || ',"top_5":[' || string_agg(
    '{{"product":"' || product_name || '","region":"' || region || '","cost":' || {_dec("total_return_cost")} || '}}', ','
    ORDER BY total_return_cost DESC, product_id, region) || ']}}'
FROM (SELECT * FROM impact ORDER BY total_return_cost DESC NULLS LAST, product_id, region LIMIT 5)
"""
CTES["region_kpis"] = f"""
SELECT region, {_money("total_revenue")} AS revenue, {_money("total_profit")} AS profit,
  CAST(SUM(total_quantity) AS BIGINT) AS units, CAST(SUM(order_count) AS BIGINT) AS orders
FROM monthly GROUP BY region
"""
CTES["docs"] = f"""
SELECT 'product_' || product_id AS doc_id, 'product' AS doc_type,
  'Product: ' || product_name || '. Brand: ' || IFNULL(brand, 'Unknown') || '. Category: ' || IFNULL(category, 'Unknown') AS doc_text,
  product_id, NULL AS vendor_id, NULL AS region FROM products_d
UNION ALL
SELECT 'prodregion_' || product_id || '_' || region, 'product_region',
  format('{{}} in {{}}: ${{}} sales, {{}} qty, ${{}} profit{{}}', product_name, region, {_dec("total_sales")}, total_quantity,
    {_dec("total_profit")}, IF(is_slow_moving, ' [SLOW-MOVING]', '')), product_id, NULL, region FROM slow
UNION ALL
SELECT 'vendor_' || vendor_id, 'vendor',
  format('Vendor {{}}: {{}} orders, ${{}} sales, {{}} returns, {{}}% return rate, ${{}} refunded', vendor_name, total_orders,
    {_dec("total_sales")}, return_order_count, {_dec("return_rate_pct")}, {_dec("total_refunded")}), NULL, vendor_id, NULL
FROM vendor_rates
"""
_questions = ", ".join(
    f"({q}, '{text}', '{kind}', {'NULL' if word is None else repr(word)})" for q, text, kind, word in fv.QUESTIONS
)
CTES["questions"] = f"SELECT * FROM (VALUES {_questions}) t(qid, question, kind, word)"
CTES["context"] = """
SELECT q.qid, q.question, string_agg(d.doc_text, ' | ' ORDER BY d.doc_id)[1:3000] AS documents,
  CAST(LEAST(COUNT(d.doc_id), 5) AS BIGINT) AS retrieved_count
FROM questions q LEFT JOIN docs d ON d.doc_type = q.kind AND (q.word IS NULL OR contains(lower(d.doc_text), lower(q.word)))
GROUP BY 1, 2
"""


def _bm25(docs: str, key: str, text: str, k: int) -> dict[str, str]:
    return {
        "corpus": f"SELECT {key} AS doc, list_filter(regexp_split_to_array(lower({text}), '{NOT_WORD}'), lambda x: x <> '') AS ws FROM {docs}",
        "asked": f"SELECT qid, UNNEST(list_distinct(list_filter(regexp_split_to_array(lower(question), '{NOT_WORD}'), lambda x: x <> ''))) AS w FROM questions",
        "tf": "SELECT doc, w, COUNT(*) AS f FROM (SELECT doc, UNNEST(ws) AS w FROM corpus) WHERE w IN (SELECT w FROM asked) GROUP BY ALL",
        "sizes": "SELECT COUNT(*) AS n, AVG(len(ws)) AS mean_size FROM corpus",
        "ranked": f"""
SELECT qid, doc, ROUND(SUM(ln(1 + (n - df + 0.5) / (df + 0.5)) * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * len(ws) / mean_size))), 6) AS score
FROM asked JOIN tf USING (w) JOIN (SELECT w, COUNT(*) AS df FROM tf GROUP BY w) USING (w) JOIN corpus USING (doc) CROSS JOIN sizes
GROUP BY qid, doc
""",
        "best": f"""
SELECT qid, doc AS {key}, score, CAST(ROW_NUMBER() OVER (PARTITION BY qid ORDER BY score DESC, doc) AS INTEGER) AS rank
FROM ranked WHERE score > 0 QUALIFY rank <= {k}
""",
    }


def compose(select: str, extra: dict[str, str] | None = None) -> str:
    """WITH clause holding just the CTEs the text needs, in order of use."""
    known = {**CTES, **(extra or {})}
    ordered: list[str] = []

    def visit(text: str) -> None:
        for name in known:
            if name not in ordered and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
                visit(known[name])
                if name not in ordered:
                    ordered.append(name)

    visit(select)
    if not ordered:
        return select
    return "WITH " + ",\n".join(f"{n} AS ({known[n].strip()})" for n in ordered) + "\n" + select


def _harmonize(entity: str) -> str:
    flags = ", ".join(
        f"list_contains(violations, '{r.field}:{r.issue}') AS {r.flag}" for r in rules_for(entity)
    )
    return (
        f"SELECT {TYPED_COLUMNS[entity]}{RAW_COLUMNS.get(entity, '')}, {LINEAGE}, {flags}, "
        f"len(violations) > 0 AS _has_any_failure FROM judged_{entity}"
    )


def _portable(select: str, *columns: str) -> str:
    casts = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in columns)
    return f"SELECT * REPLACE ({casts}) FROM ({select})"


def oracle() -> dict[str, str]:
    q: dict[str, str] = {}
    for e in TESTS:
        q[f"bronze_{e}"] = f"SELECT * REPLACE (CAST(_load_timestamp AS VARCHAR) AS _load_timestamp) FROM raw_{e}"
        q[f"harmonize_{e}"] = _harmonize(e)
        q[f"clean_{e}"] = f"SELECT {TYPED_COLUMNS[e]}, {LINEAGE} FROM ok_{e}"
    q["landing_row_counts"] = " UNION ALL ".join(f"SELECT '{e}' AS entity, COUNT(*) AS row_count FROM raw_{e}" for e in TESTS)
    q["rejected_records"] = (
        "SELECT source_table, record_key, split_part(v, ':', 1) AS affected_field, split_part(v, ':', 2) AS issue_type, "
        f"{LINEAGE} FROM rejects"
    )
    numbers = ", ".join(f"('clean_{r.entity}', '{r.field}:{r.issue}', {r.number})" for r in RULES)
    q["rejected_by_rule"] = (
        "SELECT n.rule, n.source_table, split_part(n.v, ':', 1) AS affected_field, split_part(n.v, ':', 2) AS issue_type, "
        f"COUNT(r.v) AS rejected_count FROM (VALUES {numbers}) n(source_table, v, rule) "
        "JOIN rejects r USING (source_table, v) GROUP BY ALL"
    )
    q["rejected_record_data"] = " UNION ALL ".join(
        f"SELECT 'clean_{e}' AS source_table, {KEYS[e]} AS json_key, _source_file AS json_file, 'true' AS json_failed, "
        f"CAST(len(violations) AS BIGINT) AS n_flags FROM judged_{e} WHERE len(violations) > 0"
        for e in TESTS
    )
    q["generate_rejected_rows"] = (
        "SELECT source_table, record_key, split_part(v, ':', 1) AS affected_field, split_part(v, ':', 2) AS issue_type, "
        f"{LINEAGE} FROM rejects WHERE source_table = 'clean_transactions' AND v = 'sales:out_of_range'"
    )
    q["audit_log"] = "SELECT * FROM audit"
    q["check_audit_balanced"] = (
        "SELECT *, bronze_count - silver_count - rejected_count AS imbalance FROM audit "
        "WHERE bronze_count <> silver_count + rejected_count"
    )
    q["check_bridge_allocation"] = (
        "SELECT order_id, CAST(ROUND(w, 4) AS DOUBLE) AS total_weight, CAST(ABS(w - 1) AS DOUBLE) AS deviation FROM "
        "(SELECT order_id, SUM(CAST(allocation_weight AS DECIMAL(18,10))) AS w FROM allocated GROUP BY 1) WHERE ABS(w - 1) > 0.01"
    )
    q["check_not_null"] = (
        "SELECT 'clean_orders.order_purchase_date' AS tested, order_id AS record_key FROM ok_orders WHERE order_purchase_date IS NULL "
        "UNION ALL SELECT 'clean_returns.return_date', order_id FROM ok_returns WHERE return_date IS NULL "
        "UNION ALL SELECT 'fact_sales.vendor_sk', order_id FROM sold WHERE vendor_sk IS NULL "
        "UNION ALL SELECT 'fact_returns.customer_sk', order_id FROM sent_back WHERE customer_sk IS NULL"
    )
    q["check_unique"] = (
        "SELECT 'clean_customers.customer_id' AS tested, customer_id AS value, COUNT(*) AS n_records FROM ok_customers GROUP BY 2 HAVING COUNT(*) > 1 "
        "UNION ALL SELECT 'fact_sales.order_id', order_id, COUNT(*) FROM sold GROUP BY 2 HAVING COUNT(*) > 1 "
        "UNION ALL SELECT 'dim_customers.customer_sk', customer_sk, COUNT(*) FROM customers_d GROUP BY 2 HAVING COUNT(*) > 1"
    )
    q["check_accepted_values"] = (
        f"SELECT 'segment' AS tested, segment AS value, COUNT(*) AS n_records FROM typed_customers WHERE segment NOT IN {_in(fv.SEGMENTS)} GROUP BY 2 "
        f"UNION ALL SELECT 'region', region, COUNT(*) FROM typed_customers WHERE region NOT IN {_in(fv.REGIONS)} GROUP BY 2 "
        f"UNION ALL SELECT 'ship_mode', ship_mode, COUNT(*) FROM typed_orders WHERE ship_mode NOT IN {_in(fv.SHIP_MODES)} GROUP BY 2 "
        f"UNION ALL SELECT 'order_status', order_status, COUNT(*) FROM typed_orders WHERE order_status NOT IN {_in(fv.ORDER_STATUSES)} GROUP BY 2 "
        f"UNION ALL SELECT 'return_status', return_status, COUNT(*) FROM typed_returns WHERE return_status NOT IN {_in(fv.RETURN_STATUSES)} GROUP BY 2"
    )
    q["check_in_range"] = (
        "SELECT 'discount' AS tested, discount AS value FROM typed_transactions WHERE discount < 0 OR discount > 1 "
        "UNION ALL SELECT 'quantity', CAST(quantity AS DOUBLE) FROM typed_transactions WHERE quantity < 1 "
        "UNION ALL SELECT 'sales', sales FROM typed_transactions WHERE sales < 0 "
        "UNION ALL SELECT 'refund_amount', refund_amount FROM typed_returns WHERE refund_amount < 0 "
        "UNION ALL SELECT 'quantity_exclusive', CAST(quantity AS DOUBLE) FROM typed_transactions WHERE quantity <= 1 OR quantity >= 50"
    )
    relations = {
        **{f"clean_{e}": f"ok_{e}" for e in TESTS}, "dim_customers": "customers_d", "dim_products": "products_d",
        "dim_vendors": "vendors_d", "dim_dates": "dates_d", "fact_sales": "sold", "fact_returns": "sent_back",
    }
    declared = {
        "not_null": {
            "clean_customers": "customer_id customer_name segment region",
            "clean_orders": "order_id customer_id ship_mode order_status order_purchase_date",
            "clean_products": "product_id product_name",
            "clean_returns": "order_id return_status return_reason return_date",
            "clean_transactions": "order_id product_id sales quantity discount",
            "clean_vendors": "vendor_id vendor_name",
            "dim_customers": "customer_sk customer_id", "dim_dates": "date_sk date_key",
            "dim_products": "product_sk product_id", "dim_vendors": "vendor_sk vendor_id",
            "fact_returns": "order_id", "fact_sales": "order_id",
        },
        "unique": {
            "dim_customers": "customer_sk customer_id", "dim_dates": "date_sk date_key", "dim_products": "product_sk",
            "dim_vendors": "vendor_sk vendor_id",
        },
    }
    conditions = {
        ("clean_customers", "segment", "accepted_values"): f"segment NOT IN {_in(fv.SEGMENTS)}",
        ("clean_customers", "region", "accepted_values"): f"region NOT IN {_in(fv.REGIONS)}",
        ("clean_orders", "ship_mode", "accepted_values"): f"ship_mode NOT IN {_in(fv.SHIP_MODES)}",
        ("clean_orders", "order_status", "accepted_values"): f"order_status NOT IN {_in(fv.ORDER_STATUSES)}",
        ("clean_returns", "return_status", "accepted_values"): f"return_status NOT IN {_in(fv.RETURN_STATUSES)}",
        ("clean_returns", "refund_amount", "in_range"): "refund_amount < 0",
        ("clean_transactions", "sales", "in_range"): "sales < 0",
        ("clean_transactions", "quantity", "in_range"): "quantity < 1",
        ("clean_transactions", "discount", "in_range"): "discount < 0 OR discount > 1",
        **{(t, c, "not_null"): f"{c} IS NULL" for t, cs in declared["not_null"].items() for c in cs.split()},
    }
    q["column_tests"] = " UNION ALL ".join(
        [
            f"SELECT '{t}' AS table_name, '{c}' AS column_name, '{kind}' AS test, COUNT(*) FILTER ({test}) AS failing FROM {relations[t]}"
            for (t, c, kind), test in conditions.items()
        ]
        + [
            f"SELECT '{t}', '{c}', 'unique', COUNT(*) FROM (SELECT {c} FROM {relations[t]} WHERE {c} IS NOT NULL GROUP BY 1 HAVING COUNT(*) > 1)"
            for t, cs in declared["unique"].items()
            for c in cs.split()
        ]
    )
    q["dq_rejection_rates"] = (
        "SELECT a.entity, split_part(v, ':', 1) AS affected_field, split_part(v, ':', 2) AS issue_type, COUNT(*) AS rejected_count, "
        f"a.bronze_count AS total_entity_records, {_pct('COUNT(*)', 'a.bronze_count')} AS rejection_rate_pct, "
        "array_to_string(list_transform(list_slice(list(record_key ORDER BY record_key NULLS LAST), 1, 3), lambda k: coalesce(k, '')), ',') "
        "AS sample_keys "
        "FROM rejects r JOIN audit a ON r.source_table = 'clean_' || a.entity GROUP BY a.entity, v, a.bronze_count"
    )
    q["dq_prompts"] = (
        f"SELECT entity, affected_field, '{fv.QUALITY_PROMPT.split('Entity: ')[0].format(company='the company')}' || "
        "format('Entity: {}. Field: {}. Issue: {}. Rejected: {} out of {} records ({}%).', entity, affected_field, issue_type, "
        f"rejected_count, total_entity_records, {_dec('rejection_rate_pct')}) AS prompt FROM (" + q["dq_rejection_rates"] + ")"
    )
    q["dim_customers"] = "SELECT * FROM customers_d"
    q["dim_products"] = "SELECT * FROM products_d"
    q["dim_vendors"] = "SELECT * FROM vendors_d"
    q["dim_dates"] = _portable("SELECT * FROM dates_d", "date_key")
    q["fact_sales"] = _portable(
        "SELECT * EXCLUDE (order_file, line_file) FROM sold", "order_date_key", "order_purchase_date", "_load_timestamp"
    )
    q["fact_returns"] = _portable("SELECT * FROM sent_back", "return_date_key", "return_date", "_load_timestamp")
    q["bridge_return_products"] = (
        "SELECT * REPLACE (CAST(return_date_key AS VARCHAR) AS return_date_key, CAST(_load_timestamp AS VARCHAR) AS _load_timestamp, "
        "CAST(CAST(allocation_weight AS DECIMAL(18,6)) AS DOUBLE) AS allocation_weight) FROM allocated"
    )
    q["mv_revenue_by_region"] = "SELECT * EXCLUDE (avg_order_value) RENAME (total_revenue AS total_sales) FROM monthly"
    q["mv_monthly_revenue_by_region"] = "SELECT * FROM monthly"
    q["mv_return_rate_by_vendor"] = "SELECT * FROM vendor_rates"
    q["mv_slow_moving_products"] = "SELECT * FROM slow"
    q["mv_segment_profitability"] = f"""
SELECT segment, region, COUNT(DISTINCT order_id) AS order_count, COUNT(DISTINCT customer_id) AS customer_count,
  {_money("sales")} AS total_revenue, {_money("profit")} AS total_profit,
  {_pct("SUM(CAST(profit AS DECIMAL(18,4)))", "SUM(CAST(sales AS DECIMAL(18,4)))")} AS profit_margin_pct,
  {_avg("discount", 4)} AS avg_discount
FROM sold_to GROUP BY segment, region"""
    q["mv_customer_return_history"] = _portable("SELECT * FROM history", "first_return_date", "last_return_date")
    q["mv_return_reason_analysis"] = f"""
SELECT return_reason, region, COUNT(*) AS return_count, {_money("refund_amount")} AS total_refunded,
  {_avg("refund_amount")} AS avg_refund, COUNT(DISTINCT customer_id) AS unique_customers,
  COUNT(*) FILTER (return_status = 'Approved') AS approved_count, COUNT(*) FILTER (return_status = 'Rejected') AS rejected_count
FROM sent_back_by GROUP BY return_reason, region"""
    q["mv_product_return_impact"] = "SELECT * FROM impact"
    q["mv_vendor_product_performance"] = f"""
SELECT v.vendor_id, v.vendor_name, p.product_id, p.product_name, p.brand, a.region, a.order_count, a.total_sales,
  a.total_quantity, a.total_profit, IFNULL(b.n, 0) AS return_count, IFNULL(b.refunded, 0.0) AS total_allocated_refund
FROM (SELECT vendor_id, product_id, region, vendor_sk, product_sk, COUNT(DISTINCT order_id) AS order_count,
        {_money("sales")} AS total_sales, CAST(SUM(quantity) AS BIGINT) AS total_quantity, {_money("profit")} AS total_profit
      FROM sold_to GROUP BY ALL) a
JOIN vendors_d v USING (vendor_sk) JOIN products_d p USING (product_sk)
LEFT JOIN (SELECT s.vendor_id, x.product_id, COUNT(*) AS n, {_money("x.allocated_refund")} AS refunded
           FROM allocated x JOIN (SELECT DISTINCT order_id, vendor_id FROM sold) s USING (order_id) GROUP BY ALL) b
  ON b.vendor_id = a.vendor_id AND b.product_id = a.product_id"""
    q["fraud_thresholds"] = (
        "SELECT CAST(CAST(p75_returns AS DECIMAL(18,6)) AS DOUBLE) AS p75_returns, "
        "CAST(CAST(p75_refund AS DECIMAL(18,6)) AS DOUBLE) AS p75_refund, "
        "CAST(CAST(p75_avg_refund AS DECIMAL(18,6)) AS DOUBLE) AS p75_avg_refund FROM thresholds"
    )
    q["fraud_scores"] = (
        "SELECT customer_id, pts.n AS score_high_return_count, pts.r AS score_high_total_refund, pts.a AS score_high_avg_refund, "
        "pts.ok AS score_high_approval_rate, pts.why AS score_multiple_reasons, CAST(anomaly_score AS INTEGER) AS anomaly_score, "
        "rules_violated FROM scores"
    )
    lead = fv.INVESTIGATION_PROMPT.split("Customer: ")[0].format(company="the company")
    q["flagged_return_customers"] = f"""
SELECT customer_id, customer_name, segment, region, total_returns, total_refund_value, avg_refund_per_return,
  approval_rate_pct AS approval_rate, distinct_reason_count, return_reasons, CAST(anomaly_score AS INTEGER) AS anomaly_score,
  rules_violated, '{lead}Customer: ' || customer_name || ' (' || customer_id || '). Segment: ' || segment || '. Region: ' || region
  || '. Returns: ' || total_returns || '. Total refunded: $' || {_dec("total_refund_value")} || '. Avg refund: $'
  || {_dec("avg_refund_per_return")} || '. Approval rate: ' || {_dec("approval_rate_pct")} || '%. Reasons: '
  || IFNULL(return_reasons, 'N/A') || '. Score: ' || anomaly_score || '/100. Rules: ' || rules_violated AS prompt,
  'Draft for ' || length(prompt) || ' characters: ' || prompt AS investigation_brief
FROM scores WHERE anomaly_score >= 40"""
    q["kpi_totals"] = (
        f"SELECT {_money('total_revenue')} AS grand_total_revenue, {_money('total_profit')} AS grand_total_profit, "
        "CAST(SUM(total_quantity) AS BIGINT) AS grand_total_units, CAST(SUM(order_count) AS BIGINT) AS grand_total_orders FROM monthly"
    )
    q["kpi_by_region"] = "SELECT * FROM region_kpis"
    q["kpi_top5_return_cost"] = (
        "SELECT product_id, product_name, region, total_return_cost FROM impact "
        "ORDER BY total_return_cost DESC NULLS LAST, product_id, region LIMIT 5"
    )
    q["kpi_documents"] = "SELECT insight_type, kpi_data FROM kpi_docs"
    insight = fv.INSIGHT_PROMPT.split("Domain: ")[0].format(company="the company")
    prompt = f"'{insight}Domain: ' || insight_type || '. KPIs: ' || kpi_data"
    q["ai_business_insights"] = (
        f"SELECT insight_type, prompt, 'Draft for ' || length(prompt) || ' characters: ' || prompt AS executive_summary, kpi_data "
        f"FROM (SELECT *, {prompt} AS prompt FROM kpi_docs)"
    )
    q["rag_documents"] = "SELECT * FROM docs"
    q["rag_context"] = "SELECT qid, question, documents, retrieved_count FROM context"
    answer = fv.ANSWER_PROMPT.split("Question: ")[0]
    q["rag_query_history"] = (
        "SELECT question, prompt, 'Draft for ' || length(prompt) || ' characters: ' || prompt AS answer, "
        "IFNULL(documents, '') AS retrieved_documents, retrieved_count, CAST(0.0 AS DOUBLE) AS top_distance FROM ("
        f"SELECT *, '{answer}Question: ' || question || ' Documents: ' || IFNULL(documents, '{fv.NO_DOCUMENTS}') AS prompt FROM context)"
    )
    q["q_revenue_by_region"] = f"SELECT c.region, {_money('s.sales')} AS total_revenue FROM sold s LEFT JOIN customers_d c USING (customer_sk) GROUP BY 1"
    q["q_vendor_return_rate"] = "SELECT vendor_id, vendor_name, return_rate_pct FROM vendor_rates"
    q["q_top5_products_west"] = (
        f"SELECT p.product_id, p.product_name, {_money('s.sales')} AS total_revenue FROM sold_to s JOIN products_d p USING (product_sk) "
        "WHERE s.region = 'West' GROUP BY 1, 2 ORDER BY 3 DESC NULLS LAST, 1 LIMIT 5"
    )
    q["q_top_refund_customers"] = "SELECT customer_id, customer_name, total_refund_value, total_returns FROM history"
    q["q_margin_by_segment"] = f"""
SELECT segment, {_money("sales")} AS total_revenue, {_money("profit")} AS total_profit,
  {_pct("SUM(CAST(profit AS DECIMAL(18,4)))", "SUM(CAST(sales AS DECIMAL(18,4)))")} AS profit_margin_pct
FROM sold_to GROUP BY segment"""
    q["semantic_star"] = f"""
SELECT c.segment, p.brand, v.vendor_name, d.quarter, COUNT(*) AS lines, {_money("s.sales")} AS total_sales
FROM sold s LEFT JOIN customers_d c USING (customer_sk) LEFT JOIN products_d p USING (product_sk)
  LEFT JOIN vendors_d v USING (vendor_sk) LEFT JOIN dates_d d ON d.date_sk = s.order_date_sk
GROUP BY ALL"""
    duplicated = "SELECT COUNT(*) FROM (SELECT {0} FROM {1} GROUP BY 1 HAVING COUNT(*) > 1)"
    joins = [
        ("fact_sales", "dim_customers", "customer_sk = customer_sk", "customer_sk", "customers_d"),
        ("fact_sales", "dim_products", "product_sk = product_sk", "product_sk", "products_d"),
        ("fact_sales", "dim_vendors", "vendor_sk = vendor_sk", "vendor_sk", "vendors_d"),
        ("fact_sales", "dim_dates", "order_date_sk = date_sk", "date_sk", "dates_d"),
        ("fact_returns", "dim_customers", "customer_sk = customer_sk", "customer_sk", "customers_d"),
        ("fact_returns", "dim_dates", "return_date_sk = date_sk", "date_sk", "dates_d"),
    ]
    q["semantic_join_cardinality"] = " UNION ALL ".join(
        f"SELECT '{a}' AS left_table, '{b}' AS right_table, '{c}' AS condition, ({duplicated.format(k, t)}) AS duplicate_keys"
        for a, b, c, k, t in joins
    )

    def landed(entity: str, fields: list[str]) -> str:
        trimmed = ", ".join(f"NULLIF(TRIM({c}), '') AS {c}" for c in fields)
        return f"SELECT {trimmed}, _source_file FROM raw_{entity}"

    q["ingest_csv_customers"] = landed("customers", list(fv.BRONZE_KEYS["customers"])).replace(
        "NULLIF(TRIM(customer_email), '')", "IF(_source_file = 'Region5/customers_5.csv', NULL, customer_email)"
    )
    q["ingest_csv_transactions"] = landed("transactions", list(fv.BRONZE_KEYS["transactions"]))
    q["ingest_json_returns"] = f"SELECT {', '.join(fv.BRONZE_KEYS['returns'])}, _source_file FROM raw_returns"
    q["document_refresh"] = (
        "SELECT *, IF(doc_type = 'vendor' OR coalesce(region = 'West' AND upper(doc_text) <> doc_text, FALSE), "
        "'2024-01-02 00:00:00', '2024-01-01 00:00:00') AS updated_at FROM docs"
    )
    q["ingest_json_array"] = q["ingest_json_returns"].replace(" FROM", ", '2024-01-01 00:00:00' AS _load_timestamp FROM", 1)
    q["stored_view_segments"], q["stored_view_audit"] = q["mv_segment_profitability"], q["audit_log"]
    q["ingest_report"] = " UNION ALL ".join(
        f"SELECT '{e}' AS entity, _source_file AS source_file, 'loaded' AS status, NULL AS message, COUNT(*) AS row_count "
        f"FROM raw_{e} GROUP BY _source_file"
        for e in ("customers", "orders", "returns", "vendors")
    ) + " UNION ALL SELECT e, NULL, 'warning', 'no files found', 0 FROM (VALUES ('transactions'), ('products')) t(e)"
    q["ingest_new_files_only"] = "SELECT _source_file, COUNT(*) AS row_count FROM raw_orders GROUP BY 1"
    q["incremental_append"] = "SELECT source_table, record_key, split_part(v, ':', 1) AS affected_field, _source_file FROM rejects" + "".join(
        f" UNION ALL SELECT 'clean_{e}', {KEYS[e]}, NULL, _source_file FROM ok_{e}" for e in TESTS
    )
    late_orders, late_lines = "Region1/orders_1.csv", "Region4/transactions_2.csv"
    moved = f"IF(order_file = '{late_orders}', TIMESTAMP '2024-01-02 00:00:00', _load_timestamp)"
    sales = "SELECT * EXCLUDE (order_file, line_file) REPLACE ({} AS _load_timestamp) FROM sold{}"
    days = ("order_date_key", "order_purchase_date", "_load_timestamp")
    q["incremental_facts_late_data"] = _portable(
        sales.format(moved, f" WHERE line_file <> '{late_lines}' OR order_file = '{late_orders}'"), *days
    )
    q["incremental_facts_repaired"] = _portable(sales.format(moved, ""), *days)
    q["incremental_returns_late_data"] = _portable(
        "SELECT r.order_id, c.customer_sk, o.customer_id, d.date_sk AS return_date_sk, r.return_date AS return_date_key, "
        "r.refund_amount, r.return_reason, r.return_status, r.return_date, o.vendor_id, r._load_timestamp FROM ok_returns r "
        f"LEFT JOIN (SELECT * FROM ok_orders WHERE _source_file <> '{late_orders}') o USING (order_id) "
        "LEFT JOIN customers_d c ON c.customer_id = o.customer_id LEFT JOIN dates_d d ON d.date_key = r.return_date",
        "return_date_key", "return_date", "_load_timestamp",
    )
    q["incremental_returns_repaired"] = q["fact_returns"]
    stored = {
        **{f"clean_{e}": f"ok_{e}" for e in TESTS}, "rejected_records": "rejects", "dim_customers": "customers_d",
        "dim_products": "products_d", "dim_vendors": "vendors_d", "dim_dates": "dates_d", "fact_sales": "sold",
        "fact_returns": "sent_back", "bridge_return_products": "allocated",
    }
    q["full_refresh_idempotent"] = " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, COUNT(*) AS row_count FROM {cte}" for name, cte in stored.items()
    )
    q["stream_ingest_available_now"] = q["ingest_new_files_only"]
    q["stream_equals_batch"] = f"SELECT {TYPED_COLUMNS['orders']}, _source_file FROM ok_orders"
    q["reset_and_reload"] = q["stream_equals_batch"]
    q["stream_to_gold"] = (
        "SELECT 'fact_sales' AS table_name, order_id, customer_sk AS first_key, product_sk AS second_key, sales AS amount FROM sold "
        "UNION ALL SELECT 'fact_returns', order_id, customer_sk, return_reason, refund_amount FROM sent_back "
        "UNION ALL SELECT 'bridge_return_products', order_id, product_sk, product_id, allocated_refund FROM allocated"
    )
    q["stream_retry_gold"] = q["stream_to_gold"]
    q["stream_skip_empty"] = "SELECT 'orders' AS entity, COUNT(*) AS bronze_count, CAST(0 AS BIGINT) AS rows_in_last_run FROM raw_orders"
    texts = {name: compose(select) for name, select in q.items()}
    texts["search_topk"] = compose("SELECT * FROM best", _bm25("docs", "doc_id", "doc_text", 5))
    texts["search_topk_filtered"] = compose(
        "SELECT * FROM best", {**_bm25("vendor_docs", "doc_id", "doc_text", 5), "vendor_docs": "SELECT * FROM docs WHERE doc_type = 'vendor'"}
    )
    texts["search_documents"] = compose("SELECT * FROM best", _bm25("documents", "doc_id", "text", 5))
    return texts
