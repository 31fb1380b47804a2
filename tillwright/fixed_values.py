"""Code lists, patterns, labels and texts that decide what a right result is."""

# --- Landing -----------------------------------------------------------------------------------------

# File name pattern -> entity and file type.
FILE_ROUTES = {
    "customers": (r".*customers.*[.]csv", "csv"),
    "orders": (r".*orders.*[.]csv", "csv"),
    "transactions": (r".*transactions.*[.]csv", "csv"),
    "returns": (r".*returns.*[.]json", "json"),
    "products": (r".*products[.]json", "json"),
    "vendors": (r".*vendors[.]csv", "csv"),
}

ENTITIES = tuple(FILE_ROUTES)

# Tokens that mean NULL in a CSV field.
CSV_NULL_TOKENS = ("", "NULL", "null")

# Bronze column -> key of the landed object, per entity. Keys are case-sensitive.
BRONZE_KEYS = {
    "customers": {
        "customer_id": "customer_id",
        "customerid": "CustomerID",
        "cust_id": "cust_id",
        "customer_identifier": "customer_identifier",
        "customer_name": "customer_name",
        "full_name": "full_name",
        "customer_email": "customer_email",
        "email_address": "email_address",
        "segment": "segment",
        "customer_segment": "customer_segment",
        "city": "city",
        "state": "state",
        "region": "region",
    },
    "orders": {
        "order_id": "order_id",
        "customer_id": "customer_id",
        "vendor_id": "vendor_id",
        "ship_mode": "ship_mode",
        "order_status": "order_status",
        "order_purchase_date": "order_purchase_date",
    },
    "transactions": {
        "order_id": "order_id",
        "order_id_v1": "Order_id",
        "order_id_v2": "Order_ID",
        "product_id": "product_id",
        "product_id_v1": "Product_id",
        "product_id_v2": "Product_ID",
        "vendor_id": "vendor_id",
        "sales": "Sales",
        "quantity": "Quantity",
        "discount": "discount",
        "profit": "profit",
        "payment_type": "payment_type",
    },
    "returns": {
        "order_id_v1": "order_id",
        "order_id_v2": "OrderId",
        "return_reason_v1": "return_reason",
        "return_reason_v2": "reason",
        "return_status_v1": "return_status",
        "return_status_v2": "status",
        "refund_amount_v1": "refund_amount",
        "refund_amount_v2": "RefundAmount",
        "refund_amount_v3": "amount",
        "return_date_v1": "return_date",
        "return_date_v2": "ReturnDate",
        "return_date_v3": "date_of_return",
    },
    "products": {
        "product_id": "product_id",
        "product_name": "product_name",
        "brand": "brand",
        "category": "categories",
        "sub_category": "sub_category",
        "upc": "upc",
    },
    "vendors": {
        "vendor_id": "vendor_id",
        "vendor_name": "vendor_name",
    },
}

# --- Silver ------------------------------------------------------------------------------------------

# Upper-cased code -> label.
SEGMENT_CODES = {
    "CONS": "Consumer",
    "CORP": "Corporate",
    "HO": "Home Office",
    "COSUMER": "Consumer",
    "CONSUMER": "Consumer",
    "CORPORATE": "Corporate",
    "HOME OFFICE": "Home Office",
}
REGION_CODES = {
    "W": "West",
    "S": "South",
    "EAST": "East",
    "WEST": "West",
    "SOUTH": "South",
    "CENTRAL": "Central",
    "NORTH": "North",
}
RETURN_STATUS_CODES = {
    "APPRVD": "Approved",
    "PENDG": "Pending",
    "RJCTD": "Rejected",
    "APPROVED": "Approved",
    "PENDING": "Pending",
    "REJECTED": "Rejected",
}
# Case-sensitive spelling -> label.
SHIP_MODE_CODES = {
    "1st": "First Class",
    "1st Class": "First Class",
    "2nd": "Second Class",
    "2nd Class": "Second Class",
    "Std": "Standard Class",
    "Std Class": "Standard Class",
}

SEGMENTS = ("Consumer", "Corporate", "Home Office")
REGIONS = ("East", "West", "South", "Central", "North")
SHIP_MODES = ("First Class", "Second Class", "Standard Class", "Same Day")
ORDER_STATUSES = ("canceled", "created", "delivered", "invoiced", "processing", "shipped", "unavailable")
RETURN_STATUSES = ("Approved", "Pending", "Rejected")

UNKNOWN_MARK = "?"
UNKNOWN_REASON = "Unknown"

# Files whose city and state labels are swapped (case-insensitive LIKE pattern on the source path).
SWAPPED_CITY_STATE_FILES = "%Region%4%"

# Order times: MM/DD/YYYY HH:MI, YYYY-MM-DD HH:MI, MM/DD/YYYY, YYYY-MM-DD, YYYY-MM-DDTHH:MI:SS.
ORDER_TIME_PATTERN = (
    r"^(\d{1,2}/\d{1,2}/\d{4}( \d{1,2}:\d{1,2})?"
    r"|\d{4}-\d{1,2}-\d{1,2}( \d{1,2}:\d{1,2}|T\d{1,2}:\d{1,2}:\d{1,2})?)$"
)
# Return dates: YYYY-MM-DD, MM-DD-YYYY, MM/DD/YYYY, YYYY-MM-DDTHH:MI:SS.
RETURN_DATE_PATTERN = (
    r"^(\d{4}-\d{1,2}-\d{1,2}(T\d{1,2}:\d{1,2}:\d{1,2})?"
    r"|\d{1,2}-\d{1,2}-\d{4}|\d{1,2}/\d{1,2}/\d{4})$"
)
MONTH_FIRST_PATTERN = r"^(\d{1,2})[-/](\d{1,2})[-/](\d{4})"

NUMBER_PATTERN = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
NOT_AMOUNT_PATTERN = r"[^0-9.\-]"

# --- Gold --------------------------------------------------------------------------------------------

SURROGATE_KEY_NULL = "_dbt_utils_surrogate_key_null_"
SURROGATE_KEY_SEPARATOR = "-"
SLOW_MOVING_SHARE = 0.25

# --- Insights ----------------------------------------------------------------------------------------

ANOMALY_QUANTILE = 0.75
ANOMALY_MIN_RETURNS = 3
ANOMALY_FLAG_SCORE = 40
# Rule name -> points.
ANOMALY_POINTS = {
    "high_return_count": 20,
    "high_total_refund": 25,
    "high_avg_refund": 20,
    "high_approval_rate": 15,
    "multiple_reasons": 20,
}
HIGH_APPROVAL_PCT = 90
HIGH_APPROVAL_MIN_RETURNS = 2
MULTIPLE_REASONS = 3

TOP_COST_ROWS = 5
SAMPLE_RECORDS = 3
SAMPLE_SEPARATOR = " | "

CONTEXT_SEPARATOR = " | "
CONTEXT_CHARS = 3000
CONTEXT_MAX_COUNT = 5
SLOW_MOVING_TAG = " [SLOW-MOVING]"

# Question number, question, document type searched, keyword every document must hold (or None).
QUESTIONS = (
    (1, "Which products are slow-moving and have low sales?", "product_region", "SLOW-MOVING"),
    (2, "Which vendor has the highest return rate?", "vendor", None),
    (3, "What are the top-selling products in the East region?", "product_region", "East"),
    (4, "Which products have the highest return cost?", "vendor", "return"),
    (5, "Which vendors are active in the West region and what are their sales?", "vendor", None),
)

NO_DOCUMENTS = "No relevant documents found."

# Prompt texts; {company} is the caller's company name, each {field} a column of the row.
INSIGHT_PROMPT = (
    "You are an executive analyst for {company}. Write a 4-6 sentence executive summary. "
    "Cite specific dollar amounts and percentages. Identify strongest and weakest areas. "
    "Include one actionable recommendation. "
    "Domain: {insight_type}. KPIs: {kpi_data}"
)
QUALITY_PROMPT = (
    "You are a data quality analyst for {company}, a US retail chain. "
    "Explain this data quality issue in 3-4 business-friendly sentences. "
    "Do NOT use technical jargon like NULL, parse failure, schema, or boolean. "
    "Name the specific field and sample values. "
    "Identify which business report is at risk. "
    "Recommend what the data steward should investigate. "
    "Entity: {entity}. Field: {affected_field}. Issue: {issue_type}. "
    "Rejected: {rejected_count} out of {total_entity_records} records ({rejection_rate_pct}%). "
    "Samples: {sample_records}"
)
INVESTIGATION_PROMPT = (
    "You are a fraud investigator for {company}. Write a 4-5 sentence investigation brief. "
    "Cite actual numbers. Acknowledge one innocent explanation. "
    "Identify the strongest fraud signal. Recommend exactly 2 specific next actions. "
    "Customer: {customer_name} ({customer_id}). Segment: {segment}. Region: {region}. "
    "Returns: {total_returns}. Total refunded: ${total_refund_value}. "
    "Avg refund: ${avg_refund_per_return}. Approval rate: {approval_rate_pct}%. "
    "Reasons: {return_reasons}. Score: {anomaly_score}/100. Rules: {rules_violated}"
)
ANSWER_PROMPT = (
    "Answer ONLY from the retrieved documents below. "
    "If the information is not in the documents, say so. "
    "Question: {question} Documents: {documents}"
)

# Document texts.
PRODUCT_DOC = "Product: {product_name}. Brand: {brand}. Category: {category}"
PRODUCT_REGION_DOC = (
    "{product_name} in {region}: ${total_sales} sales, {total_quantity} qty, ${total_profit} profit{tag}"
)
VENDOR_DOC = (
    "Vendor {vendor_name}: {total_orders} orders, ${total_sales} sales, {return_order_count} returns, "
    "{return_rate_pct}% return rate, ${total_refunded} refunded"
)
