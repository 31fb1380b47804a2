"""Silver harmonisation: one typed row per bronze row, with the raw text kept where parsing can fail."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tillwright import fixed_values as fv
from tillwright.functions import parsing as p
from tillwright.sources.landing import LINEAGE


def customers(bronze: DataFrame, swapped_files: str = fv.SWAPPED_CITY_STATE_FILES) -> DataFrame:
    swapped = f"_source_file ilike {p.quoted(swapped_files)}"
    return bronze.selectExpr(
        "coalesce(customer_id, customerid, cust_id, customer_identifier) as customer_id",
        "coalesce(customer_name, full_name) as customer_name",
        "coalesce(customer_email, email_address) as customer_email",
        f"{p.code_label('coalesce(segment, customer_segment)', fv.SEGMENT_CODES)} as segment",
        f"if({swapped}, state, city) as city",
        f"if({swapped}, city, state) as state",
        f"{p.code_label('region', fv.REGION_CODES)} as region",
        *LINEAGE,
    )


def orders(bronze: DataFrame) -> DataFrame:
    return bronze.selectExpr(
        "order_id",
        "customer_id",
        "vendor_id",
        f"{p.code_label('ship_mode', fv.SHIP_MODE_CODES, ignore_case=False)} as ship_mode",
        "lower(trim(order_status)) as order_status",
        "order_purchase_date as _raw_order_date",
        f"{p.order_time('order_purchase_date')} as order_purchase_date",
        *LINEAGE,
    )


def transactions(bronze: DataFrame) -> DataFrame:
    return bronze.selectExpr(
        "coalesce(order_id, order_id_v1, order_id_v2) as order_id",
        "coalesce(product_id, product_id_v1, product_id_v2) as product_id",
        "vendor_id",
        "sales as _raw_sales",
        "discount as _raw_discount",
        f"{p.currency_amount('sales')} as sales",
        f"{p.safe_whole_number('quantity')} as quantity",
        f"{p.discount_ratio('discount')} as discount",
        f"{p.safe_double('profit')} as profit",
        "payment_type",
        *LINEAGE,
    )


def returns(bronze: DataFrame) -> DataFrame:
    """An unknown reason gets its label; an unknown refund is no number and so NULL."""
    spellings = bronze.selectExpr(
        "coalesce(order_id_v1, order_id_v2) as order_id",
        "coalesce(return_reason_v1, return_reason_v2) as reason",
        "coalesce(return_status_v1, return_status_v2) as status",
        "coalesce(refund_amount_v1, refund_amount_v2, refund_amount_v3) as _raw_refund",
        "coalesce(return_date_v1, return_date_v2, return_date_v3) as _raw_return_date",
        *LINEAGE,
    )
    return spellings.selectExpr(
        "order_id",
        f"if(reason = {p.quoted(fv.UNKNOWN_MARK)}, {p.quoted(fv.UNKNOWN_REASON)}, reason) as return_reason",
        f"{p.code_label('status', fv.RETURN_STATUS_CODES)} as return_status",
        "_raw_refund",
        "_raw_return_date",
        f"{p.safe_double('_raw_refund')} as refund_amount",
        f"{p.return_day('_raw_return_date')} as return_date",
        *LINEAGE,
    )


def products(bronze: DataFrame) -> DataFrame:
    texts = ("product_id", "product_name", "brand", "category", "sub_category")
    return bronze.selectExpr(*[f"trim({c}) as {c}" for c in texts], f"{p.digits_of_number('upc')} as upc", *LINEAGE)


def vendors(bronze: DataFrame) -> DataFrame:
    return bronze.selectExpr("trim(vendor_id) as vendor_id", "trim(vendor_name) as vendor_name", *LINEAGE)


HARMONIZERS = {
    "customers": customers,
    "orders": orders,
    "transactions": transactions,
    "returns": returns,
    "products": products,
    "vendors": vendors,
}
