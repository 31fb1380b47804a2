"""The 23 quality rules as data, and what follows from them: flags, clean rows, quarantine, audit."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwright import fixed_values as fv
from tillwright.functions.parsing import one_of, quoted
from tillwright.sources.landing import LINEAGE

ANY_FAILURE = "_has_any_failure"


@dataclass(frozen=True)
class Rule:
    """``fails`` is a SQL predicate over the harmonised columns."""

    number: int
    entity: str
    flag: str
    field: str
    issue: str
    fails: str


def _missing(field: str) -> str:
    return f"{field} is null"


def _blank(field: str) -> str:
    return f"{field} is null or {field} = ''"


def _not_in(field: str, allowed: Iterable[str]) -> str:
    return f"{field} is null or {field} not in {one_of(allowed)}"


def _unparsed(field: str, raw: str) -> str:
    return f"{field} is null and {raw} is not null"


def _outside(field: str, test: str) -> str:
    return f"{field} is null or {field} {test}"


RULES = (
    Rule(1, "customers", "_fail_customer_id_null", "customer_id", "missing_value", _missing("customer_id")),
    Rule(2, "customers", "_fail_customer_name_null", "customer_name", "missing_value", _missing("customer_name")),
    Rule(3, "customers", "_fail_invalid_segment", "segment", "invalid_value", _not_in("segment", fv.SEGMENTS)),
    Rule(4, "customers", "_fail_invalid_region", "region", "invalid_value", _not_in("region", fv.REGIONS)),
    Rule(5, "orders", "_fail_order_id_null", "order_id", "missing_value", _missing("order_id")),
    Rule(6, "orders", "_fail_customer_id_null", "customer_id", "missing_value", _missing("customer_id")),
    Rule(7, "orders", "_fail_invalid_ship_mode", "ship_mode", "invalid_value", _not_in("ship_mode", fv.SHIP_MODES)),
    Rule(
        8, "orders", "_fail_invalid_order_status", "order_status", "invalid_value",
        _not_in("order_status", fv.ORDER_STATUSES),
    ),
    Rule(
        9, "orders", "_fail_unparseable_date", "order_purchase_date", "parse_failure",
        _unparsed("order_purchase_date", "_raw_order_date"),
    ),
    Rule(10, "transactions", "_fail_order_id_null", "order_id", "missing_value", _missing("order_id")),
    Rule(11, "transactions", "_fail_product_id_null", "product_id", "missing_value", _missing("product_id")),
    Rule(12, "transactions", "_fail_negative_sales", "sales", "out_of_range", _outside("sales", "< 0")),
    Rule(13, "transactions", "_fail_non_positive_quantity", "quantity", "out_of_range", _outside("quantity", "<= 0")),
    Rule(
        14, "transactions", "_fail_discount_out_of_range", "discount", "out_of_range",
        _outside("discount", "not between 0 and 1"),
    ),
    Rule(15, "returns", "_fail_order_id_null", "order_id", "missing_value", _missing("order_id")),
    Rule(
        16, "returns", "_fail_negative_refund", "refund_amount", "out_of_range",
        f"refund_amount < 0 or (refund_amount is null and _raw_refund <> {quoted(fv.UNKNOWN_MARK)})",
    ),
    Rule(
        17, "returns", "_fail_invalid_return_status", "return_status", "invalid_value",
        _not_in("return_status", fv.RETURN_STATUSES),
    ),
    Rule(
        18, "returns", "_fail_invalid_return_reason", "return_reason", "invalid_value",
        _outside("return_reason", f"= {quoted(fv.UNKNOWN_REASON)}"),
    ),
    Rule(
        19, "returns", "_fail_unparseable_return_date", "return_date", "parse_failure",
        _unparsed("return_date", "_raw_return_date"),
    ),
    Rule(20, "products", "_fail_product_id_null", "product_id", "missing_value", _missing("product_id")),
    Rule(21, "products", "_fail_product_name_null", "product_name", "missing_value", _missing("product_name")),
    Rule(22, "vendors", "_fail_vendor_id_null", "vendor_id", "missing_value", _blank("vendor_id")),
    Rule(23, "vendors", "_fail_vendor_name_null", "vendor_name", "missing_value", _blank("vendor_name")),
)

RECORD_KEY = {
    "customers": "customer_id",
    "orders": "order_id",
    "transactions": "order_id",
    "returns": "order_id",
    "products": "product_id",
    "vendors": "vendor_id",
}

CLEAN_COLUMNS = {
    "customers": (
        "customer_id", "customer_name", "customer_email", "segment", "city", "state", "region", *LINEAGE,
    ),
    "orders": (
        "order_id", "customer_id", "vendor_id", "ship_mode", "order_status", "order_purchase_date", *LINEAGE,
    ),
    "transactions": (
        "order_id", "product_id", "vendor_id", "sales", "quantity", "discount", "profit", "payment_type", *LINEAGE,
    ),
    "returns": ("order_id", "return_reason", "return_status", "refund_amount", "return_date", *LINEAGE),
    "products": ("product_id", "product_name", "brand", "category", "sub_category", "upc", *LINEAGE),
    "vendors": ("vendor_id", "vendor_name", *LINEAGE),
}


def rules_for(entity: str) -> list[Rule]:
    return [r for r in RULES if r.entity == entity]


def flag(harmonized: DataFrame, entity: str) -> DataFrame:
    """Add one never-NULL flag per rule and their disjunction, and observe how many rows pass by and fail.

    A filter on the flags stays above the observed rows, so each value is parsed once per row; without it the
    optimizer would repeat all parsing inside the filter.
    """
    rules = rules_for(entity)
    flagged = harmonized.selectExpr("*", *[f"coalesce({r.fails}, false) as {r.flag}" for r in rules])
    return flagged.selectExpr("*", f"{' or '.join(r.flag for r in rules)} as {ANY_FAILURE}").observe(
        f"{entity}_quality", F.count(F.lit(1)).alias("records"), F.count_if(F.col(ANY_FAILURE)).alias("rejected")
    )


def clean(flagged: DataFrame, entity: str) -> DataFrame:
    return flagged.where(f"not {ANY_FAILURE}").select(*CLEAN_COLUMNS[entity])


def violations(
    flagged: DataFrame, source_table: str, record_key: str, checks: Iterable[tuple[str, str, str]]
) -> DataFrame:
    """One row per record and failed check; ``checks`` holds (flag column, affected field, issue type).

    The relation is read once: a record's failed checks form an array that is exploded.
    """
    checks = list(checks)
    failed = " or ".join(name for name, _, _ in checks)
    hits = ", ".join(
        f"if({name}, named_struct('field', {quoted(field)}, 'issue', {quoted(issue)}), null)" for name, field, issue in checks
    )
    return (
        flagged.where(failed)
        .withColumn("_record", F.to_json(F.struct("*")))
        .withColumn("_hit", F.expr(f"explode(array_compact(array({hits})))"))
        .select(
            F.lit(source_table).alias("source_table"),
            F.col(record_key).alias("record_key"),
            F.col("_hit.field").alias("affected_field"),
            F.col("_hit.issue").alias("issue_type"),
            F.col("_record").alias("record_data"),
            "_source_file",
            F.current_timestamp().alias("rejected_at"),
            "_load_timestamp",
        )
    )


def rejected(flagged: DataFrame, entity: str) -> DataFrame:
    checks = [(r.flag, r.field, r.issue) for r in rules_for(entity)]
    return violations(flagged, f"clean_{entity}", RECORD_KEY[entity], checks)


def audit(flagged: DataFrame, entity: str) -> DataFrame:
    """One pass: every row is counted as clean or rejected by the same flag."""
    return flagged.agg(
        F.lit(entity).alias("entity"),
        F.count("*").alias("bronze_count"),
        F.count_if(~F.col(ANY_FAILURE)).alias("silver_count"),
        F.count_if(F.col(ANY_FAILURE)).alias("rejected_count"),
    )
