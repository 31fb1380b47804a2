"""The relations of one warehouse: read where they are stored, else derived lazily from the layer below."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwright import fixed_values as fv
from tillwright.functions.numbers import exact_sum
from tillwright.operators import dimensions, facts, harmonize, rules
from tillwright.session import stage, stage_all
from tillwright.sources.landing import extract


class Mart:
    """``landing`` gives the landed rows of an entity; ``stored`` maps a table name to what is on disk.

    A stored table always wins, so that reports on an incrementally loaded warehouse see the facts as they
    were loaded and not as they would be derived today.
    """

    def __init__(
        self,
        landing: Callable[[str], DataFrame] | None = None,
        stored: Mapping[str, DataFrame] | None = None,
        swapped_files: str = fv.SWAPPED_CITY_STATE_FILES,
    ) -> None:
        self._landing = landing
        self._stored = dict(stored or {})
        self._swapped_files = swapped_files
        self._derived: dict[str, DataFrame] = {}

    def _table(self, name: str, derive: Callable[[], DataFrame]) -> DataFrame:
        if name in self._stored:
            return self._stored[name]
        if name not in self._derived:
            self._derived[name] = derive()
        return self._derived[name]

    # Bronze and silver

    def landing(self, entity: str) -> DataFrame:
        return self._table(f"landing_{entity}", lambda: self._landing(entity))

    def bronze(self, entity: str) -> DataFrame:
        return self._table(f"raw_{entity}", lambda: extract(self.landing(entity), entity))

    def harmonized(self, entity: str) -> DataFrame:
        """Typed rows with rule flags; never stored, and the same relation for all that read it."""
        options = {"swapped_files": self._swapped_files} if entity == "customers" else {}
        return self._table(
            f"_harmonized_{entity}",
            lambda: rules.flag(harmonize.HARMONIZERS[entity](self.bronze(entity), **options), entity),
        )

    def has_stored(self, name: str) -> bool:
        return name in self._stored

    def clean_anew(self, entity: str) -> DataFrame:
        return rules.clean(self.harmonized(entity), entity)

    def hold(self, *entities: str) -> Mart:
        """Write clean tables that are not stored, for a report that reads them several times."""
        missing = [e for e in entities if f"clean_{e}" not in self._stored]
        self._stored |= stage_all({f"clean_{e}": self.clean(e) for e in missing})
        return self

    def hold_rejects(self) -> Mart:
        """Write the quarantine if it is not stored, for a report that reads it several times."""
        if "rejected_records" not in self._stored:
            self._stored["rejected_records"] = stage(self.rejected_records, "rejected_records")
        return self

    def clean(self, entity: str) -> DataFrame:
        return self._table(f"clean_{entity}", lambda: self.clean_anew(entity))

    @property
    def rejected_records(self) -> DataFrame:
        return self._table(
            "rejected_records",
            lambda: reduce(DataFrame.unionByName, [rules.rejected(self.harmonized(e), e) for e in fv.ENTITIES]),
        )

    @property
    def pipeline_audit_log(self) -> DataFrame:
        """Counted from bronze, so that it checks the split into clean and rejected rows."""
        return reduce(DataFrame.unionByName, [rules.audit(self.harmonized(e), e) for e in fv.ENTITIES])

    # Dimensions

    @property
    def dim_customers(self) -> DataFrame:
        return self._table("dim_customers", lambda: dimensions.customers(self.clean("customers")))

    @property
    def dim_products(self) -> DataFrame:
        return self._table("dim_products", lambda: dimensions.products(self.clean("products")))

    @property
    def dim_vendors(self) -> DataFrame:
        return self._table("dim_vendors", lambda: dimensions.vendors(self.clean("vendors")))

    @property
    def dim_dates(self) -> DataFrame:
        return self._table("dim_dates", lambda: dimensions.dates(self.clean("orders"), self.clean("returns")))

    # Facts

    @property
    def fact_sales(self) -> DataFrame:
        return self._table(
            "fact_sales",
            lambda: facts.with_keys(self.slim_sales(self._known)),
        )

    def slim_sales(self, mark: facts.Mark) -> DataFrame:
        return facts.slim_sales(self.clean("orders"), self.clean("transactions"), mark)

    def slim_returns(self, mark: facts.Mark) -> DataFrame:
        return facts.slim_returns(self.clean("returns"), self.clean("orders"), mark)

    @property
    def _known(self) -> facts.Mark:
        return facts.known_in({"customer": self.dim_customers, "product": self.dim_products, "vendor": self.dim_vendors})

    @property
    def fact_returns(self) -> DataFrame:
        return self._table("fact_returns", lambda: facts.with_keys(self.slim_returns(self._known)))

    @property
    def bridge_return_products(self) -> DataFrame:
        return self._table(
            "bridge_return_products",
            lambda: facts.bridge_keys(self.slim_bridge()),
        )

    def slim_bridge(self) -> DataFrame:
        return facts.slim_bridge(
            self.returns(customer=[], date=["date_sk"]).withColumnRenamed("date_sk", "return_date_sk"),
            self._product_sales(),
        )

    def _product_sales(self) -> DataFrame:
        """Products and sales of the lines; unless the facts are stored, a flag in the place of the product's key."""
        columns = ["product_id", "sales"]
        if "fact_sales" in self._stored:
            return self.sales(product=["product_sk"], measures=columns)
        known = self.dim_products.select("product_id", F.lit(True).alias("product_sk"))
        lines = facts.lookup(self.clean("transactions"), known, "product_id", "product_id", ["product_sk"])
        rows = facts.sales_lines(facts.keyed_orders(self.clean("orders"), self.dim_customers), lines)
        return rows.select("order_id", "product_sk", *columns)

    def relation(self, name: str) -> DataFrame:
        """A clean table, dimension or fact by name."""
        return self.clean(name.removeprefix("clean_")) if name.startswith("clean_") else getattr(self, name)

    # Facts joined to just the attributes a report needs

    def sales(
        self,
        customer: Sequence[str] = (),
        date: Sequence[str] = (),
        product: Sequence[str] = (),
        vendor: Sequence[str] = (),
        measures: Sequence[str] = (),
    ) -> DataFrame:
        """Sales lines with the named dimension attributes and fact columns."""
        if "fact_sales" in self._stored:
            rows = self._stored["fact_sales"]
            rows = self._attach(rows, self.dim_customers, "customer_sk", customer)
            rows = self._attach(rows, self.dim_products, "product_sk", product)
            rows = self._attach(rows, self.dim_vendors, "vendor_sk", vendor)
            rows = facts.with_date(rows, "order_date_key", date)
        else:
            orders = facts.keyed_orders(self.clean("orders"), self.dim_customers, customer, date)
            lines = facts.lookup(self.clean("transactions"), self.dim_products, "product_id", "product_id", product)
            rows = facts.sales_lines(orders, lines)
            rows = facts.lookup(rows, self.dim_vendors, "vendor_id", "vendor_id", vendor)
        wanted = ["order_id", *customer, *date, *product, *vendor, *measures]
        return rows.select(*dict.fromkeys(wanted))

    def order_sales(self, customer: Sequence[str] = (), date: Sequence[str] = ()) -> DataFrame:
        """Line measures summed per order before any dimension is joined; a hot order shrinks first."""
        sums = [
            F.count("*").alias("lines"),
            exact_sum(F.col("sales")).alias("sales"),
            exact_sum(F.col("profit")).alias("profit"),
            F.sum(F.col("quantity").cast("decimal(38,0)")).alias("quantity"),
            exact_sum(F.col("discount")).alias("discount"),
        ]
        if "fact_sales" in self._stored:
            keys = ["order_id", "customer_id", "customer_sk", "order_date_key"]
            rows = self._stored["fact_sales"].groupBy(*keys).agg(*sums)
            rows = self._attach(rows, self.dim_customers, "customer_sk", customer)
            rows = facts.with_date(rows, "order_date_key", date)
        else:
            totals = self.clean("transactions").groupBy("order_id").agg(*sums)
            orders = facts.keyed_orders(self.clean("orders"), self.dim_customers, customer, date)
            rows = orders.join(totals, "order_id")
        measures = ["lines", "sales", "profit", "quantity", "discount"]
        return rows.select(*dict.fromkeys(["order_id", "customer_id", *customer, *date, *measures]))

    def returns(self, customer: Sequence[str] = (), date: Sequence[str] = ()) -> DataFrame:
        """Return events with the named customer and return-date attributes."""
        if "fact_returns" in self._stored:
            rows = self._stored["fact_returns"].withColumnRenamed("return_date_sk", "date_sk")
            rows = self._attach(rows, self.dim_customers, "customer_sk", customer)
            return facts.with_date(rows, "return_date_key", date)
        return facts.returns(self.clean("returns"), self.clean("orders"), self.dim_customers, customer, date)

    def order_products(self, customer: Sequence[str]) -> DataFrame:
        """Customer attributes of each order, or of each product of an order where the facts are stored.

        A stored fact may lack lines that its order has by now, so that the products count there.
        """
        if "fact_sales" in self._stored:
            return self.sales(customer=customer, product=["product_sk"]).distinct()
        orders = facts.keyed_orders(self.clean("orders"), self.dim_customers, customer)
        return orders.select("order_id", *customer).distinct()

    @staticmethod
    def _attach(rows: DataFrame, dimension: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
        missing = [c for c in columns if c not in rows.columns]
        return facts.lookup(rows, dimension, key, key, missing)
