"""Which orders a run changes in gold, and the gold tables of those orders alone.

Gold is kept in parts by a hash of the order id. A run notes the orders it is about to change, appends or replaces
their facts, renews their part of the bridge, and forgets the note at the end; a run that finds a note takes its
orders up again. Marks tell up to which load a build or repair had seen orders, lines, returns and customers, so that
a repair looks at what came after them and not at the whole facts.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwright.operators import facts
from tillwright.plans.mart import Mart
from tillwright.session import stage, stage_all
from tillwright.sources.tables import PART_ROWS, Finish, Tables, newer, number_of_parts, part_of, watermark

FACTS = ("fact_sales", "fact_returns", "bridge_return_products")
DIMENSION_KEYS = (("dim_customers", "customer"), ("dim_products", "product"), ("dim_vendors", "vendor"))

# What builds and repairs had seen, and the number of parts of each fact; gold in parts by another hash has other marks.
MARKS = "gold_marks_by_hash"
MARKS_SCHEMA = "entity string, mark timestamp_ntz, parts int"
MARKED = ("customers", "orders", "transactions", "returns")
# Orders whose facts or bridge rows a run is changing.
PENDING = "gold_pending"
KEY = "order_id"


@dataclass(frozen=True)
class Marks:
    parts: int
    seen: Mapping[str, datetime | None]


def read_marks(tables: Tables) -> Marks | None:
    """None before the facts were built whole."""
    stored = tables.read(MARKS)
    rows = stored.collect() if stored is not None else []
    return Marks(rows[0]["parts"], {r["entity"]: r["mark"] for r in rows}) if rows else None


def seen_by_now(tables: Tables, parts: int | None = None) -> Marks:
    clean = {entity: tables.read(f"clean_{entity}") for entity in MARKED}
    parts = parts or number_of_parts(clean["orders"].count() if clean["orders"] is not None else 0)
    return Marks(parts, {entity: watermark(rows) for entity, rows in clean.items()})


def write_marks(tables: Tables, marks: Marks) -> None:
    rows = [(entity, mark, marks.parts) for entity, mark in marks.seen.items()]
    tables.replace(MARKS, tables.spark.createDataFrame(rows, MARKS_SCHEMA).coalesce(1))


def _ids(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, [rows.select(KEY) for rows in frames]).where(F.col(KEY).isNotNull()).distinct()


def _new(tables: Tables, entity: str, mark: datetime | None) -> DataFrame:
    return newer(tables.read(f"clean_{entity}"), mark)


def appended(tables: Tables) -> DataFrame:
    """Orders of a plain run: those newer than the newest sale, and those of returns newer than the newest return."""
    orders = _new(tables, "orders", watermark(tables.read("fact_sales")))
    return _ids(orders, _new(tables, "returns", watermark(tables.read("fact_returns"))))


def repaired(tables: Tables, marks: Marks) -> tuple[DataFrame, DataFrame]:
    """Orders whose sales, and orders whose returns, may read otherwise since the last build or repair.

    Sales change with an order or a line, returns with the return event, its order or the order's customer.
    """
    new = {entity: _new(tables, entity, marks.seen.get(entity)) for entity in MARKED}
    customers = stage(new["customers"].select("customer_id").distinct(), "new_customers")
    of_customers = tables.read("clean_orders").join(customers, "customer_id", "left_semi")
    return _ids(new["orders"], new["transactions"]), _ids(new["orders"], new["returns"], of_customers)


def note(tables: Tables, orders: DataFrame) -> DataFrame:
    """Write down the orders of this run, with those of runs that broke off, before anything is changed."""
    before = tables.read(PENDING)
    tables.replace(PENDING, _ids(orders) if before is None else _ids(orders, before))
    return tables.read(PENDING)


def forget(tables: Tables) -> None:
    tables.drop(PENDING)


def of_orders(rows: DataFrame, orders: DataFrame) -> DataFrame:
    """The rows of some orders; the ids are broadcast if they are few, else both sides meet by id."""
    return rows.join(orders, KEY, "left_semi")


def many(orders: DataFrame) -> bool:
    """Whether orders fill a part: facts of few are brought together, lest they be a small file for each task and part."""
    return orders.count() >= PART_ROWS


def changed_parts(keys: DataFrame, key: str, parts: int) -> list[str]:
    """At most as many names as there are parts."""
    return [r[0] for r in keys.select(part_of(F.col(key), parts)).distinct().collect()]


def _dimensions(whole: Mart) -> dict[str, DataFrame]:
    return {name: getattr(whole, name) for name, _ in DIMENSION_KEYS}


def missing_sales(tables: Tables, whole: Mart, orders: DataFrame, marks: Marks) -> DataFrame:
    """The sales of some orders that the stored facts lack, each as often as it is missing.

    ``whole`` has clean tables and dimensions. Surrogate keys are left out of the comparison, as a dimension may have
    grown since; ``marked_sales`` adds flags for them.
    """
    chosen = {f"clean_{e}": of_orders(whole.clean(e), orders) for e in ("orders", "transactions")}
    own = list(facts.OWN_SALES)
    stored = of_orders(tables.read("fact_sales", changed_parts(orders, KEY, marks.parts)), orders)
    now = facts.own_sales(chosen["clean_orders"], chosen["clean_transactions"])
    return _lacking(now.select(*own), stored.select(*own))


def _lacking(now: DataFrame, stored: DataFrame) -> DataFrame:
    """What ``exceptAll`` gives; rows are counted and compared where their orders lie, not shuffled once more."""
    has = now.groupBy(*now.columns).agg(F.count("*").alias("_has"))
    had = stored.groupBy(*stored.columns).agg(F.count("*").alias("_had")).select(
        *[F.col(c).alias(f"_{c}") for c in stored.columns], F.col("_had")
    )
    same = [F.col(c) == F.col(f"_{c}") if c == KEY else F.col(c).eqNullSafe(F.col(f"_{c}")) for c in now.columns]
    times = (F.col("_has") - F.coalesce("_had", F.lit(0))).alias("_times")
    rows = has.join(had, reduce(lambda a, b: a & b, same), "left").select(*now.columns, times).where("_times > 0")
    return rows.withColumn("_times", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_times")))).drop("_times")


def marked_sales(whole: Mart, own: DataFrame) -> DataFrame:
    """Sales without surrogate keys, written down, and then with flags for them."""
    rows = stage(own, "own_sales")
    mark = marking(whole, rows, rows)
    for _, name in DIMENSION_KEYS:
        rows = mark(rows, name)
    return facts.dated(rows).select(*facts.slim_names(facts.FACT_SALES))


def new_sales(whole: Mart, orders: DataFrame) -> DataFrame:
    """The sales of orders that none were written for."""
    return marked_sales(whole, facts.own_sales(stage(orders, "new_orders"), whole.clean("transactions")))


def new_returns(whole: Mart, returns: DataFrame) -> DataFrame:
    returns = stage(returns, "new_returns")
    orders = stage(of_orders(whole.clean("orders"), returns.select(KEY)), "returned_orders")
    return facts.slim_returns(returns, orders, marking(whole, orders))


def marking(whole: Mart, orders: DataFrame, lines: DataFrame | None = None) -> facts.Mark:
    """Flags by the keys that the dimensions lack, which are written down; without lines for customers only."""
    rows = {"customer": orders}
    if lines is not None:
        rows |= {"product": lines, "vendor": orders.select("vendor_id").unionByName(lines.select("vendor_id"))}
    dimensions = {name: getattr(whole, dimension) for dimension, name in DIMENSION_KEYS}
    return facts.known_but(stage_all({n: facts.unknown(rows[n], dimensions[n], f"{n}_id") for n in rows}))


def _renew(
    tables: Tables, name: str, orders: DataFrame, fresh: DataFrame, marks: Marks, changed: list[str], slim: Finish, finish: Finish
) -> None:
    """Rows of some orders anew, the other rows of their parts as they are."""
    kept = slim(tables.read(name, changed)).join(orders, KEY, "left_anti")
    rows = kept.select(*fresh.columns).unionByName(fresh)
    tables.replace_parts(name, rows, KEY, marks.parts, changed, finish)


def renew_returns(tables: Tables, whole: Mart, orders: DataFrame, marks: Marks) -> None:
    changed = changed_parts(orders, KEY, marks.parts)
    if changed:
        chosen = {e: of_orders(whole.clean(e), orders) for e in ("orders", "returns")}
        fresh = facts.slim_returns(chosen["returns"], chosen["orders"], marking(whole, whole.clean("orders")))
        _renew(tables, "fact_returns", orders, fresh, marks, changed, facts.slim, facts.with_keys)


def renew_bridge(tables: Tables, whole: Mart, orders: DataFrame, marks: Marks) -> None:
    changed = changed_parts(orders, KEY, marks.parts)
    if changed:
        chosen = {name: of_orders(tables.read(name, changed), orders) for name in ("fact_sales", "fact_returns")}
        fresh = Mart(stored=chosen | _dimensions(whole)).slim_bridge()
        name = "bridge_return_products"
        if of_orders(tables.read(name, changed).select(KEY), orders).isEmpty():  # nothing is to go
            tables.append_parts(name, fresh, KEY, marks.parts, facts.bridge_keys, many(orders))
            return
        _renew(tables, name, orders, fresh, marks, changed, facts.slim_bridge_rows, facts.bridge_keys)
