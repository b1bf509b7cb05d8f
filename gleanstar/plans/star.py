"""The star schema from clean tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanstar.functions import measures as m
from gleanstar.operators import serve as g
from gleanstar.sources.tables import Warehouse

Save = Callable[[str, DataFrame], DataFrame]


# Each dimension from the clean tables it needs, and no others.
DIMENSIONS: dict[str, Callable[[Mapping[str, DataFrame]], DataFrame]] = {
    "dim_date": lambda c: g.dim_date(c["orders"]),
    "dim_product": lambda c: g.dim_product(c["products"], c["category_translation"]),
    "dim_seller": lambda c: g.dim_seller(c["sellers"], c["order_items"], c["orders"]),
    "dim_customer": lambda c: g.dim_customer(c["customers"], c["orders"], c["order_items"], c["products"]),
    "data_quality_flags": lambda c: g.data_quality_flags(c["order_items"], c["orders"]),
}


def build_dimensions(clean: Mapping[str, DataFrame], save: Save) -> dict[str, DataFrame]:
    """Each dimension is stored before the fact needs it, so its plan stays its own and
    the fact's joins are planned by the stored sizes."""
    return {name: save(name, build(clean)) for name, build in DIMENSIONS.items()}


def build_fact(
    clean: Mapping[str, DataFrame],
    dims: Mapping[str, DataFrame],
    order_by: Sequence[str] = ("order_id", "order_item_id"),
    customer_keys: DataFrame | None = None,
) -> DataFrame:
    return g.fact_order_item(
        clean["order_items"],
        clean["orders"],
        clean["order_reviews"],
        clean["customers"],
        dims["dim_customer"],
        dims["dim_seller"],
        dims["dim_product"],
        dims["dim_date"],
        dims["data_quality_flags"],
        order_by=order_by,
        customer_keys=customer_keys,
    )


# Clean tables that meet by order.
BY_ORDER = ("orders", "order_items", "order_reviews", "order_payments")


def bucketed_save(store: Warehouse, layer: str, buckets: int) -> Save:
    """`save` for `clean_all` that stores the tables which meet by order in the same number of
    buckets of it. The store must be one of databases."""
    return lambda name, df: store.save(layer, name, df, bucket_by="order_id" if name in BY_ORDER else None, buckets=buckets)


def build_bucketed_star(
    clean: Mapping[str, DataFrame], store: Warehouse, buckets: int, order_by: Sequence[str] = ("order_id", "order_item_id")
) -> dict[str, DataFrame]:
    """As `build_star`, over clean tables that `bucketed_save` has stored: the customer of each
    order is stored by order as well, and the fact's order-grain joins need no exchange."""
    dims = build_dimensions(clean, lambda name, df: store.save("serving", name, df))
    keys = g.order_customers(clean["orders"], clean["customers"], dims["dim_customer"])
    keys = store.save("serving", "order_customers", keys, bucket_by="order_id", buckets=buckets)
    fact = store.save("serving", "fact_order_item_fulfillment", build_fact(clean, dims, order_by, keys))
    return {**dims, "fact_order_item_fulfillment": fact}


def build_star(
    clean: Mapping[str, DataFrame], save: Save, order_by: Sequence[str] = ("order_id", "order_item_id")
) -> dict[str, DataFrame]:
    dims = build_dimensions(clean, save)
    fact = save("fact_order_item_fulfillment", build_fact(clean, dims, order_by))
    return {**dims, "fact_order_item_fulfillment": fact}


def fulfilment_summary(fact: DataFrame, flags: DataFrame) -> DataFrame:
    """Items, punctuality and value per combination of quality flags."""
    by_key = fact.groupBy("data_quality_key").agg(
        m.rows().alias("items"),
        F.count_if("is_delivered_on_time").alias("on_time"),
        F.count_if(~F.col("is_delivered_on_time")).alias("late"),
        F.count_if("has_fulfillment_anomaly").alias("anomalies"),
        F.round(F.sum("price"), 2).alias("total_price"),
    )
    # At most 3**6 rows.
    return by_key.join(F.broadcast(flags), "data_quality_key", "left").withColumn(
        "on_time_pct", m.percent(F.col("on_time"), F.col("on_time") + F.col("late"))
    )
