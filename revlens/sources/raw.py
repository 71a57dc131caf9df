"""The four raw source tables the warehouse is built from."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

RAW_NAMES = ("users", "orders", "order_items", "products")

# Columns the warehouse reads from each raw table (everything else is pruned).
RAW_COLUMNS = {
    "users": (
        "id",
        "first_name",
        "last_name",
        "email",
        "age",
        "gender",
        "country",
        "city",
        "traffic_source",
        "created_at",
    ),
    "orders": (
        "order_id",
        "user_id",
        "status",
        "created_at",
        "shipped_at",
        "delivered_at",
        "num_of_item",
    ),
    "order_items": ("id", "order_id", "user_id", "product_id", "sale_price", "status", "created_at"),
    "products": ("id", "cost", "category", "brand"),
}


@dataclass(frozen=True)
class RawTables:
    users: DataFrame
    orders: DataFrame
    order_items: DataFrame
    products: DataFrame


def read_raw(
    spark: SparkSession,
    root: str,
    fmt: str = "parquet",
    options: dict[str, str] | None = None,
    schemas: dict[str, str] | None = None,
) -> RawTables:
    """Read ``<root>/<name>`` for the four raw tables (any format Spark reads).

    ``options`` go to every reader (e.g. ``{"header": "true"}`` for CSV);
    ``schemas`` maps a table name to a DDL schema for formats that carry
    none, so timestamps and ids arrive typed instead of inferred.
    """
    frames = {}
    for name in RAW_NAMES:
        reader = spark.read.format(fmt).options(**(options or {}))
        if schemas and name in schemas:
            reader = reader.schema(schemas[name])
        frames[name] = reader.load(f"{root}/{name}").select(*RAW_COLUMNS[name])
    return RawTables(**frames)
