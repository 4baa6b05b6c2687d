"""Clicks of products with their status (the status field is declared in the reference, no code reads it)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def product_status(products: DataFrame) -> DataFrame:
    """(product_id, product_name, product_status): the status read from the JSON text, null when it has none."""
    status = F.get_json_object("extend_info", "$.product_status").try_cast("int")
    return products.select("product_id", "product_name", status.alias("product_status"))


def product_clicks(actions: DataFrame, products: DataFrame, status: int | None = None) -> DataFrame:
    """(product_id, product_name, product_status, clicks) of the clicked products, of one status if given.

    Clicks are counted before the join, so a product that holds most of them is
    one row there, and the status is tested on the product table alone, below
    the join. Clicks of unknown products are dropped; a product that is stored
    twice has two rows.
    """
    known = product_status(products)
    if status is not None:
        known = known.where(F.col("product_status") == int(status))
    clicks = (actions.where("click_product_id IS NOT NULL").groupBy(F.col("click_product_id").alias("product_id"))
              .agg(F.count(F.lit(1)).alias("clicks")))
    return known.join(clicks, "product_id").select("product_id", "product_name", "product_status", "clicks")
