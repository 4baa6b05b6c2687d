"""Click, order and pay counts per category (declared in the reference without code).

One scan: every action becomes one row for each kind of category text it
carries, the comma lists are cut, and the three counts are taken in one
aggregate. Partial counts run before the shuffle, so a category that holds most
of the actions sends one row a task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def category_counts(actions: DataFrame) -> DataFrame:
    """(category_id, click_count, order_count, pay_count) of every category that is clicked, ordered or paid.

    A category has a row as soon as one of the three names it, with 0 for the
    others. A list counts an id as often as it holds it; entries that are no
    number (empty ones too) name no category.
    """
    kinds = ("'click', CAST(click_category_id AS STRING), 'order', order_category_ids, 'pay', pay_category_ids")
    lists = actions.selectExpr(f"stack(3, {kinds}) AS (kind, ids)").where("ids IS NOT NULL")
    listed = lists.select("kind", F.explode(F.split("ids", ",")).alias("id")).selectExpr("kind", "try_cast(id AS BIGINT) AS category_id")
    return (listed.where("category_id IS NOT NULL").groupBy("category_id")
            .agg(*(F.expr(f"count_if(kind = '{k}') AS {k}_count") for k in ("click", "order", "pay"))))
