"""The action table as a stored catalog table: partitioned by date, bucketed by session.

A date window is a partition filter, so files of other days are not opened, and
the buckets already bring the rows of a session together, so the roll-up needs
no exchange on the session id.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import CatalogSource

BUCKETS = 8


def store_actions(actions: DataFrame, table: str, path: str, buckets: int = BUCKETS) -> None:
    """Write `actions` once as catalog table `table` under `path`, unless the catalog has it.

    Rows are shuffled by day and bucket, so every day has one file a bucket,
    written by one task, and a session that spans many days is written by many.
    """
    spark = actions.sparkSession
    if spark.catalog.tableExists(table):
        return
    bucket = F.expr(f"pmod(hash(session_id), {int(buckets)})")
    (actions.repartition("date", bucket).write.partitionBy("date").bucketBy(buckets, "session_id").sortBy("session_id")
     .option("path", path).mode("overwrite").saveAsTable(table))


@dataclass
class StoredSource(CatalogSource):
    """Actions from a stored catalog table, profiles from a DataFrame."""

    user_rows: DataFrame | None = None

    def users(self) -> DataFrame:
        return super().users() if self.user_rows is None else self.user_rows


def stored_source(spark: SparkSession, actions: DataFrame, users: DataFrame, table: str, path: str,
                  buckets: int = BUCKETS) -> StoredSource:
    store_actions(actions, table, path, buckets)
    return StoredSource(spark, actions_table=table, user_rows=users)
