"""The session tables as views over the generated test tables.

The test tables carry no session ids, keywords or profiles, so they are
derived (the same expressions are used by the SQL oracle):

* `user_visit_action` from `events`; a session is a time grain chosen by
  `user_id % 5` (day, quarter day, hour, ten minutes), so sessions mix users;
* `user_info` from `customer` joined to `nation`;
* `task` from `customer` joined to `nation`: one stored analysis per
  customer, asking for sessions of users like that customer;
* `product_info` from `part`.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.sample import least_rows
from .tables import date_range


# The columns of the generated tables that the views use. Stated here, so that a
# read starts no job to infer them and always sees the files as they are.
SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, props string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string",
    "part": "p_partkey bigint, p_name string, p_size int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int",
    "lineitem": "l_orderkey bigint, l_linenumber int, l_extendedprice double, l_discount double, l_tax double",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One generated table, e.g. `lineitem`, from `sf_dir`."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# The derived columns, as SQL expressions over `events` (`t` is the action
# time cut to whole seconds, `k` the number in `props`); one JVM call per
# column keeps plan construction cheap.
_ACTION_COLUMNS = [
    "to_date(t) AS date",
    "user_id",
    "concat(CAST(user_id % 5 AS STRING), '_', CASE user_id % 5"
    " WHEN 0 THEN date_format(t, 'yyyyMMdd')"
    " WHEN 1 THEN concat(date_format(t, 'yyyyMMdd'), 'q', CAST(floor(hour(t) / 6) AS STRING))"
    " WHEN 2 THEN date_format(t, 'yyyyMMddHH')"
    " ELSE CAST(floor(unix_timestamp(t) / 600) AS STRING) END) AS session_id",
    "event_id % 10 AS page_id",
    "t AS action_time",
    "CASE WHEN event_type = 'view' THEN concat('kw', CAST(k % 10 AS STRING)) END AS search_keyword",
    "CASE WHEN event_type = 'click' THEN k END AS click_category_id",
    "CASE WHEN event_type = 'click' THEN event_id % 100 END AS click_product_id",
    "CASE WHEN event_type = 'signup' THEN CAST(k AS STRING) END AS order_category_ids",
    "CASE WHEN event_type = 'signup' THEN CAST(event_id % 100 AS STRING) END AS order_product_ids",
    "CASE WHEN event_type = 'purchase' THEN CAST(k AS STRING) END AS pay_category_ids",
    "CASE WHEN event_type = 'purchase' THEN CAST(event_id % 100 AS STRING) END AS pay_product_ids",
    "user_id % 10 AS city_id",
]


# As above, with lists of several ids: a neighbouring id, an id twice, an empty entry.
_ORDER_LIST = "CASE WHEN event_type = 'signup' THEN concat_ws(',', k, (k + 7) % 100, CASE WHEN k % 3 = 0 THEN k END) END AS order_category_ids"
_PAY_LIST = "CASE WHEN event_type = 'purchase' THEN concat(k, ',', (k * 3) % 120, CASE WHEN k % 4 = 0 THEN ',' ELSE '' END) END AS pay_category_ids"


def basket_actions(events: DataFrame) -> DataFrame:
    """(click_category_id, order_category_ids, pay_category_ids) of `events`, the lists with several ids."""
    return events.selectExpr("event_type", "try_cast(get_json_object(props, '$.k') AS BIGINT) AS k").selectExpr(
        "CASE WHEN event_type = 'click' THEN k END AS click_category_id", _ORDER_LIST, _PAY_LIST)


# One call into the JVM per column here, too.
_START_DAY = "date_add(DATE'2024-01-01', CAST(c_custkey % 21 AS INT))"
_AGE = "CAST(c_custkey % 60 AS INT)"
_TASK_KEYWORDS = ", ".join(f"concat('kw', CAST((c_custkey + {step}) % 10 AS STRING))" for step in (0, 3, 6))
_TASK_CATEGORIES = ", ".join(f"CAST((c_nationkey + {step}) % 100 AS STRING)" for step in range(0, 100, 10))
_TASK_COLUMNS = [
    "c_custkey AS task_id",
    "concat('sessions like ', c_name) AS task_name",
    "'2024-01-01 00:00:00' AS create_time",
    "CAST(NULL AS STRING) AS start_time",
    "CAST(NULL AS STRING) AS finish_time",
    "'session' AS task_type",
    "'created' AS task_status",
    f"""to_json(struct(
        array(date_format({_START_DAY}, 'yyyy-MM-dd')) AS startDate,
        array(date_format(date_add({_START_DAY}, 6), 'yyyy-MM-dd')) AS endDate,
        array(CAST(greatest({_AGE} - 15, 0) AS STRING)) AS startAge,
        CASE WHEN c_acctbal >= 0 THEN array(CAST({_AGE} + 15 AS STRING)) END AS endAge,
        array(c_mktsegment) AS professionals,
        CASE WHEN c_acctbal > 5000 THEN array(n_name) END AS cities,
        array(CASE WHEN c_mktsegment = 'MACHINERY' THEN '' WHEN c_custkey % 2 = 0 THEN 'male' ELSE 'female' END) AS sex,
        CASE WHEN c_mktsegment != 'AUTOMOBILE' THEN array(concat_ws(',', {_TASK_KEYWORDS})) END AS keywords,
        CASE WHEN c_mktsegment != 'BUILDING' THEN array(concat_ws(',', {_TASK_CATEGORIES})) END AS categoryIds
    )) AS task_param""",
]


def actions_from_events(events: DataFrame, with_id: bool = False) -> DataFrame:
    """`user_visit_action` rows from `events` rows (columns as the typed schema), with the event's id if asked for.

    A session is a time grain chosen by `user_id % 5`: the day, a quarter
    of the day, the hour, or ten minutes.
    """
    return events.selectExpr(
        "event_id", "user_id", "event_type",
        "date_trunc('second', ts) AS t",
        "try_cast(get_json_object(props, '$.k') AS BIGINT) AS k",
    ).selectExpr(*_ACTION_COLUMNS, *(["event_id"] if with_id else []))


def _customer_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey",
                                                        "c_acctbal", "c_mktsegment")
    nation = read_table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    # `nation` holds 25 rows by construction; the planner broadcasts it from
    # its measured file size, no hint needed.
    return customer.join(nation, "c_nationkey", "inner")


@dataclass
class GeneratedSource:
    """Session tables derived from the generated tables in `sf_dir`."""

    spark: SparkSession
    sf_dir: str

    def events(self) -> DataFrame:
        return read_table(self.spark, self.sf_dir, "events")

    def actions(self, start: str | dt.date | None = None,
                end: str | dt.date | None = None) -> DataFrame:
        """Actions of [start, end] (days, inclusive), whole table when both are None.

        The range is applied to the stored `ts` column, so Parquet receives
        `ts >= start AND ts < end + 1 day` as pushed filters.
        """
        ev = self.events().select("event_id", "ts", "user_id", "event_type", "props")
        found = date_range(start, end)
        if found is not None:
            lo, hi = found
            # Bounds from text: a Python datetime literal would be read in the
            # local zone of the Python process and shift the window.
            ev = ev.where(
                f"ts >= CAST('{lo.isoformat()} 00:00:00' AS TIMESTAMP_NTZ) AND "
                f"ts < CAST('{(hi + dt.timedelta(days=1)).isoformat()} 00:00:00' AS TIMESTAMP_NTZ)")
        return actions_from_events(ev)

    def ordered_actions(self) -> DataFrame:
        """All actions with the event's id, which orders actions of one second."""
        return actions_from_events(self.events().select("event_id", "ts", "user_id", "event_type", "props"), with_id=True)

    def earliest_actions(self) -> DataFrame:
        """The actions of the least stored time, fetched by that time."""
        events = self.events().select("event_id", "ts", "user_id", "event_type", "props")
        return actions_from_events(least_rows(events, "ts"))

    def supplier_users(self) -> DataFrame:
        """Profiles of the suppliers: far fewer users than own sessions."""
        supplier = read_table(self.spark, self.sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
        nation = read_table(self.spark, self.sf_dir, "nation").selectExpr("n_nationkey AS s_nationkey", "n_name")
        return supplier.join(nation, "s_nationkey").selectExpr(
            "s_suppkey AS user_id",
            "s_name AS username",
            "s_name AS name",
            "CAST(s_suppkey % 60 AS INT) AS age",
            "'supplier' AS professional",
            "n_name AS city",
            "CASE WHEN s_suppkey % 2 = 0 THEN 'male' ELSE 'female' END AS sex",
        )

    def users(self) -> DataFrame:
        cn = _customer_profile(self.spark, self.sf_dir)
        return cn.selectExpr(
            "c_custkey AS user_id",
            "c_name AS username",
            "c_name AS name",
            "CAST(c_custkey % 60 AS INT) AS age",
            "c_mktsegment AS professional",
            "n_name AS city",
            "CASE WHEN c_custkey % 2 = 0 THEN 'male' ELSE 'female' END AS sex",
        )

    def products(self) -> DataFrame:
        part = read_table(self.spark, self.sf_dir, "part")
        return part.select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.to_json(F.struct((F.col("p_size") % 2).cast("int").alias("product_status")))
            .alias("extend_info"),
        )

    def tasks(self) -> DataFrame:
        """One stored analysis per customer, parameters as JSON arrays of text.

        The customer's own profile picks the filters: a 7-day window, an age
        band of 15 years either side of its age, its segment, its sex, three
        keywords and ten category ids; its nation is asked for only when the
        balance is over 5000. Some fields are left out on purpose (a missing
        field means "no filter"): segment AUTOMOBILE asks for no keywords,
        BUILDING for no categories, a negative balance gives only a start age
        (one-sided, so ignored), and MACHINERY sends an empty sex.
        """
        return _customer_profile(self.spark, self.sf_dir).selectExpr(*_TASK_COLUMNS)
