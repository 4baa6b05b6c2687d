"""Small fixture tables in the shape of the reference's tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Row

from visitscope.schemas import USER_INFO, USER_VISIT_ACTION_TEXT
from visitscope.sources.tables import FrameSource

DAY = "2018-04-09"


def action(session_id, user_id, time, keyword=None, category=None, date=DAY, page=1):
    return Row(date=date, user_id=user_id, session_id=session_id, page_id=page,
               action_time=time, search_keyword=keyword, click_category_id=category,
               click_product_id=None, order_category_ids=None, order_product_ids=None,
               pay_category_ids=None, pay_product_ids=None, city_id=1)


def user(user_id, age=30, professional="p1", city="c1", sex="male"):
    return Row(user_id=user_id, username=f"user{user_id}", name=f"name{user_id}", age=age,
               professional=professional, city=city, sex=sex)


def at(seconds: int) -> str:
    t = dt.datetime(2018, 4, 9) + dt.timedelta(seconds=seconds)
    return f"{t:%Y-%m-%d} {t.hour}:{t:%M:%S}"


def source(spark, actions, users, partitions=None):
    a = spark.createDataFrame(actions, USER_VISIT_ACTION_TEXT)
    if partitions:
        a = a.repartition(partitions)
    u = spark.createDataFrame(users, USER_INFO)
    return FrameSource(a, u)


def stats_dict(df):
    return {r["metric"]: r["cnt"] for r in df.collect()}
