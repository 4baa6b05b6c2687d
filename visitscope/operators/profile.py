"""Join sessions to user profiles.

Inner equi-join on user id: sessions of unknown users are dropped and a
user listed twice doubles its sessions. No broadcast hint is given: the
planner broadcasts the profile side only when its measured size is under
`spark.sql.adaptive.autoBroadcastJoinThreshold` (AQE decides at runtime
from shuffle statistics) and keeps a sort-merge join beyond it; a user who
owns a large share of sessions is split by AQE's skew-join handling.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import PROFILE_COLUMNS


def profiles(users: DataFrame) -> DataFrame:
    """Only the profile columns the filters and records use (S2 projection)."""
    return users.select(*PROFILE_COLUMNS)


def attach_profile(sessions: DataFrame, users: DataFrame) -> DataFrame:
    """Session rows with age, professional, city and sex appended."""
    return sessions.join(profiles(users), "user_id", "inner")


def match_report(sessions: DataFrame, users: DataFrame) -> DataFrame:
    """How many sessions the profile join keeps and drops, in one row.

    Sessions are counted per owner before the join (a user with a huge
    share of sessions arrives as one row), and users are reduced to
    distinct ids, so a repeated profile row does not inflate the counts.
    """
    per_user = sessions.groupBy("user_id").agg(F.count(F.lit(1)).alias("_n"))
    ids = users.select("user_id").where(F.col("user_id").isNotNull()).distinct() \
        .withColumn("_known", F.lit(True))
    joined = per_user.join(ids, "user_id", "left")
    known = F.col("_known").isNotNull()
    return joined.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("sessions"),
        F.coalesce(F.sum(F.when(known, F.col("_n")).otherwise(0)), F.lit(0)).alias("matched"),
        F.coalesce(F.sum(F.when(~known, F.col("_n")).otherwise(0)), F.lit(0)).alias("dropped"),
    )
