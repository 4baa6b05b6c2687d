"""Action rows of passing sessions (announced in the reference's comments without code)."""

from __future__ import annotations

from pyspark.sql import DataFrame


def detail_rows(actions: DataFrame, passing: DataFrame) -> DataFrame:
    """The action rows whose session is in `passing`, each once however often the session is.

    A semi-join on the session id. A small set of sessions is broadcast (by its
    measured size); for a larger one Spark builds a Bloom filter of its ids and
    applies it to the scan of the actions before they are shuffled
    (`spark.sql.optimizer.runtime.bloomFilter`), and the skew join splits the
    rows of a session that holds very many.
    """
    return actions.join(passing.select("session_id"), "session_id", "left_semi").select(*actions.columns)
