"""Named queries over the standard tables, each with its DuckDB counterpart where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]


def review_latest_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest event of each user decides its gate; users are counted by gate."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    latest = events.groupBy("user_id").agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("action"))
    gate = F.when(F.col("action") == "purchase", "ready").when(F.col("action") == "signup", "reset_pending").otherwise("blocked")
    return latest.groupBy(gate.alias("gate")).agg(F.count(F.lit(1)).alias("n"))


REVIEW_LATEST_GATE = """
SELECT CASE action WHEN 'purchase' THEN 'ready' WHEN 'signup' THEN 'reset_pending' ELSE 'blocked' END AS gate,
       count(*) AS n
FROM (SELECT user_id, arg_max(event_type, (ts, event_id)) AS action FROM events GROUP BY user_id)
GROUP BY 1
"""


def _plans() -> dict[str, tuple[Query, str | None]]:
    from .plans import bank, candidates, catalog, pages, reviews

    found: dict[str, tuple[Query, str | None]] = {"review_latest_gate": (review_latest_gate, REVIEW_LATEST_GATE)}
    for module in (reviews, catalog, candidates, pages, bank):
        found.update(module.QUERIES)
    return found


def queries() -> dict[str, Query]:
    return {name: query for name, (query, _) in _plans().items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in _plans().items() if sql}
