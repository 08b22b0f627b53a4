"""How the standard tables play the question bank's parts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Event types as review actions.
ACTIONS = {"purchase": "accept", "click": "reviewed", "view": "comment", "error": "block", "signup": "reset_review"}


def review_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """candidate_key, action, created_at, id, k (payload number), has_correction, correction (null: empty)."""
    e = table(spark, sf_dir, "events")
    action = F.lit(None)
    for kind, name in ACTIONS.items():
        action = F.when(F.col("event_type") == kind, name).otherwise(action)
    k = F.get_json_object("props", "$.k").try_cast("int")
    return e.select(
        F.col("user_id").alias("candidate_key"), action.alias("action"), F.col("ts").alias("created_at"), F.col("event_id").alias("id"), "value",
        k.alias("k"), F.coalesce(k >= 50, F.lit(False)).alias("has_correction"), F.when(k % 7 != 0, k).alias("correction"),
    )


#: The same in SQL, as a CTE named review.
REVIEW_SQL = """review AS (
  SELECT user_id AS candidate_key, CASE event_type WHEN 'purchase' THEN 'accept' WHEN 'click' THEN 'reviewed' WHEN 'view' THEN 'comment'
    WHEN 'error' THEN 'block' WHEN 'signup' THEN 'reset_review' END AS action, ts AS created_at, event_id AS id, value,
    k, coalesce(k >= 50, false) AS has_correction, CASE WHEN k % 7 <> 0 THEN k END AS correction
  FROM (SELECT *, try_cast(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events))"""
