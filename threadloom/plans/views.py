"""The message view that queries share, as a DataFrame and as SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.functions import text as T
from threadloom.functions.ids import identifier, parent_identifier
from threadloom.operators import delivery
from threadloom.operators.instants import number_to_us
from threadloom.plans.core import _SQL_TRIM, sql_id

COLUMNS = ["row_id", "msg_id", "parent_id", "group_id", "thread_id", "task_id", "role", "who", "name", "kind", "text", "ts"]


def _normalised(name: str) -> Column:
    """A column of the view, under its own name."""
    made = {"id": (identifier, "msg_id"), "parent": (parent_identifier, "parent_id"), "role": (T.role, "role"), "ts_us": (number_to_us, "ts")}
    if name not in made:
        return F.col(name)
    change, source = made[name]
    return change(F.col(source)).alias(name)


_ALL = ("id", "parent", "row_id", "group_id", "thread_id", "task_id", "role", "who", "name", "kind", "text", "ts_us")


def messages(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """One row per identifier, its first delivery, with normalised columns.

    Named narrow columns are taken by one aggregation; with texts the wide rows
    stay where they are and deletion vectors take the later deliveries away.
    """
    if columns and "text" not in columns:
        wanted = [c for c in dict.fromkeys(columns) if c not in ("id", "row_id")]
        rows = spark.read.parquet(f"{sf_dir}/chat_events.parquet").select(_normalised("id"), F.struct("row_id", *map(_normalised, wanted)).alias("r"))
        return rows.where("id is not null").groupBy("id").agg(F.min("r").alias("r")).select("id", "r.*")
    rows = delivery.mark_deliveries(spark, f"{sf_dir}/chat_events.parquet", COLUMNS).where("__keep and __has_id")
    rows = rows.select(*map(_normalised, _ALL))
    return rows.select(*dict.fromkeys(("id", *columns))) if columns else rows


def threaded(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Messages with a time, under the thread they belong to (else their group).

    ``columns`` are those wanted besides id, thread, ts_us and row_id; all
    unless named.
    """
    names = ("id", "row_id", "ts_us", "thread_id", "group_id", *columns) if columns else ()
    rows = messages(spark, sf_dir, *names).where("ts_us is not null").withColumn("thread", F.coalesce("thread_id", "group_id"))
    return rows.select(*dict.fromkeys(("id", "thread", "ts_us", "row_id", *columns))) if columns else rows


SQL_MESSAGES = f"""
    m AS (
      SELECT id, parent, row_id, group_id, thread_id, task_id, role, who, name, kind, text,
        CASE WHEN us >= 1577836800000000 AND us < 1893456000000000 THEN us END AS ts_us
      FROM (
        SELECT id, nullif(up, '0') AS parent, row_id, group_id, thread_id, task_id, rl AS role, who, name, kind, text,
          CASE WHEN ts > 0 AND NOT isnan(ts) THEN CAST(floor(CASE WHEN ts < 1e11 THEN ts * 1000 WHEN ts < 1e14 THEN ts WHEN ts < 1e17 THEN ts / 1e3 ELSE ts / 1e6 END + 0.5) AS BIGINT) * 1000 END AS us,
          row_number() OVER (PARTITION BY id ORDER BY row_id) AS rn
        FROM (SELECT *, {sql_id('msg_id')} AS id, {sql_id('parent_id')} AS up, lower({_SQL_TRIM.format('role')}) AS rl FROM chat_events) x WHERE id IS NOT NULL
      ) y WHERE rn = 1
    ), t AS (SELECT *, coalesce(thread_id, group_id) AS thread FROM m WHERE ts_us IS NOT NULL)
"""
SQL_BOT = "coalesce(role IN ('bot', 'assistant', 'agent'), false)"
SQL_USER = "coalesce(role IN ('user', 'human'), false)"
