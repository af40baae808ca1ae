"""Queries over the core operators, and the SQL each is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.operators import delivery, forest, instants, shredding
from threadloom.session import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql is not None:
            ORACLE[name] = sql
        return f

    return add


# Trims Unicode white space, as functions.ids does.
_SQL_TRIM = r"regexp_replace({0}, '^[\s\x0B\x1C-\x1F\x{{85}}\p{{Z}}]+|[\s\x0B\x1C-\x1F\x{{85}}\p{{Z}}]+$', '', 'g')"


def sql_id(col: str) -> str:
    return f"nullif(lower({_SQL_TRIM.format(col)}), '')"


@query(
    "p1_found",
    f"""
    SELECT row_id FROM (
      SELECT row_id, row_number() OVER (PARTITION BY id ORDER BY row_id) AS rn
      FROM (SELECT row_id, {sql_id('msg_id')} AS id FROM chat_events) x WHERE id IS NOT NULL
    ) y WHERE rn > 1
    """,
)
def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivery.repeated_deliveries(spark, f"{sf_dir}/chat_events.parquet")


@query(
    "p1_kept",
    f"""
    SELECT row_id, batch_id, group_id, msg_id, role, text FROM (
      SELECT *, row_number() OVER (PARTITION BY id ORDER BY row_id) AS rn
      FROM (SELECT *, {sql_id('msg_id')} AS id FROM chat_events) x
    ) y WHERE id IS NULL OR rn = 1
    """,
)
def p1_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = delivery.keep_first_delivery(spark, f"{sf_dir}/chat_events.parquet")
    return kept.select("row_id", "batch_id", "group_id", "msg_id", "role", "text")


@query("p2_found")
def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return instants.instants(table(spark, sf_dir, "chat_events"), table(spark, sf_dir, "chat_groups"))


_SQL_FOREST = f"""
    WITH RECURSIVE m AS (
      SELECT id, parent, row_id FROM (
        SELECT id, parent, row_id, row_number() OVER (PARTITION BY id ORDER BY row_id) AS rn FROM (
          SELECT {sql_id('msg_id')} AS id, nullif({sql_id('parent_id')}, '0') AS parent, row_id FROM chat_events
        ) x WHERE id IS NOT NULL
      ) y WHERE rn = 1
    ), up AS (
      SELECT id, id AS root_id, 0 AS depth FROM m WHERE parent IS NULL OR parent NOT IN (SELECT id FROM m)
      UNION ALL
      SELECT m.id, up.root_id, up.depth + 1 FROM m JOIN up ON m.parent = up.id
    )
"""


@query(
    "p5_found",
    _SQL_FOREST
    + """
    SELECT m.id AS msg_id, coalesce(up.root_id, 'cycle') AS root_id, coalesce(up.depth, -1) AS depth
    FROM m LEFT JOIN up ON m.id = up.id
    """,
)
def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.hierarchy(table(spark, sf_dir, "chat_events"))


_SQL_PATHS = _SQL_FOREST.replace("id AS root_id, 0 AS depth", "id AS root_id, 0 AS depth, [id] AS path").replace("up.depth + 1", "up.depth + 1, list_append(up.path, m.id)")


@query(
    "p5_paths",
    _SQL_PATHS + " SELECT m.id AS msg_id, coalesce(up.root_id, 'cycle') AS root_id, coalesce(up.depth, -1) AS depth, array_to_string(path, '/') AS path FROM m LEFT JOIN up ON m.id = up.id",
)
def p5_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.paths(table(spark, sf_dir, "chat_events")).withColumn("path", F.array_join("path", "/"))


@query(
    "p5_descendants",
    _SQL_PATHS
    + """, c AS (SELECT id, count(*) AS n FROM (SELECT unnest(path) AS id FROM up) x GROUP BY 1), f AS (SELECT id, root_id, row_number() OVER (PARTITION BY root_id ORDER BY path) AS first FROM up)
    SELECT m.id AS msg_id, coalesce(f.root_id, 'cycle') AS root_id, f.first, f.first + c.n - 1 AS last FROM m LEFT JOIN f ON f.id = m.id LEFT JOIN c ON c.id = m.id""",
)
def p5_descendants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.descendants(table(spark, sf_dir, "chat_events"))


_SQL_TREE = """
    WITH RECURSIVE items AS (
      SELECT DISTINCT concat_ws('/', coalesce(thread_id, ''), coalesce(turn_id, ''), coalesce(item_id, '')) AS owner_key, item_json FROM thread_items WHERE json_valid(item_json)
    ), whole AS (
      SELECT owner_key, CASE WHEN json_type(item_json) <> 'VARCHAR' THEN CAST(item_json AS JSON) WHEN json_valid(item_json ->> '$') THEN CAST(item_json ->> '$' AS JSON) END AS v FROM items
    ), node AS (
      SELECT 'thread_items' AS table_name, owner_key, '' AS path, '$' AS parent, v, CAST(NULL AS VARCHAR) AS child_path, CAST(NULL AS VARCHAR) AS parent_path FROM whole WHERE json_type(v) IN ('OBJECT', 'ARRAY')
      UNION ALL
      SELECT 'trajectory', trace_id, '', '$', to_json({'steps': steps, 'messages': messages}), NULL, NULL FROM trajectory
      UNION ALL
      SELECT table_name, owner_key, path, CASE WHEN here THEN path ELSE parent END, v, CASE WHEN here THEN path END, CASE WHEN here THEN parent END FROM (
        SELECT n.table_name, n.owner_key, n.parent, json_type(n.v) = 'ARRAY' AND e.type = 'OBJECT' AS here,
          CASE WHEN json_type(n.v) = 'ARRAY' THEN n.path || '[' || e.key || ']' WHEN n.path = '' THEN e.key ELSE n.path || '.' || e.key END AS path,
          CASE WHEN e.type = 'VARCHAR' AND json_type(n.v) = 'OBJECT' AND e.key IN ('arguments', 'args', 'tool_inputs', 'tool_outputs', 'output_messages') AND left(e.value ->> '$', 1) IN ('[', '{') AND json_valid(e.value ->> '$')
            THEN CAST(e.value ->> '$' AS JSON) ELSE CAST(e.value AS JSON) END AS v
        FROM (SELECT * FROM node WHERE json_type(v) IN ('OBJECT', 'ARRAY')) n, json_each(n.v) e
      ) k
    )
"""


@query("p3_found", _SQL_TREE + "SELECT table_name, owner_key, child_path, parent_path FROM node WHERE child_path IS NOT NULL")
def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = shredding.nested_objects(table(spark, sf_dir, "thread_items"), table(spark, sf_dir, "trajectory"))
    return rows.select("table_name", "owner_key", "child_path", "parent_path")


@query("p3_tables")
def p3_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flat tables: every record and every object in an array with its plain members, and every plain value in an array."""
    rows = shredding.nested_objects(table(spark, sf_dir, "thread_items"), table(spark, sf_dir, "trajectory"), leaves=True)
    return rows.withColumn("members", F.to_json("members"))
