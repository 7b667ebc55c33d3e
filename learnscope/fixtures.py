"""Fixture views over the driver tables, one SQL text for Spark and DuckDB.

The original analysis reads tutoring logs; the test tables are generic
(``events``, ``documents``, ``nation``, ``embeddings``). These views map them
onto the domain schema (turns, class windows, class schedule, clustered
sessions, dirty features). ``{TS}`` is ``TIMESTAMP_NTZ`` in Spark and
``TIMESTAMP`` in DuckDB. Each event takes document ``event_id mod n`` (a hole in
the ids leaves an empty text, no turn is lost) and texts are whole: a question
is the full document text plus a Chinese fragment chosen by ``event_id``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

TURNS = """
SELECT e.event_id AS turn_id, e.user_id AS student_id, e.user_id % 30 AS class_id, e.ts AS asked_at,
  CASE e.event_type WHEN 'click' THEN '课堂不懂' WHEN 'view' THEN '课堂不懂' WHEN 'error' THEN '习题不懂' ELSE '自由提问' END AS entry,
  concat(coalesce(d.text, ''), ' ',
    CASE e.event_id % 11 WHEN 0 THEN '这道题怎么做？答案是什么' WHEN 1 THEN '![img](http://x/y.png)' WHEN 2 THEN '<img src="a.png"> 选什么'
      WHEN 3 THEN '如果温度升高会怎样' WHEN 4 THEN '1、A ____ (5分)' WHEN 5 THEN '为什么这样？' WHEN 6 THEN 'Ａ．　Ｂ．'
      WHEN 7 THEN '可以解释一下吗' WHEN 8 THEN 'Notice: please read' WHEN 9 THEN '请上传你的文件（Please upload the file）' ELSE '' END) AS question_text,
  CASE e.event_id % 7 WHEN 0 THEN '这道题的正确答案是选项B' WHEN 1 THEN '' ELSE d.text END AS ai_response
FROM events e
  CROSS JOIN (SELECT count(*) AS n_docs FROM documents) c
  LEFT JOIN documents d ON d.doc_id = e.event_id % c.n_docs
"""

# One class per nation (0..24; turns also name classes 25..29, which have no
# row). Every tenth class has no end; every fifth has a second, losing row.
CLASSES = """
SELECT CAST(n_nationkey AS BIGINT) AS class_id, 0 AS ord,
  {TS} '2024-01-01 00:00:00' - (n_nationkey % 10) * INTERVAL '7' DAY AS start_at,
  CASE WHEN n_nationkey % 10 = 9 THEN NULL ELSE {TS} '2024-01-31 00:00:00' + (n_nationkey % 3) * INTERVAL '14' DAY - (n_nationkey % 2) * INTERVAL '5' DAY END AS end_at
FROM nation
UNION ALL
SELECT CAST(n_nationkey AS BIGINT), 1, {TS} '2020-01-01 00:00:00', {TS} '2020-06-01 00:00:00' FROM nation WHERE n_nationkey % 5 = 0
"""

# Slots of a class on the days numbered by the nations of its region; every
# eighth class also has one slot without a real end.
SCHEDULE = """
SELECT CAST(c.n_nationkey AS BIGINT) AS class_id,
  {TS} '2024-01-01 08:00:00' + d.n_nationkey * INTERVAL '1' DAY + (c.n_nationkey % 8) * INTERVAL '1' HOUR AS open_at,
  {TS} '2024-01-01 10:00:00' + d.n_nationkey * INTERVAL '1' DAY + (c.n_nationkey % 8) * INTERVAL '1' HOUR AS close_at
FROM nation c JOIN nation d ON c.n_regionkey = d.n_regionkey
UNION ALL
SELECT CAST(n_nationkey AS BIGINT), {TS} '2024-01-20 12:00:00', {TS} '9999-12-31 00:00:00' FROM nation WHERE n_nationkey % 8 = 7
"""

CLUSTERED = """
SELECT user_id AS student_id, user_id % 12 AS class_id, event_id, ts AS dialog_time,
  CASE event_type WHEN 'signup' THEN 0 WHEN 'error' THEN 1 WHEN 'click' THEN 2 WHEN 'view' THEN 3 ELSE 4 END AS cluster FROM events
"""

DIRTY_FEATURES = """
SELECT event_id, CASE WHEN event_id % 89 = 0 THEN NULL ELSE user_id % 12 END AS class_id,
  CASE WHEN event_id % 5 = 0 THEN NULL ELSE event_type END AS tag, CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 101 = 0 THEN CAST('NaN' AS DOUBLE)
  WHEN event_id % 103 = 0 THEN CAST('Infinity' AS DOUBLE) WHEN event_id % 107 = 0 THEN CAST('-Infinity' AS DOUBLE) ELSE value END AS f1,
  CAST(7.0 AS DOUBLE) AS f_const, CASE WHEN user_id % 12 = 5 THEN NULL ELSE value END AS f_all_null_class FROM events
"""

# Dimensions of the embeddings, used as a numeric feature matrix (e1..e64).
EMBED_DIMS = 64

VIEWS = {
    "turns": TURNS,
    "classes": CLASSES,
    "schedule": SCHEDULE,
    "clustered": CLUSTERED,
    "dirty_features": DIRTY_FEATURES,
}


def view_sql(name: str, engine: str) -> str:
    ts = "TIMESTAMP_NTZ" if engine == "spark" else "TIMESTAMP"
    return VIEWS[name].replace("{TS}", ts).strip()


def register_tables(spark: SparkSession, sf_dir: str, names=None) -> None:
    """Register the driver's parquet tables as temp views."""
    for n in names or BASE_TABLES:
        spark.read.parquet(f"{sf_dir}/{n}.parquet").createOrReplaceTempView(n)


_NEEDS = {
    "turns": ["events", "documents"],
    "classes": ["nation"],
    "schedule": ["nation"],
    "clustered": ["events"],
    "dirty_features": ["events"],
}


def load_view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Build a fixture view as a Spark DataFrame over ``sf_dir``. The events behind the
    turns are dealt out first: they are small rows (one split of a file holds very many)
    that are joined to whole texts, which are then measured in the same tasks."""
    register_tables(spark, sf_dir, _NEEDS[name])
    if name == "turns":
        dealt = spark.table("events").repartition(2 * spark.sparkContext.defaultParallelism)
        dealt.createOrReplaceTempView("events")
    return spark.sql(view_sql(name, "spark"))


def embeddings_matrix(spark: SparkSession, sf_dir: str, dims: int = EMBED_DIMS) -> DataFrame:
    """``embeddings`` as (vec_id, label, e1..e{dims}) doubles."""
    from pyspark.sql import functions as F

    e = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return e.select(
        "vec_id", "label",
        *[F.element_at("embedding", i).cast("double").alias(f"e{i}") for i in range(1, dims + 1)],
    )
