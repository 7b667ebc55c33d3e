"""Segmentation queries: seg_*, agg_entry_segments, agg_sessions_per_student,
prj_clean_turns, seg_payload, scl_parse_mapping, seg_topic_split."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import segment as sg
from . import common as C
from . import oracle_sql as O
from .registry import register

# ------------------------------------------------------------------ WIN1-3


@register("seg_entry", O.with_(*O.views("turns"), O.seg_cte("seg", gap=None, entry=True, col="entry_segment"))
          + "SELECT turn_id, student_id, entry_segment FROM seg")
def seg_entry(spark, sf):
    """WIN1: entry-change segments per student."""
    return sg.entry_segments(C.turns(spark, sf)).select("turn_id", "student_id", "entry_segment")


@register("seg_gap", O.with_(*O.views("turns"), O.seg_cte("seg", gap=15, entry=False, col="gap_segment"))
          + "SELECT turn_id, student_id, gap_segment FROM seg")
def seg_gap(spark, sf):
    """WIN2: inactivity-gap segments (> 15 minutes) per student."""
    return sg.gap_segments(C.turns(spark, sf), 15).select("turn_id", "student_id", "gap_segment")


@register("seg_sessions", O.with_(*O.views("turns"), O.seg_cte("seg", gap=15, entry=True))
          + "SELECT turn_id, student_id, session_index, is_new_session FROM seg")
def seg_sessions(spark, sf):
    """WIN3 + SRT1: combined session index (entry change OR gap > 15 min)."""
    s = C.sessions(spark, sf, 15)
    return s.select("turn_id", "student_id", "session_index", F.col("is_new_session").cast("int").alias("is_new_session"))


@register("agg_entry_segments", O.with_(*O.views("turns"), O.seg_cte("seg", gap=None, entry=True, col="entry_segment"))
          + """SELECT student_id, entry_segment, first(entry ORDER BY asked_at, turn_id) AS entry, count(*) AS n_records
               FROM seg GROUP BY student_id, entry_segment""")
def agg_entry_segments(spark, sf):
    """AGG2: entry and record count per entry segment."""
    return sg.entry_segment_report(sg.entry_segments(C.turns(spark, sf)))


@register("agg_sessions_per_student", O.with_(*O.views("turns"), O.seg_cte("seg", gap=15, entry=True))
          + "SELECT student_id, count(DISTINCT session_index) AS n_sessions, count(*) AS n_turns FROM seg GROUP BY student_id")
def agg_sessions_per_student(spark, sf):
    """AGG1: sessions and turns per student."""
    return sg.sessions_per_student(C.sessions(spark, sf, 15))


@register("prj_clean_turns", O.with_(*O.views("turns"))
          + """SELECT turn_id, student_id, replace(coalesce(question_text, ''), chr(10), ' ') AS question_text,
                 replace(coalesce(ai_response, ''), chr(10), ' ') AS ai_response, coalesce(entry, '') AS entry,
                 strftime(CASE turn_id % 6 WHEN 0 THEN asked_at WHEN 3 THEN date_trunc('minute', asked_at) WHEN 4 THEN date_trunc('day', asked_at)
                   ELSE date_trunc('second', asked_at) END, '%Y-%m-%d %H:%M:%S.%f') AS asked_at
               FROM turns WHERE asked_at IS NOT NULL AND turn_id % 6 <> 5""")
def prj_clean_turns(spark, sf):
    """FLT1-3: newline -> space, null text -> '', times read from text in
    several written forms, rows with unreadable times dropped."""
    forms = ["yyyy-MM-dd HH:mm:ss.SSSSSS", "yyyy-MM-dd HH:mm:ss", "yyyy/MM/dd HH:mm:ss", "yyyy/M/d H:mm", "yyyy/M/d"]
    text = F.lit("soon")
    for i, f in enumerate(forms):
        text = F.when(F.col("turn_id") % 6 == i, F.date_format("asked_at", f)).otherwise(text)
    t = sg.clean_turns(C.turns(spark, sf).withColumn("asked_at", text))
    return t.select("turn_id", "student_id", "question_text", "ai_response", "entry", F.date_format("asked_at", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("asked_at"))


# ------------------------------------------------------------------ WIN4, SCL12-15, UDF1, JOIN5, WIN8

_ROWS_CTE = [
    *O.views("turns"),
    O.seg_cte("seg", gap=720, entry=False),
    """rows AS (SELECT *, CAST(row_number() OVER (PARTITION BY student_id, session_index ORDER BY asked_at, turn_id) AS INTEGER) AS row_number,
         count(*) OVER (PARTITION BY student_id, session_index) AS segment_rows FROM seg)""",
]


@register("seg_payload", O.with_(*_ROWS_CTE, f"""pay AS (
  SELECT student_id, session_index, count(*) AS n_rows,
    to_json(list({{'row_number': row_number, 'timestamp': CASE WHEN asked_at = date_trunc('second', asked_at) THEN strftime(asked_at, '%Y-%m-%d %H:%M:%S') ELSE strftime(asked_at, '%Y-%m-%d %H:%M:%S.%f') END,
      'question': substr(coalesce(question_text, ''), 1, 500), 'ai_response': substr(coalesce(ai_response, ''), 1, 500)}} ORDER BY row_number)) AS payload
  FROM rows WHERE segment_rows >= 3 GROUP BY student_id, session_index)""")
          + "SELECT student_id, session_index, n_rows, CAST(length(payload) AS INTEGER) AS payload_chars, md5(payload) AS payload_md5 FROM pay")
def seg_payload(spark, sf):
    """WIN4 + SCL12-13: JSON payload per segment of >= 3 turns (gap-only, 720 min)."""
    rows = sg.with_row_in_segment(sg.segment(sg.payload_texts(C.turns(spark, sf)), gap_minutes=720, split_on_entry=False))
    p = sg.segment_payloads(rows)
    return p.select("student_id", "session_index", "n_rows", F.length("payload").alias("payload_chars"), F.md5("payload").alias("payload_md5"))


def _replies(rows):
    """Segmenter replies derived from the data: per segment of >= 3 turns, the
    map row_number -> 1 + (row_number-1) div 3 in the styles that replies come in:
    fenced with a trailing comma, plain array, string values, broken text, bare
    keys, single quotes with comments, and fractions with numbers out of range."""
    body = rows.filter(F.col("segment_rows") >= 3).groupBy("student_id", "session_index").agg(
        F.array_sort(F.collect_list(F.struct("row_number", (1 + F.expr("(row_number - 1) div 3")).alias("t")))).alias("m")
    )
    def items(form, sep=", "):
        return F.array_join(F.transform("m", lambda x: F.format_string(form, x["row_number"], x["t"])), sep)

    plain = F.concat(F.lit("{"), items('"%d": %d'), F.lit("}"))
    forms = [
        F.concat(F.lit("```json\n{"), items('"%d": %d'), F.lit(",}\n```")),
        F.concat(F.lit("["), F.array_join(F.transform("m", lambda x: x["t"].cast("string")), ", "), F.lit("]")),
        F.concat(F.lit("{"), items('"%d": "%d"'), F.lit("}")),
        F.concat(F.lit("not json: "), plain),
        F.concat(F.lit("{"), items("%d: %d"), F.lit("}")),
        F.concat(F.lit("{ // topics by row\n"), items("'%d': %d", ",\n"), F.lit(" /* end */ }")),
        F.concat(F.lit("{"), items('"%d": %d.0'), F.lit(', "900001": 3000000000, "900002": 1e30}')),
    ]
    style = F.col("session_index") % len(forms)
    reply = forms[-1]
    for i, f in enumerate(forms[:-1]):
        reply = F.when(style == i, f).otherwise(reply)
    return body.select("student_id", "session_index", reply.alias("reply"))


@register("scl_parse_mapping", O.with_(*_ROWS_CTE)
          + """SELECT student_id, session_index, row_number, CAST(1 + (row_number - 1) // 3 AS INTEGER) AS topic_id
               FROM rows WHERE segment_rows >= 3 AND session_index % 7 <> 3""")
def scl_parse_mapping(spark, sf):
    """SCL14-15: lenient parse of segmenter replies (fences, trailing commas,
    arrays, string values, broken JSON) into (row_number, topic_id) rows."""
    rows = sg.with_row_in_segment(C.sessions(spark, sf, 720, entry=False))
    r = _replies(rows).withColumn("mapping", sg.parse_mapping("reply"))
    return sg.mapping_rows(r)


def _mapping(rows):
    """Mapping derived in SQL terms: topic = 1 + (row_number-1) div 3, every
    7th row left out, every 5th segment without any mapping."""
    topic = (1 + F.expr("(row_number - 1) div 3")).cast("int")
    # every third row is named twice; the smaller topic counts
    topics = F.when(F.col("row_number") % 3 == 0, F.array(topic + 5, topic)).otherwise(F.array(topic))
    return rows.filter((F.col("segment_rows") >= 3) & (F.col("session_index") % 5 != 0) & (F.col("row_number") % 7 != 0)).select(
        "student_id", "session_index", "row_number", F.explode(topics).alias("topic_id")
    )


@register("seg_topic_split", O.with_(*_ROWS_CTE, """mp AS (
  SELECT student_id, session_index, row_number, CAST(1 + (row_number - 1) // 3 AS INTEGER) AS topic_id
  FROM rows WHERE segment_rows >= 3 AND session_index % 5 <> 0 AND row_number % 7 <> 0)""",
  """hm AS (SELECT DISTINCT student_id, session_index FROM mp)""",
  """j AS (SELECT r.*, mp.topic_id, hm.student_id IS NOT NULL AND r.segment_rows > 2 AS mapped
           FROM rows r LEFT JOIN mp USING (student_id, session_index, row_number)
           LEFT JOIN hm ON hm.student_id = r.student_id AND hm.session_index = r.session_index)""",
  """k AS (SELECT *, CASE WHEN mapped THEN topic_id ELSE 0 END AS topic FROM j WHERE NOT mapped OR topic_id IS NOT NULL)""")
          + """SELECT turn_id, student_id, session_index AS segment_index,
                 CAST(dense_rank() OVER (PARTITION BY student_id ORDER BY session_index, topic) AS INTEGER) AS session_index
               FROM k""")
def seg_topic_split(spark, sf):
    """FLT12 + JOIN5 + WIN8 (+ UDF1 hook): split long segments by a topic
    mapping; partially mapped segments lose unmapped turns."""
    rows = sg.with_row_in_segment(C.sessions(spark, sf, 720, entry=False))
    out = sg.topic_split(rows, _mapping(rows))
    return out.select("turn_id", "student_id", "segment_index", "session_index")


@register("seg_topic_hook", O.with_(*_ROWS_CTE, """mp AS (
  SELECT student_id, session_index, row_number, CAST(1 + (row_number - 1) // 3 AS INTEGER) AS topic_id
  FROM rows WHERE segment_rows >= 3 AND segment_rows % 5 <> 4 AND row_number % 7 <> 0)""",
  """hm AS (SELECT DISTINCT student_id, session_index FROM mp)""",
  """j AS (SELECT r.*, mp.topic_id, hm.student_id IS NOT NULL AND r.segment_rows > 2 AS mapped
           FROM rows r LEFT JOIN mp USING (student_id, session_index, row_number)
           LEFT JOIN hm ON hm.student_id = r.student_id AND hm.session_index = r.session_index)""",
  """k AS (SELECT *, CASE WHEN mapped THEN topic_id ELSE 0 END AS topic FROM j WHERE NOT mapped OR topic_id IS NOT NULL)""")
          + """SELECT turn_id, student_id, session_index AS segment_index,
                 CAST(dense_rank() OVER (PARTITION BY student_id ORDER BY session_index, topic) AS INTEGER) AS session_index
               FROM k""")
def seg_topic_hook(spark, sf):
    """UDF1 + JOIN5 + WIN8: a caller's segmenter run on the payloads, its
    mappings applied. It answers in the forms that segmenters do: an object, a
    fenced text, JSON5 with numbers out of range, an array with gaps; every fifth
    length of segment gets an answer that cannot be used and stays whole."""
    rows = sg.with_row_in_segment(sg.segment(sg.payload_texts(C.turns(spark, sf)), gap_minutes=720, split_on_entry=False))

    def by_threes(turns):  # a deterministic segmenter
        topics = {t["row_number"]: 1 + (t["row_number"] - 1) // 3 for t in turns if t["row_number"] % 7}
        n = len(turns)
        return [
            topics,
            "```json\n{" + "".join(f'"{k}": {v},' for k, v in topics.items()) + "}\n```",
            "{ // by row\n" + "".join(f"{k}: +{v}.0, " for k, v in topics.items()) + "'900001': 3000000000, 3000000000: 1 /* end */ }",
            [topics.get(i) for i in range(1, n + 1)],
            "no answer" if n % 2 else '{"1": 1, "2": Infinity}',
        ][n % 5]

    out = sg.topic_split(rows, sg.apply_segmenter(sg.segment_payloads(rows), by_threes))
    return out.select("turn_id", "student_id", "segment_index", "session_index")
