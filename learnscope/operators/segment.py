"""Session segmentation of question/answer turns (entry change, inactivity gap,
optional topic split), as DataFrame -> DataFrame operators.

Turns carry ``student_id``, ``asked_at`` and ``turn_id`` (tie-breaker), and
optionally ``source`` (the input file; sessions never cross files), ``entry``,
``question_text``, ``ai_response``, ``class_id``. Sessions are not files: each
turn gets ``session_index`` (1-based, per source + student) and the key
columns identify a session.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import lexicon as L
from ..functions.replies import as_mapping, read_reply
from .sequence import BUCKET, DEFAULT_BUCKET_SECONDS, with_group_index, with_running_sum

TEXT_COLUMNS = ("question_text", "ai_response")


def student_keys(df: DataFrame) -> list[str]:
    """Unit of segmentation: (source, student) when a source column exists."""
    return ["source", "student_id"] if "source" in df.columns else ["student_id"]


def session_keys(df: DataFrame) -> list[str]:
    return [*student_keys(df), "session_index"]


# Written forms of log times beside ISO 8601, tried in this order.
TIME_FORMATS = (
    "yyyy/M/d H:mm:ss.SSSSSS", "yyyy/M/d H:mm:ss", "yyyy/M/d H:mm", "yyyy/M/d",
    "yyyy-M-d H:mm:ss", "yyyy-M-d H:mm", "M/d/yyyy H:mm:ss", "M/d/yyyy H:mm", "M/d/yyyy",
    "yyyy年M月d日 H:mm:ss", "yyyy年M月d日 H:mm", "yyyy年M月d日",
)


def parse_time(col: Column | str, formats: Sequence[str] | None = None) -> Column:
    """Coercing time parse: bad values become null (never an error). Without
    ``formats``: ISO 8601, then the common forms of ``TIME_FORMATS``."""
    c = F.trim(F.col(col) if isinstance(col, str) else col)
    if not formats:
        iso = F.try_to_timestamp(c.cast("string")).cast("timestamp_ntz")
        return F.coalesce(iso, *[F.try_to_timestamp(c.cast("string"), F.lit(f)).cast("timestamp_ntz") for f in TIME_FORMATS])
    return F.coalesce(*[F.try_to_timestamp(c.cast("string"), F.lit(f)).cast("timestamp_ntz") for f in formats])


def clean_turns(turns: DataFrame, text_columns: Sequence[str] = TEXT_COLUMNS, time_formats: Sequence[str] | None = None) -> DataFrame:
    """FLT1-3: newline -> space in text columns, null text -> '', parse the
    question time (string input) and drop rows whose time does not parse."""
    out = turns
    for c in text_columns:
        if c in out.columns:
            out = out.withColumn(c, F.replace(F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit("\n"), F.lit(" ")))
    if "entry" in out.columns:
        out = out.withColumn("entry", F.coalesce(F.col("entry").cast("string"), F.lit("")))
    if not isinstance(out.schema["asked_at"].dataType, (T.TimestampNTZType, T.TimestampType)):
        out = out.withColumn("asked_at", parse_time("asked_at", time_formats))
    return out.filter(F.col("asked_at").isNotNull())


def segment(
    turns: DataFrame,
    gap_minutes: float | None = L.GAP_MINUTES,
    split_on_entry: bool | None = None,
    bucket_seconds: int = DEFAULT_BUCKET_SECONDS,
) -> DataFrame:
    """WIN1-3: ``session_index`` per turn. A new session starts at a student's
    first turn, when ``entry`` differs from the previous turn's entry (if
    ``split_on_entry``; default: when an entry column exists), or when the gap
    to the previous turn is strictly greater than ``gap_minutes``
    (``None`` disables the gap rule). Order is (asked_at, turn_id). Turns
    without a student id are dropped (as a group-by on the student does).
    With a ``class_id`` column, ``session_class_id`` is the class of the
    session's first turn (the session's class). ``turn_rank`` is the turn's
    1-based position in its student's sequence.
    One shuffle of the turns, skew-safe (see :func:`with_group_index`)."""
    keys = student_keys(turns)
    use_entry = ("entry" in turns.columns) if split_on_entry is None else split_on_entry
    vals = ["asked_at"] + (["entry"] if use_entry else [])
    micros = None if gap_minutes is None else int(round(gap_minutes * 60_000_000))

    def starts(prev, cur):
        cond = F.lit(False)
        if use_entry:
            cond = cond | ~F.coalesce(prev["entry"], F.lit("")).eqNullSafe(F.coalesce(cur["entry"], F.lit("")))
        if micros is not None:
            cond = cond | (F.timestamp_diff("MICROSECOND", prev["asked_at"], cur["asked_at"]) > F.lit(micros))
        return cond

    t = turns.filter(F.col(keys[-1]).isNotNull())
    if "source" in keys:
        t = t.withColumn("source", F.coalesce(F.col("source"), F.lit("")))
    carry = ["class_id"] if "class_id" in t.columns else []
    d = with_group_index(t, keys, "asked_at", ["turn_id"], vals, starts, name="session_index", flag="is_new_session",
                         bucket_seconds=bucket_seconds, carry=carry, carry_prefix="session_", rank="turn_rank")
    return d.withColumn("session_index", F.col("session_index").cast("int")).drop(BUCKET)


def entry_segments(turns: DataFrame, bucket_seconds: int = DEFAULT_BUCKET_SECONDS) -> DataFrame:
    """WIN1 alone: ``entry_segment`` index per student (entry-change split)."""
    d = segment(turns, gap_minutes=None, split_on_entry=True, bucket_seconds=bucket_seconds)
    return d.withColumnRenamed("session_index", "entry_segment")


def gap_segments(turns: DataFrame, gap_minutes: float = L.GAP_MINUTES, bucket_seconds: int = DEFAULT_BUCKET_SECONDS) -> DataFrame:
    """WIN2 alone: ``gap_segment`` index per student (inactivity split)."""
    d = segment(turns, gap_minutes=gap_minutes, split_on_entry=False, bucket_seconds=bucket_seconds)
    return d.withColumnRenamed("session_index", "gap_segment")


def entry_segment_report(segmented: DataFrame, segment_col: str = "entry_segment") -> DataFrame:
    """AGG2: entry and record count per entry segment."""
    keys = [*student_keys(segmented), segment_col]
    return segmented.groupBy(*keys).agg(
        F.min_by("entry", F.struct("asked_at", "turn_id")).alias("entry"),
        F.count(F.lit(1)).alias("n_records"),
    )


def sessions_per_student(sessions: DataFrame) -> DataFrame:
    """AGG1: sessions per student (and turns), per source."""
    keys = student_keys(sessions)
    return sessions.groupBy(*keys).agg(
        F.count_distinct("session_index").alias("n_sessions"),
        F.count(F.lit(1)).alias("n_turns"),
    )


def with_row_in_segment(segmented: DataFrame, segment_col: str = "session_index", bucket_seconds: int = DEFAULT_BUCKET_SECONDS) -> DataFrame:
    """WIN4: 1-based ``row_number`` of each turn inside its segment, and the
    segment size ``segment_rows``, computed without a per-segment window:
    rank within the student (skew-safe running count) minus the segment's
    first rank (partial aggregate)."""
    keys = student_keys(segmented)
    if "turn_rank" in segmented.columns:  # produced by segment() in the same pass
        d = segmented.withColumn("__rank", F.col("turn_rank"))
    else:
        d = with_running_sum(segmented, keys, "asked_at", ["turn_id"], F.lit(1), "__rank", bucket_seconds=bucket_seconds).drop(BUCKET)
    seg = d.groupBy(*keys, segment_col).agg(F.min("__rank").alias("__r0"), F.count(F.lit(1)).alias("segment_rows"))
    d = d.join(seg, on=[*keys, segment_col], how="inner")
    return d.withColumn("row_number", (F.col("__rank") - F.col("__r0") + 1).cast("int")).drop("__rank", "__r0")


PAYLOAD_PIECE = 256  # turns of a payload that are written as JSON at a time


def payload_texts(turns: DataFrame, text_chars: int = L.PAYLOAD_TEXT_CHARS) -> DataFrame:
    """Turns with only those parts of their texts that a payload holds, so that the
    shuffles of a segmentation for payloads move no whole texts."""
    return turns.withColumns({c: F.substring(F.coalesce(F.col(c), F.lit("")), 1, text_chars) for c in TEXT_COLUMNS if c in turns.columns})


def printed_time(col: str) -> Column:
    """SCL12: a time as text, with its six-digit fraction only if it has one."""
    whole = F.date_format(col, "yyyy-MM-dd HH:mm:ss")
    fraction = F.date_format(col, ".SSSSSS")
    return F.when(fraction == ".000000", whole).otherwise(F.concat(whole, fraction))


def segment_payloads(rows: DataFrame, segment_col: str = "session_index", min_rows: int = 3, text_chars: int = L.PAYLOAD_TEXT_CHARS,
                     max_rows: int | None = None) -> DataFrame:
    """SCL12-13: one JSON payload per segment with at least ``min_rows`` turns:
    ``[{"row_number", "timestamp", "question", "ai_response"}, ...]`` in row
    order, texts cut to ``text_chars`` code points. Input: :func:`with_row_in_segment`.

    Every such segment gets its payload, however long. A payload is one document for
    one call of a segmenter, so it is put together in one task, of pieces of
    ``PAYLOAD_PIECE`` turns that are JSON already. A caller whose segmenter reads no
    more than ``max_rows`` turns may say so: longer segments then get no payload and
    stay whole; :func:`rejected_segments` lists them."""
    keys = [*student_keys(rows), segment_col]
    item = F.struct(
        F.col("row_number").alias("row_number"),
        printed_time("asked_at").alias("timestamp"),
        F.substring(F.coalesce(F.col("question_text"), F.lit("")), 1, text_chars).alias("question"),
        F.substring(F.coalesce(F.col("ai_response"), F.lit("")), 1, text_chars).alias("ai_response"),
    )
    long_enough = F.col("segment_rows") >= min_rows
    if max_rows is not None:
        long_enough = long_enough & (F.col("segment_rows") <= max_rows)
    # rows of a segment lie in one partition already: neither step shuffles them again
    pieces = (
        rows.filter(long_enough)
        .groupBy(*keys, F.floor((F.col("row_number") - 1) / PAYLOAD_PIECE).alias("__piece"))
        .agg(F.to_json(F.array_sort(F.collect_list(item))).alias("__json"), F.count(F.lit(1)).alias("__n"))
    )
    inner = F.substr("__json", F.lit(2), F.length("__json") - 2)
    in_order = F.transform(F.array_sort(F.collect_list(F.struct("__piece", inner.alias("t")))), lambda x: x["t"])
    return pieces.groupBy(*keys).agg(F.concat(F.lit("["), F.array_join(in_order, ","), F.lit("]")).alias("payload"), F.sum("__n").alias("n_rows"))


def rejected_segments(rows: DataFrame, segment_col: str = "session_index", max_rows: int | None = None) -> DataFrame:
    """(keys, segment, n_rows, reason) of the segments that are too long for a
    caller's ``max_rows`` (none without it). Input: :func:`with_row_in_segment`; the
    first row stands for each."""
    too_long = F.lit(False) if max_rows is None else F.col("segment_rows") > max_rows
    long = rows.filter((F.col("row_number") == 1) & too_long)
    return long.select(*student_keys(rows), segment_col, F.col("segment_rows").alias("n_rows"), F.lit("too_long").alias("reason"))


PROMPT_HEADER = (
    "Below is a JSON array with one object per tutoring turn, oldest first. Find the turns at which the subject changes: "
    "a new exercise, a new concept, or a fresh start after a long silence. Number the subjects from 1 in the order they come up. "
    "Reply with one JSON object and nothing else; each key is a row_number of the array and its value the number of that turn's subject.\n"
)


def render_prompt(payload: Column | str, header: str = PROMPT_HEADER) -> Column:
    """Prompt text for a topic segmenter (header + payload)."""
    p = F.col(payload) if isinstance(payload, str) else payload
    return F.concat(F.lit(header), p)


def parse_mapping(reply: Column | str) -> Column:
    """SCL14-15: lenient parse of a segmenter reply into ``map<string,int>``, by
    :func:`learnscope.functions.replies.read_reply` in Arrow batches.

    Strips code fences; text that is not strict JSON is read as JSON5. A JSON object
    keeps its keys, a JSON array becomes a 1-based map; values: numbers truncate to
    int (those out of range are dropped), booleans become 0/1, numeric strings cast
    (non-integers dropped); anything else gives an empty map."""
    return F.udf(read_reply, "map<string,int>", useArrow=True)(reply)


def mapping_rows(payloads_with_map: DataFrame, map_col: str = "mapping", segment_col: str = "session_index") -> DataFrame:
    """Explode a ``map<string,int>`` per segment into (keys, row_number, topic_id)."""
    keys = [*student_keys(payloads_with_map), segment_col]
    return payloads_with_map.select(*keys, F.explode(map_col).alias("k", "topic_id")).select(
        *keys, F.col("k").try_cast("int").alias("row_number"), F.col("topic_id").cast("int")
    ).filter(F.col("row_number").isNotNull())


def apply_segmenter(payloads: DataFrame, segmenter, segment_col: str = "session_index") -> DataFrame:
    """UDF1: run a user topic segmenter ``fn(rows: list[dict]) -> dict|list|str``
    on each payload with ``mapInPandas`` (Arrow batches, one call per segment),
    and return mapping rows (keys, row_number, topic_id). Texts are read as replies
    are (:mod:`learnscope.functions.replies`). A failing call, or a reply that
    cannot be read, keeps the segment whole (no rows)."""
    import json

    import pandas as pd

    keys = [*student_keys(payloads), segment_col]
    schema = payloads.select(*keys).schema.add("row_number", T.IntegerType()).add("topic_id", T.IntegerType())

    def run(batches):
        for pdf in batches:
            out = []
            for rec in pdf.to_dict("records"):
                try:
                    res = segmenter(json.loads(rec["payload"]))
                    mapping = read_reply(res) if isinstance(res, str) else as_mapping(res)
                except Exception:  # a failed call keeps the segment whole
                    continue
                named = as_mapping(dict(zip(mapping, mapping)))  # row numbers are integers too
                out += [{**{c: rec[c] for c in keys}, "row_number": named[k], "topic_id": v} for k, v in mapping.items() if k in named]
            yield pd.DataFrame(out, columns=[*keys, "row_number", "topic_id"])

    return payloads.select(*keys, "payload").mapInPandas(run, schema)


def topic_split(rows: DataFrame, mapping: DataFrame, segment_col: str = "session_index", unmapped: str = "drop", bucket_seconds: int = DEFAULT_BUCKET_SECONDS) -> DataFrame:
    """JOIN5 + WIN8: split segments by a (keys, row_number, topic_id) mapping.

    Segments with at most 2 rows or without any mapping row stay whole. In a
    mapped segment, rows without a topic are dropped (``unmapped='drop'``, as
    in the original) or kept as their own trailing topic (``'keep'``). Final
    ``session_index`` numbers topics in ascending id order inside a segment,
    continuing across segments of the student. Input: :func:`with_row_in_segment`."""
    keys = student_keys(rows)
    seg_keys = [*keys, segment_col]
    # a row number given twice takes its smallest topic
    m = mapping.filter(F.col("topic_id").isNotNull()).groupBy(*seg_keys, "row_number").agg(F.min("topic_id").alias("topic_id"))
    has_map = m.select(*seg_keys).distinct().withColumn("__has_map", F.lit(True))
    d = rows.join(m, on=[*seg_keys, "row_number"], how="left").join(has_map, on=seg_keys, how="left")
    mapped = F.coalesce(F.col("__has_map"), F.lit(False)) & (F.col("segment_rows") > 2)
    if unmapped == "drop":
        d = d.filter(~mapped | F.col("topic_id").isNotNull())
        topic = F.when(mapped, F.col("topic_id")).otherwise(F.lit(0))
    else:
        topic = F.when(mapped, F.coalesce(F.col("topic_id"), F.lit(2147483647))).otherwise(F.lit(0))
    d = d.withColumn("__topic", topic)
    # one row per (segment, topic): small; number topics within the segment
    topics = d.groupBy(*seg_keys, "__topic").agg(F.min("asked_at").alias("__t0"))
    wt = Window.partitionBy(*seg_keys).orderBy("__topic")
    topics = topics.withColumn("__trank", F.dense_rank().over(wt))
    per_seg = topics.groupBy(*seg_keys).agg(F.count(F.lit(1)).alias("__ntopics"), F.min("__t0").alias("__seg_t0"))
    # offsets across segments of a student: skew-safe running sum
    per_seg = with_running_sum(per_seg, keys, "__seg_t0", [segment_col], F.col("__ntopics"), "__segcum", bucket_seconds=bucket_seconds).drop(BUCKET)
    per_seg = per_seg.withColumn("__off", F.col("__segcum") - F.col("__ntopics")).drop("__segcum", "__ntopics", "__seg_t0")
    topics = topics.join(per_seg, on=seg_keys, how="inner").select(*seg_keys, "__topic", (F.col("__off") + F.col("__trank")).cast("int").alias("__final"))
    d = d.join(topics, on=[*seg_keys, "__topic"], how="inner")
    return (
        d.withColumnRenamed(segment_col, "segment_index")
        .withColumn("session_index", F.col("__final"))
        .drop("__final", "__topic", "__has_map")
    )
