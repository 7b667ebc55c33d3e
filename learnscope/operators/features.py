"""Session features: behavioral, text-signal and calendar features per session,
the reject cascade, single-turn imputation and log1p.

Input is the segmented turns DataFrame (see :mod:`.segment`). All per-session
work is one ``groupBy`` over the session key (map-side partial aggregation for
counts/min/max/avg). Long texts are measured per turn, before the segmentation's
shuffle (:func:`measure_turns`); text signals add what is counted on the session's
pooled edges, for sessions that pass the reject cascade.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import lexicon as L
from ..functions import measures as M
from ..functions import text as X
from .common import attach_one_row, is_finite
from .segment import parse_time, session_keys, student_keys

ORDER = ("asked_at", "turn_id")


def _first(col: str) -> Column:
    """Value of ``col`` on the session's first turn (time order, then turn_id)."""
    return F.min_by(F.col(col), F.struct(*[F.col(c) for c in ORDER]))


INSIDE = ("inside_copy", "inside_answer", "inside_understanding")
MEASURES = ("__clen", "__rlen", "__image", "__reply")


def measure_turns(turns: DataFrame, keep: str = "edges", lexicon: dict | None = None) -> DataFrame:
    """What the session aggregates need of a turn's texts, taken before the turns are
    dealt to sessions, so that no whole text is shuffled: cleaned and raw length,
    image flag, and the first ``FIRST_REPLY_CHARS`` characters of the reply
    (``ai_response`` is dropped). ``question_text`` stays whole (``keep='text'``), is
    dropped (``'none'``), or is cut to its edges (``'edges'``), with the ``INSIDE``
    columns for what they leave out of the counts of :func:`session_signals`. A
    caller's own patterns need the whole text where no character is known that
    none of their matches holds (:func:`learnscope.functions.measures.stops`):
    with such patterns ``'edges'`` is ``'text'``."""
    if measured(turns):
        return turns
    t = turns
    if "question_text" in turns.columns:
        t = t.withColumn("question_text", F.coalesce(F.col("question_text").cast("string"), F.lit("")))
        t = t.withColumn("__m", M.per_text(lambda s: (M.cleaned_length(s), len(s), int(M.has_image(s))), "struct<c:int,r:int,i:int>", "question_text"))
        edges = M.signal_edges(_lists(lexicon)) if keep == "edges" else None
        if edges:
            t = t.withColumn("__e", M.per_text(edges, "struct<t:string,c:bigint,a:bigint,u:bigint>", "question_text"))
            t = t.withColumn("question_text", F.col("__e.t"))
            t = t.withColumns(dict(zip(INSIDE, (F.col(f"__e.{f}") for f in "cau")))).drop("__e")
        t = t.withColumns({"__clen": F.col("__m.c"), "__rlen": F.col("__m.r"), "__image": F.col("__m.i")}).drop("__m")
        t = t.drop("question_text") if keep == "none" else t
    if "ai_response" in turns.columns:
        t = t.withColumn("__reply", X.truncate("ai_response", L.FIRST_REPLY_CHARS)).drop("ai_response")
    return t


def measured(turns: DataFrame) -> bool:
    return any(c in turns.columns for c in MEASURES)


def session_summary(turns: DataFrame, with_text: bool = True, extra_keys: Sequence[str] = ()) -> DataFrame:
    """AGG3-11: one row per session with the cheap aggregates and (optionally)
    the pooled prompt text (AGG10) and the first AI reply's first 100
    characters (AGG11). With ``extra_keys``, one row per part of a session, and
    the sums behind the averages. Turns that :func:`measure_turns` has not seen
    are measured here."""
    keys = [*session_keys(turns), *extra_keys]
    t = measure_turns(turns, "text" if with_text else "none")
    aggs = [
        F.count(F.lit(1)).alias("qa_turns"),
        F.min("asked_at").alias("t_min"),
        F.max("asked_at").alias("t_max"),
        F.max(F.col("asked_at").isNull().cast("int")).alias("any_bad_time"),
    ]
    if "class_id" in turns.columns:
        aggs.append(_first("class_id").alias("class_id"))
    if "__clen" in t.columns:
        aggs += [
            F.avg("__clen").alias("avg_question_length"),
            F.avg("__rlen").alias("avg_raw_length"),
            F.max("__image").alias("has_image"),
        ]
        if extra_keys:
            aggs += [F.sum("__clen").alias("avg_question_length_sum"), F.sum("__rlen").alias("avg_raw_length_sum")]
    if "entry" in turns.columns:
        aggs.append(F.max(X.is_confusion_entry("entry").cast("int")).alias("is_confusion_entry"))
    else:
        aggs.append(F.lit(0).alias("is_confusion_entry"))
    if "in_slot" in turns.columns:
        aggs.append(F.max("in_slot").alias("is_in_class_time"))
    aggs += [F.sum(c).alias(c) for c in INSIDE if c in t.columns]
    if with_text and "question_text" in t.columns:
        aggs.append(X.ordered_concat("question_text", *ORDER).alias("pooled_prompts"))
    if with_text and "__reply" in t.columns:
        aggs.append(F.coalesce(_first("__reply"), F.lit("")).alias("first_ai_reply"))
    return t.groupBy(*keys).agg(*aggs)


PIECE_TURNS = 256  # turns of a student's sequence whose texts are joined in one row
LONG_TURNS, LONG_CHARS = 64, 65_536  # a piece with more is cut to its edges


def session_signals(turns: DataFrame, lexicon: dict | None = None) -> DataFrame:
    """:func:`session_summary` for the text signals, without a session's whole text
    in one row. A turn's long text is counted where it is and goes on as its edges
    (:func:`measure_turns`, here or before the segmentation). Those are joined per piece
    of ``PIECE_TURNS`` turns (``turn_rank`` of the segmentation); a long piece is cut to
    its edges likewise (:func:`learnscope.functions.text.with_edges`). ``pooled_prompts``
    then joins short pieces and edges, and ``inside_copy``, ``inside_answer`` and
    ``inside_understanding`` are what the edges leave out: the sums are those of the
    whole text. Pieces stay whole where a caller's own patterns are counted (their turns are
    cut), and where option labels follow one another all along an end."""
    own = _own_patterns(lexicon)
    t = measure_turns(turns, "edges", lexicon)
    if own or "turn_rank" not in t.columns or "question_text" not in t.columns:
        return session_summary(t)
    keys = session_keys(t)
    part = session_summary(t.withColumn("__piece", F.floor((F.col("turn_rank") - 1) / PIECE_TURNS)), extra_keys=["__piece"])
    lx = _lists(lexicon)
    phrases = [*lx["copy"], *lx["answer_prompt"], *lx["understanding"]]
    long = (F.col("qa_turns") > LONG_TURNS) | (F.length("pooled_prompts") > LONG_CHARS)
    part = X.with_edges(part, "pooled_prompts", "__edges", long, phrases)
    cut = F.length("__edges") < F.length("pooled_prompts")
    part = part.withColumn("__whole", F.when(cut, F.col("pooled_prompts"))).withColumn("__cut", F.when(cut, F.col("__edges")))
    part = part.withColumn("__nwhole", F.when(cut, X.normalize("__whole"))).withColumn("__ncut", F.when(cut, X.normalize("__cut")))

    def left_out(signal: str, count) -> Column:
        return F.col(signal) + F.when(cut, count("__whole", "__nwhole") - count("__cut", "__ncut")).otherwise(F.lit(0)).cast("long")

    part = part.withColumns(dict(zip(INSIDE, (
        left_out("inside_copy", lambda raw, norm: X.patterns_count(raw, lx["copy_patterns"], L.NON_NATURAL_REQUIRED) + X.phrases_count(norm, lx["copy"])),
        left_out("inside_answer", lambda raw, norm: X.phrases_count(norm, lx["answer_prompt"])),
        left_out("inside_understanding", lambda raw, norm: X.patterns_count(raw, lx["hypothetical"], L.HYPOTHETICAL_REQUIRED) + X.phrases_count(norm, lx["understanding"])),
    )))).withColumn("pooled_prompts", F.when(cut, F.col("__edges")).otherwise(F.col("pooled_prompts")))
    n = F.col("qa_turns")
    aggs = [
        F.sum("qa_turns").alias("qa_turns"),
        *[F.min(c).alias(c) for c in ("t_min",)],
        *[F.max(c).alias(c) for c in ("t_max", "any_bad_time", "has_image", "is_confusion_entry", "is_in_class_time") if c in part.columns],
        *[(F.sum(f"{c}_sum") / F.sum(n)).alias(c) for c in ("avg_question_length", "avg_raw_length")],
        *[F.min_by(c, "__piece").alias(c) for c in ("class_id", "first_ai_reply") if c in part.columns],
        *[F.sum(c).alias(c) for c in INSIDE],
        X.ordered_concat("pooled_prompts", "__piece").alias("pooled_prompts"),
    ]
    return part.groupBy(*keys).agg(*aggs)


def behavioral(summary: DataFrame) -> DataFrame:
    """AGG3-5: qa_turns, avg_qa_time_minutes (span / (n-1), 0 for one turn or
    zero span), avg_question_length."""
    span_min = F.greatest(F.timestamp_diff("MICROSECOND", F.col("t_min"), F.col("t_max")) / F.lit(60_000_000.0), F.lit(0.0))
    avg_qa = F.when((F.col("qa_turns") > 1) & (span_min > 0), span_min / (F.col("qa_turns") - 1)).otherwise(F.lit(0.0))
    return summary.withColumn("avg_qa_time_minutes", avg_qa.cast("double")).withColumn(
        "avg_question_length", F.coalesce(F.col("avg_question_length"), F.lit(0.0)).cast("double")
    )


def _image_bonus() -> Column:
    return ((F.col("has_image") == 1) & (F.col("is_confusion_entry") == 0)).cast("int")


def _inside(summary: DataFrame, signal: str) -> Column:
    """What :func:`session_signals` counted inside the session's long pieces."""
    return F.col(f"inside_{signal}") if f"inside_{signal}" in summary.columns else F.lit(0)


def copy_paste_score(summary: DataFrame, phrases: Sequence[str] = tuple(L.COPY_KEYWORDS), patterns: Sequence[str] = tuple(L.NON_NATURAL_PATTERNS), long_chars: int = L.LONG_QUESTION_CHARS) -> Column:
    """SCL6 as a Column over a summary that has ``pooled_prompts`` and
    ``norm_prompts`` (see :func:`text_signals`)."""
    return (
        _image_bonus()
        + (F.col("avg_raw_length") > long_chars).cast("int")
        + X.patterns_count("pooled_prompts", patterns, L.NON_NATURAL_REQUIRED if list(patterns) == L.NON_NATURAL_PATTERNS else None)
        + X.phrases_count("norm_prompts", phrases)
        + _inside(summary, "copy")
    )


def answer_seeking(prompt_phrases: Sequence[str] = tuple(L.ANSWER_SEEKING_KEYWORDS_PROMPT), reply_phrases: Sequence[str] = tuple(L.ANSWER_SEEKING_KEYWORDS_AI)) -> Column:
    """SCL7: prompt phrases + phrases in the normalized first 100 chars of the
    first reply (cut before normalizing) + image bonus."""
    return X.phrases_count("norm_prompts", prompt_phrases) + X.phrases_count("norm_reply", reply_phrases) + _image_bonus()


def understanding(phrases: Sequence[str] = tuple(L.UNDERSTANDING_KEYWORDS_PROMPT), patterns: Sequence[str] = tuple(L.HYPOTHETICAL_PATTERNS)) -> Column:
    """SCL8: understanding phrases (normalized) + hypothetical regexes (raw)."""
    req = L.HYPOTHETICAL_REQUIRED if list(patterns) == L.HYPOTHETICAL_PATTERNS else None
    return X.phrases_count("norm_prompts", phrases) + X.patterns_count("pooled_prompts", patterns, req)


def _own_patterns(lexicon: dict | None) -> bool:
    lx = _lists(lexicon)
    return list(lx["copy_patterns"]) != L.NON_NATURAL_PATTERNS or list(lx["hypothetical"]) != L.HYPOTHETICAL_PATTERNS


def _lists(lexicon: dict | None) -> dict:
    """The six lists of the text signals: a caller's own, or the default."""
    return {
        "copy": tuple(L.COPY_KEYWORDS), "copy_patterns": tuple(L.NON_NATURAL_PATTERNS),
        "answer_prompt": tuple(L.ANSWER_SEEKING_KEYWORDS_PROMPT), "answer_reply": tuple(L.ANSWER_SEEKING_KEYWORDS_AI),
        "understanding": tuple(L.UNDERSTANDING_KEYWORDS_PROMPT), "hypothetical": tuple(L.HYPOTHETICAL_PATTERNS),
        **(lexicon or {}),
    }


def text_signals(summary: DataFrame, only_when: Column | None = None, lexicon: dict | None = None) -> DataFrame:
    """Add copy_paste_score, is_copy_paste, answer_seeking_intensity and
    understanding_signal_strength. ``lexicon`` (UDF2) overrides any of the
    lists: keys copy, copy_patterns, answer_prompt, answer_reply,
    understanding, hypothetical. Normalized texts are computed once in their
    own projection so every phrase count reuses them. With ``only_when``, the
    regex work runs only for rows where it holds (others get null)."""
    gate = (lambda c: F.when(only_when, c)) if only_when is not None else (lambda c: c)
    s = summary.withColumn("norm_prompts", gate(X.normalize("pooled_prompts"))).withColumn(
        "norm_reply", gate(X.normalize(X.truncate("first_ai_reply", L.FIRST_REPLY_CHARS)))
    )
    lx = _lists(lexicon)
    cp = copy_paste_score(s, lx["copy"], lx["copy_patterns"])
    s = s.withColumn("copy_paste_score", gate(cp).cast("double"))
    s = s.withColumn("is_copy_paste", gate((F.col("copy_paste_score") > 0).cast("int")))
    ans = answer_seeking(lx["answer_prompt"], lx["answer_reply"])
    s = s.withColumn("answer_seeking_intensity", gate(ans + _inside(s, "answer")).cast("double"))
    und = understanding(lx["understanding"], lx["hypothetical"])
    s = s.withColumn("understanding_signal_strength", gate(und + _inside(s, "understanding")).cast("double"))
    return s.drop("norm_prompts", "norm_reply")


def class_windows(classes: DataFrame) -> DataFrame:
    """JOIN1 dimension: the first row per class (lowest ``ord``) wins; time
    columns parsed leniently when they are strings."""
    c = classes
    for col in ("start_at", "end_at"):
        if dict(c.dtypes)[col] == "string":
            c = c.withColumn(col, parse_time(col))
    if "ord" not in c.columns:
        c = c.withColumn("ord", F.monotonically_increasing_id())
    return c.groupBy("class_id").agg(
        F.min_by(F.struct("start_at", "end_at"), F.col("ord")).alias("w")
    ).select("class_id", F.col("w.start_at").alias("course_start"), F.col("w.end_at").alias("course_end"))


def schedule_slots(schedule: DataFrame) -> DataFrame:
    """JOIN2 dimension: closed slots ``[open_at, close_at]`` per class. Null or
    reversed bounds never match."""
    s = schedule
    for col in ("open_at", "close_at"):
        if dict(s.dtypes)[col] == "string":
            s = s.withColumn(col, parse_time(col))
    s = s.filter(F.col("open_at").isNotNull() & F.col("close_at").isNotNull() & (F.col("open_at") <= F.col("close_at")))
    return s.filter(F.col("class_id").isNotNull()).select("class_id", "open_at", "close_at")


def merged(slots: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Slots per key merged into disjoint closed intervals (gaps and islands), so
    a time falls in at most one of them."""
    w = Window.partitionBy(*keys).orderBy("open_at", "close_at")
    prev_max = F.max("close_at").over(w.rowsBetween(Window.unboundedPreceding, -1))
    s = slots.withColumn("__new", (prev_max.isNull() | (F.col("open_at") > prev_max)).cast("int"))
    s = s.withColumn("__island", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return s.groupBy(*keys, "__island").agg(F.min("open_at").alias("open_at"), F.max("close_at").alias("close_at")).drop("__island")


def _steps(first: Column, end: Column, step: str) -> Column:
    """Dates from ``first`` up to, not including, ``end``; none where it is not later."""
    last = F.date_sub(end, 1) if step == "DAY" else F.add_months(end, -1 if step == "MONTH" else -12)
    unit = F.expr(f"INTERVAL 1 {step}")
    return F.when(first < end, F.sequence(first, last, unit)).otherwise(F.array().cast("array<date>"))


def calendar_cover(slots: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Closed slots as calendar pieces: the days of their first and last months
    (class_id, piece, open_at, close_at), whole months of their first and last
    years, and whole years between (class_id, piece).

    A slot gives at most 62 days, 22 months and its years, whatever its length.
    Equal pieces of a class are one row, and the intervals of one day are disjoint,
    so no group is larger than what a class has in one day."""
    kind = dict(slots.dtypes)["open_at"]
    day0, day1 = F.to_date("open_at"), F.to_date("close_at")
    c = slots.withColumns({"d0": day0, "dend": F.date_add(day1, 1), "m0": F.add_months(F.trunc(day0, "MM"), 1), "mend": F.trunc(day1, "MM")})
    c = c.withColumn("y0", F.trunc(F.add_months("m0", 11), "YEAR")).withColumn("yend", F.trunc("mend", "YEAR"))
    col = F.col
    far, years = col("m0") < col("mend"), col("y0") < col("yend")
    days = F.when(far, F.concat(_steps(col("d0"), col("m0"), "DAY"), _steps(col("mend"), col("dend"), "DAY"))).otherwise(_steps(col("d0"), col("dend"), "DAY"))
    months = F.when(years, F.concat(_steps(col("m0"), col("y0"), "MONTH"), _steps(col("yend"), col("mend"), "MONTH"))).otherwise(_steps(col("m0"), col("mend"), "MONTH"))
    d = c.select("class_id", F.explode(days).alias("piece"), "open_at", "close_at")
    # cut to the day, so that whole days are equal rows
    d = d.select("class_id", "piece", F.greatest("open_at", col("piece").cast(kind)).alias("open_at"), F.least("close_at", F.date_add("piece", 1).cast(kind)).alias("close_at"))
    return (
        merged(d.distinct(), ["class_id", "piece"]),
        c.select("class_id", F.explode(months).alias("piece")).distinct(),
        c.select("class_id", F.explode(_steps(col("y0"), col("yend"), "YEAR")).alias("piece")).distinct(),
    )


def mark_in_class(turns: DataFrame, schedule: DataFrame, class_col: str = "session_class_id", out: str = "in_slot") -> DataFrame:
    """JOIN2 per turn: ``out`` = 1 when the turn's time is inside a slot of
    ``class_col``'s class. The slots are cut into days (with a range residual),
    whole months and whole years (:func:`calendar_cover`); a turn is looked up by its class and
    its day, month and year, so slots of any length and number meet no turn but
    those of their dates. At most one match per turn and lookup: no fan-out, and
    the flag can be aggregated with the other session aggregates."""
    days, months, years = calendar_cover(schedule_slots(schedule))
    at, cls = F.col("asked_at"), F.col(class_col)
    j = turns.withColumn("__day", F.to_date("asked_at"))
    d = days.toDF("__dc", "__dp", "__o", "__c")
    j = j.join(d, on=(cls == F.col("__dc")) & (F.col("__day") == F.col("__dp")) & (at >= F.col("__o")) & (at <= F.col("__c")), how="left")
    j = j.join(months.toDF("__mc", "__mp"), on=(cls == F.col("__mc")) & (F.trunc("__day", "MM") == F.col("__mp")), how="left")
    j = j.join(years.toDF("__yc", "__yp"), on=(cls == F.col("__yc")) & (F.trunc("__day", "YEAR") == F.col("__yp")), how="left")
    hit = F.coalesce("__dc", "__mc", "__yc").isNotNull()
    return j.withColumn(out, hit.cast("int")).drop("__day", "__dc", "__dp", "__o", "__c", "__mc", "__mp", "__yc", "__yp")


REASON_OK = "ok"


def reject_reason(summary: DataFrame, windows: DataFrame, allowlist: DataFrame | None = None) -> DataFrame:
    """FLT4/FLT5: first failing check wins: any unparsable time ->
    ``invalid_time``; class not in the allowlist (when given and non-empty) ->
    ``filtered_by_class_info``; no class row -> ``no_class``; null start/end
    -> ``bad_window``; session outside ``[start, end]`` -> ``out_of_range``;
    same-day window with end > start (the week length divides by zero) ->
    ``zero_day_window``; else ``ok``."""
    s = summary.join(windows.withColumn("__has_class", F.lit(True)), on="class_id", how="left")
    allowed = F.lit(True)
    if allowlist is not None:
        al = allowlist.select("class_id").distinct().withColumn("__allowed", F.lit(True))
        s = s.join(al, on="class_id", how="left")
        s = attach_one_row(s, allowlist.agg(F.count(F.lit(1)).alias("__n_allowed")))
        allowed = F.col("__allowed").isNotNull() | (F.col("__n_allowed") == 0)
    days_total = F.datediff(F.to_date("course_end"), F.to_date("course_start"))
    reason = (
        F.when(F.col("any_bad_time") == 1, F.lit("invalid_time"))
        .when(~allowed, F.lit("filtered_by_class_info"))
        .when(F.col("__has_class").isNull(), F.lit("no_class"))
        .when(F.col("course_start").isNull() | F.col("course_end").isNull(), F.lit("bad_window"))
        .when((F.col("t_min") < F.col("course_start")) | (F.col("t_max") > F.col("course_end")), F.lit("out_of_range"))
        .when((F.col("course_end") > F.col("course_start")) & (days_total == 0), F.lit("zero_day_window"))
        .otherwise(F.lit(REASON_OK))
    )
    return s.withColumn("reject_reason", reason).drop(*[c for c in ("__has_class", "__allowed", "__n_allowed") if c in s.columns])


def temporal(df: DataFrame, total_weeks: int = L.TOTAL_WEEKS, exam_days: int = L.EXAM_WINDOW_DAYS, day_start_hour: int = L.DAY_START_HOUR) -> DataFrame:
    """SCL9-11 on sessions with ``t_min``, ``course_start``, ``course_end``:
    course_progress_ratio (Python float floor-division semantics, clamped to
    1..total_weeks; 1 when end <= start), is_exam_week, day_period, dialog_time."""
    start, end, t0 = F.col("course_start"), F.col("course_end"), F.col("t_min")
    days_total = F.datediff(F.to_date(end), F.to_date(start)).cast("double")
    w = days_total / F.lit(float(total_weeks))
    d = F.datediff(F.to_date(t0), F.to_date(start)).cast("double")
    floordiv = F.round((d - d % w) / w, 0)
    week = F.least(F.lit(total_weeks), F.greatest(F.lit(1), (floordiv + 1).cast("int")))
    progress = F.when((end > start) & (days_total > 0), week).otherwise(F.lit(1))
    exam = F.when(end.isNotNull(), ((t0 >= end - F.expr(f"INTERVAL {exam_days} DAYS")) & (t0 <= end)).cast("int")).otherwise(F.lit(0))
    period = F.pmod(F.hour(t0) - F.lit(day_start_hour), F.lit(24)) + 1
    return (
        df.withColumn("course_progress_ratio", progress.cast("int"))
        .withColumn("is_exam_week", exam.cast("int"))
        .withColumn("day_period", period.cast("int"))
        .withColumn("dialog_time", F.date_format(t0, "yyyy-MM-dd HH:mm:ss"))
    )


def finite_or_zero(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """FLT6: non-finite (null, NaN, +-Inf) -> 0.0 on the given columns."""
    out = df
    for c in cols:
        out = out.withColumn(c, F.when(is_finite(c), F.col(c)).otherwise(F.lit(0.0)).cast(dict(df.dtypes)[c]))
    return out


def coerce_numeric(df: DataFrame, cols: Sequence[str], dtype: str = "double") -> DataFrame:
    """FLT14: numeric coercion, unparsable -> 0."""
    out = df
    for c in cols:
        out = out.withColumn(c, F.coalesce(F.col(c).cast("string").try_cast(dtype), F.lit(0).cast(dtype)))
    return out


def extract(
    turns: DataFrame,
    classes: DataFrame,
    schedule: DataFrame,
    allowlist: DataFrame | None = None,
    lexicon: dict | None = None,
) -> DataFrame:
    """E2 without post-processing: one row per session with ``reject_reason``
    and the 10 features (features are null unless the reason is ``ok``)."""
    keys = session_keys(turns)
    # the session's class (its first turn's) is checked against every turn;
    # segment() carries it as session_class_id in the same pass
    if "session_class_id" not in turns.columns:
        first_class = turns.groupBy(*keys).agg(_first("class_id").alias("session_class_id"))
        turns = turns.join(first_class, on=keys, how="inner")
    summary = session_signals(mark_in_class(turns, schedule, "session_class_id"), lexicon)
    s = reject_reason(behavioral(summary), class_windows(classes), allowlist)
    ok = F.col("reject_reason") == REASON_OK
    s = text_signals(s, only_when=ok, lexicon=lexicon)
    s = temporal(s)
    s = s.withColumn("is_in_class_time", F.coalesce(F.col("is_in_class_time"), F.lit(0)).cast("int"))
    s = finite_or_zero(s, ["avg_qa_time_minutes", "avg_question_length"])
    file_name = F.concat_ws("_", *[F.col(k).cast("string") for k in keys])
    return s.select(
        *keys,
        file_name.alias("file_name"),
        "class_id",
        "dialog_time",
        F.col("qa_turns").cast("int").alias("qa_turns"),
        *[F.when(ok, F.col(c)).alias(c) for c in L.FEATURE_COLUMNS[1:]],
        "is_copy_paste",
        "reject_reason",
        "t_min",
        "t_max",
    )


def impute_single_turn(features: DataFrame, class_col: str = "class_id") -> DataFrame:
    """AGG15-17: single-turn sessions get avg_qa_time_minutes =
    coalesce(class median over 2-turn sessions, global 2-turn median, global
    3-turn median) / 3; unchanged when both global medians are null."""
    f = coerce_numeric(features, ["avg_qa_time_minutes"], "double")
    f = f.withColumn("qa_turns", F.coalesce(F.col("qa_turns").cast("string").try_cast("int"), F.lit(0)))
    from .stats import exact_quantiles

    two = F.col("qa_turns") == 2
    # a null class is no class: its sessions fall back to the global medians
    class_med = exact_quantiles(f.filter(two & F.col(class_col).isNotNull()), "avg_qa_time_minutes", [class_col]).select(
        class_col, F.col("value").alias("class_2turn_median"))
    glob = exact_quantiles(f.filter(F.col("qa_turns").isin(2, 3)), "avg_qa_time_minutes", ["qa_turns"]) \
        .groupBy().pivot("qa_turns", [2, 3]).agg(F.first("value")) \
        .select(F.col("2").alias("global_2turn_median"), F.col("3").alias("global_3turn_median"))
    j = attach_one_row(f.join(class_med, on=class_col, how="left"), glob)
    fill = F.coalesce(F.col("class_2turn_median"), F.col("global_2turn_median"), F.col("global_3turn_median")) / 3
    any_global = F.col("global_2turn_median").isNotNull() | F.col("global_3turn_median").isNotNull()
    out = j.withColumn(
        "avg_qa_time_minutes",
        F.when((F.col("qa_turns") == 1) & any_global, fill).otherwise(F.col("avg_qa_time_minutes")),
    )
    return out.drop("class_2turn_median", "global_2turn_median", "global_3turn_median")


def log1p_features(df: DataFrame, cols: Sequence[str] = tuple(L.LOG_FEATURES)) -> DataFrame:
    """FLT8: log1p on the skewed features present in ``df``."""
    out = df
    for c in cols:
        if c in out.columns:
            out = out.withColumn(c, F.log1p(F.col(c).cast("double")))
    return out


def high_understanding(features_raw: DataFrame, threshold: float = L.HIGH_UNDERSTANDING) -> DataFrame:
    """SNK5 re-aimed: sessions whose raw understanding score exceeds the
    threshold, with the score-tagged name ``score_%.2f_<file_name>``."""
    return features_raw.filter(F.col("understanding_signal_strength") > threshold).withColumn(
        "tagged_name", F.format_string("score_%.2f_%s", F.col("understanding_signal_strength"), F.col("file_name"))
    )


FILE_REASONS = ["empty", "missing_columns", "missing_class", "missing_student"]


def reject_stats(extracted: DataFrame, file_rejects: DataFrame | None = None) -> DataFrame:
    """AGG18: counters and ratios of the reject cascade as one row.
    ``file_rejects`` (a column ``reason``, see ``sources.io.rejected_files``) adds
    the files that were rejected as a whole; ``failed`` counts those without a
    class column, and ``fail_ratio`` is (out of range + failed) / total.
    ``reject_ratio`` is the true share of rejected sessions and files."""
    r = F.col("reject_reason")
    rows = extracted.select("reject_reason")
    if file_rejects is not None:
        rows = rows.unionByName(file_rejects.select(F.concat(F.lit("file_"), F.col("reason")).alias("reject_reason")))
    return rows.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(r == REASON_OK).alias("processed"),
        F.count_if(r == "out_of_range").alias("out_of_range"),
        F.count_if(r == "no_class").alias("no_class"),
        F.count_if(r == "bad_window").alias("bad_window"),
        F.count_if(r == "invalid_time").alias("invalid_time"),
        F.count_if(r == "zero_day_window").alias("zero_day_window"),
        F.count_if(r == "filtered_by_class_info").alias("filtered_by_class_info"),
        F.count_if(r == "file_empty").alias("empty_files"),
        F.count_if(r == "file_missing_columns").alias("missing_columns"),
        F.count_if(r == "file_missing_class").alias("failed"),
        F.count_if(r == "file_missing_student").alias("missing_student"),
    ).select(
        "*",
        (F.col("processed") / F.col("total")).alias("success_ratio"),
        (F.col("out_of_range") / F.col("total")).alias("out_of_range_ratio"),
        ((F.col("out_of_range") + F.col("failed")) / F.col("total")).alias("fail_ratio"),
        ((F.col("total") - F.col("processed")) / F.col("total")).alias("reject_ratio"),
    )


def session_features(
    turns: DataFrame,
    classes: DataFrame,
    schedule: DataFrame,
    allowlist: DataFrame | None = None,
    log_transform: bool = True,
    materialize: bool = True,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Full E2: extract, keep ``ok`` sessions, single-turn imputation, log1p.

    ``columns`` names the features that are wanted (default: all); the others,
    and the text work behind them, are not computed. With ``materialize`` the
    accepted sessions are checkpointed to the shared folder
    (``spark.checkpoint.dir``) before the imputation statistics, which read them
    several times, and the imputed table is checkpointed for its readers."""
    ext = extract(turns, classes, schedule, allowlist)
    ok = ext.filter(F.col("reject_reason") == REASON_OK).drop("reject_reason")
    if columns is not None:
        base = [*session_keys(turns), "file_name", "class_id", "dialog_time", "qa_turns", "avg_qa_time_minutes"]
        ok = ok.select(*base, *[c for c in columns if c not in base])
    if materialize:
        from ..session import ensure_checkpoint_dir

        ensure_checkpoint_dir(ok.sparkSession)
        ok = ok.checkpoint(eager=True)
    imp = impute_single_turn(ok)
    if materialize:
        imp = imp.checkpoint(eager=True)
    return log1p_features(imp) if log_transform else imp
