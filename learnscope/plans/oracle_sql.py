"""DuckDB SQL texts used as the independent oracle for ``queries()``.

Each builder returns a ``WITH ...`` CTE list or a full query over the driver's
pre-registered tables. Phrase lists and patterns come from the same lexicon
module as the Spark expressions, so both engines test the same constants;
the computation itself is written independently in SQL.
"""

from __future__ import annotations

from ..fixtures import view_sql
from ..functions import lexicon as L


def q(s: str) -> str:
    """SQL string literal (DuckDB: backslashes are literal)."""
    return "'" + s.replace("'", "''") + "'"


# ---------------------------------------------------------------- scalars

def normalize(x: str) -> str:
    return f"regexp_replace(translate(coalesce({x}, ''), {q(L.FULLWIDTH_FROM)}, {q(L.FULLWIDTH_TO)}), {q(L.WS + '+')}, '', 'g')"


def phrase_count(x: str, kw: str) -> str:
    return f"((length({x}) - length(replace({x}, {q(kw)}, ''))) // {len(kw)})"


def phrases_count(x: str, kws) -> str:
    return "(" + " + ".join(phrase_count(x, k) for k in kws) + ")"


def pattern_count(x: str, p: str) -> str:
    return f"len(regexp_extract_all(coalesce({x}, ''), {q(p)}))"


def patterns_count(x: str, ps) -> str:
    return "(" + " + ".join(pattern_count(x, p) for p in ps) + ")"


def question_length(x: str) -> str:
    s = x
    for pat, rep in L.QUESTION_CLEAN_STEPS:
        s = f"regexp_replace({s}, {q(pat)}, {q(rep)}, 'g')"
    return f"CAST(coalesce(length(trim({s})), 0) AS INTEGER)"


def has_image(x: str) -> str:
    return f"coalesce(regexp_matches({x}, {q(L.IMAGE_PATTERN)}), false)"


def confusion(x: str) -> str:
    return f"coalesce({x} IN ({', '.join(q(e) for e in L.CONFUSION_ENTRIES)}), false)"


# ---------------------------------------------------------------- views

def views(*names: str) -> list[str]:
    return [f"{n} AS ({view_sql(n, 'duckdb')})" for n in names]


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def seg_cte(name: str = "seg", src: str = "turns", gap: float | None = 15, entry: bool = True, col: str = "session_index") -> str:
    """Sessionization: flag a new session, running sum per student."""
    conds = ["prev_at IS NULL"]
    if entry:
        conds.append("coalesce(entry, '') <> coalesce(prev_entry, '')")
    if gap is not None:
        conds.append(f"date_diff('microsecond', prev_at, asked_at) > {int(round(gap * 60_000_000))}")
    flag = " OR ".join(conds)
    return f"""{name}_flags AS (
  SELECT *, lag(asked_at) OVER w AS prev_at, lag(entry) OVER w AS prev_entry
  FROM {src} WINDOW w AS (PARTITION BY student_id ORDER BY asked_at, turn_id)
),
{name} AS (
  SELECT * EXCLUDE (prev_at, prev_entry), CAST(CASE WHEN {flag} THEN 1 ELSE 0 END AS INTEGER) AS is_new_session,
    CAST(sum(CASE WHEN {flag} THEN 1 ELSE 0 END) OVER (PARTITION BY student_id ORDER BY asked_at, turn_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS INTEGER) AS {col}
  FROM {name}_flags
)"""


def summary_cte(src: str = "seg", name: str = "summary") -> str:
    return f"""{name} AS (
  SELECT student_id, session_index, count(*) AS qa_turns, min(asked_at) AS t_min, max(asked_at) AS t_max,
    first(class_id ORDER BY asked_at, turn_id) AS class_id,
    avg({question_length('question_text')}) AS avg_question_length,
    avg(length(coalesce(question_text, ''))) AS avg_raw_length,
    max(CASE WHEN {has_image("coalesce(question_text, '')")} THEN 1 ELSE 0 END) AS has_image,
    max(CASE WHEN {confusion('entry')} THEN 1 ELSE 0 END) AS is_confusion_entry,
    string_agg(coalesce(question_text, ''), ' ' ORDER BY asked_at, turn_id) AS pooled_prompts,
    coalesce(first(ai_response ORDER BY asked_at, turn_id), '') AS first_ai_reply
  FROM {src} GROUP BY student_id, session_index
)"""


def behavioral_cte(src: str = "summary", name: str = "behav") -> str:
    return f"""{name} AS (
  SELECT *, CASE WHEN qa_turns > 1 AND date_diff('microsecond', t_min, t_max) > 0
    THEN (date_diff('microsecond', t_min, t_max) / 60000000.0) / (qa_turns - 1) ELSE 0.0 END AS avg_qa_time_minutes
  FROM {src}
)"""


def signals_cte(src: str = "behav", name: str = "sig", lexicon: dict | None = None) -> str:
    lx = {"copy": L.COPY_KEYWORDS, "copy_patterns": L.NON_NATURAL_PATTERNS, "answer_prompt": L.ANSWER_SEEKING_KEYWORDS_PROMPT,
          "answer_reply": L.ANSWER_SEEKING_KEYWORDS_AI, "understanding": L.UNDERSTANDING_KEYWORDS_PROMPT, "hypothetical": L.HYPOTHETICAL_PATTERNS, **(lexicon or {})}
    img = "(CASE WHEN has_image = 1 AND is_confusion_entry = 0 THEN 1 ELSE 0 END)"
    return f"""{name}_n AS (
  SELECT *, {normalize('pooled_prompts')} AS norm_prompts,
    {normalize("substr(first_ai_reply, 1, " + str(L.FIRST_REPLY_CHARS) + ")")} AS norm_reply
  FROM {src}
),
{name} AS (
  SELECT * EXCLUDE (norm_prompts, norm_reply),
    CAST({img} + (CASE WHEN avg_raw_length > {L.LONG_QUESTION_CHARS} THEN 1 ELSE 0 END)
      + {patterns_count('pooled_prompts', lx['copy_patterns'])} + {phrases_count('norm_prompts', lx['copy'])} AS DOUBLE) AS copy_paste_score,
    CAST({phrases_count('norm_prompts', lx['answer_prompt'])} + {phrases_count('norm_reply', lx['answer_reply'])} + {img} AS DOUBLE) AS answer_seeking_intensity,
    CAST({phrases_count('norm_prompts', lx['understanding'])} + {patterns_count('pooled_prompts', lx['hypothetical'])} AS DOUBLE) AS understanding_signal_strength
  FROM {name}_n
)"""


def windows_cte(src: str = "classes", name: str = "windows") -> str:
    return f"""{name} AS (
  SELECT class_id, arg_min({{'s': start_at, 'e': end_at}}, ord).s AS course_start, arg_min({{'s': start_at, 'e': end_at}}, ord).e AS course_end
  FROM {src} GROUP BY class_id
)"""


def reasons_cte(src: str = "sig", name: str = "reasons", allow: str | None = None) -> str:
    allow_cond = f"WHEN s.class_id NOT IN (SELECT class_id FROM {allow}) THEN 'filtered_by_class_info'" if allow else ""
    return f"""{name} AS (
  SELECT s.*, w.course_start, w.course_end,
    CASE WHEN false THEN 'invalid_time' {allow_cond}
      WHEN w.class_id IS NULL THEN 'no_class'
      WHEN w.course_start IS NULL OR w.course_end IS NULL THEN 'bad_window'
      WHEN s.t_min < w.course_start OR s.t_max > w.course_end THEN 'out_of_range'
      WHEN w.course_end > w.course_start AND date_diff('day', CAST(w.course_start AS DATE), CAST(w.course_end AS DATE)) = 0 THEN 'zero_day_window'
      ELSE 'ok' END AS reject_reason
  FROM {src} s LEFT JOIN windows w ON s.class_id = w.class_id
)"""


def inclass_cte(seg: str = "seg", summary: str = "summary", name: str = "inclass") -> str:
    return f"""{name} AS (
  SELECT DISTINCT t.student_id, t.session_index, 1 AS is_in_class_time
  FROM {seg} t JOIN {summary} m ON t.student_id = m.student_id AND t.session_index = m.session_index
  JOIN schedule sc ON sc.class_id = m.class_id AND t.asked_at >= sc.open_at AND t.asked_at <= sc.close_at
  WHERE sc.open_at IS NOT NULL AND sc.close_at IS NOT NULL
)"""


def temporal_cols(t: str = "t_min") -> str:
    days_total = "CAST(date_diff('day', CAST(course_start AS DATE), CAST(course_end AS DATE)) AS DOUBLE)"
    w = f"({days_total} / {float(L.TOTAL_WEEKS)})"
    d = f"CAST(date_diff('day', CAST(course_start AS DATE), CAST({t} AS DATE)) AS DOUBLE)"
    floordiv = f"round(({d} - {d} % {w}) / {w})"
    week = f"least({L.TOTAL_WEEKS}, greatest(1, CAST({floordiv} + 1 AS INTEGER)))"
    return f"""CAST(CASE WHEN course_end > course_start AND {days_total} > 0 THEN {week} ELSE 1 END AS INTEGER) AS course_progress_ratio,
    CAST(CASE WHEN {t} >= course_end - INTERVAL {L.EXAM_WINDOW_DAYS} DAY AND {t} <= course_end THEN 1 ELSE 0 END AS INTEGER) AS is_exam_week,
    CAST(((hour({t}) - {L.DAY_START_HOUR}) % 24 + 24) % 24 + 1 AS INTEGER) AS day_period,
    strftime({t}, '%Y-%m-%d %H:%M:%S') AS dialog_time"""


def features_ctes(gap: float | None = 720, entry: bool = True, allow: str | None = None) -> list[str]:
    """turns -> sessions -> summary -> signals -> reasons -> features (all
    sessions, features null unless ok) as CTE ``feat``."""
    feats = ", ".join(
        f"CASE WHEN reject_reason = 'ok' THEN {c} END AS {c}" for c in L.FEATURE_COLUMNS[1:]
    )
    return [
        *views("turns", "classes", "schedule"),
        seg_cte("seg", "turns", gap=gap, entry=entry),
        summary_cte("seg"),
        behavioral_cte("summary"),
        signals_cte("behav"),
        windows_cte("classes"),
        reasons_cte("sig", allow=allow),
        inclass_cte("seg", "summary"),
        f"""feat_t AS (
  SELECT r.*, {temporal_cols()}, CAST(coalesce(i.is_in_class_time, 0) AS INTEGER) AS is_in_class_time
  FROM reasons r LEFT JOIN inclass i ON r.student_id = i.student_id AND r.session_index = i.session_index
)""",
        f"""feat AS (
  SELECT student_id, session_index, concat_ws('_', CAST(student_id AS VARCHAR), CAST(session_index AS VARCHAR)) AS file_name,
    class_id, dialog_time, CAST(qa_turns AS INTEGER) AS qa_turns, {feats}, reject_reason
  FROM feat_t
)""",
    ]


def imputed_ctes(src: str = "feat") -> list[str]:
    """Single-turn imputation over ok sessions -> CTE ``imp``."""
    return [
        f"""okf AS (SELECT * EXCLUDE (reject_reason) FROM {src} WHERE reject_reason = 'ok')""",
        """cmed AS (SELECT class_id, median(avg_qa_time_minutes) AS class_2turn_median FROM okf WHERE qa_turns = 2 GROUP BY class_id)""",
        """gmed AS (SELECT median(avg_qa_time_minutes) FILTER (WHERE qa_turns = 2) AS g2, median(avg_qa_time_minutes) FILTER (WHERE qa_turns = 3) AS g3 FROM okf)""",
        """imp AS (
  SELECT o.* REPLACE (CASE WHEN o.qa_turns = 1 AND (g.g2 IS NOT NULL OR g.g3 IS NOT NULL)
    THEN coalesce(c.class_2turn_median, g.g2, g.g3) / 3 ELSE o.avg_qa_time_minutes END AS avg_qa_time_minutes)
  FROM okf o LEFT JOIN cmed c ON o.class_id = c.class_id CROSS JOIN gmed g
)""",
    ]


def logged_cte(src: str = "imp", name: str = "logged") -> str:
    rep = ", ".join(f"ln(1 + CAST({c} AS DOUBLE)) AS {c}" for c in L.LOG_FEATURES)
    return f"{name} AS (SELECT * REPLACE ({rep}) FROM {src})"


def edges_cte(ranges: str, bins: int, name: str = "edges") -> str:
    """Histogram bins as rows with their edges [e0, e1), from (keys..., lo, hi)."""
    return f"""{name} AS (
  SELECT *, lo + bin * ((hi - lo) / {bins}.0) AS e0, CASE WHEN bin = {bins - 1} THEN hi ELSE lo + (bin + 1) * ((hi - lo) / {bins}.0) END AS e1
  FROM {ranges} CROSS JOIN (SELECT CAST(unnest(range(0, {bins})) AS INTEGER) AS bin)
)"""
