"""Fixed values that must equal the original analysis for identical results.

Everything in this module is data, not logic: phrase lists, regex patterns,
feature names and state labels. Patterns are written once in a dialect that
Java regex (Spark) and RE2 (DuckDB, used by the SQL oracle) read the same way
as Python's Unicode ``re`` module:

* ``\\s`` is spelled out as :data:`WS` (Python's Unicode whitespace set,
  derived by rule from ``str.isspace``), because Java and RE2 default to ASCII.
* ``\\d`` is ``\\p{Nd}`` (Python's ``\\d`` is the Unicode decimal category).
* ``.`` is ``[^\\n]`` (Python's dot stops only at ``\\n``).
* ``\\b`` after a word is ``(?:[^\\p{L}\\p{N}_]|$)`` (only used in existence
  tests, so consuming the boundary character is harmless).

Users can pass their own lists to the feature operators; these are defaults.
"""

from __future__ import annotations

import sys


def _whitespace_class() -> str:
    """Character class equal to Python's ``\\s`` for ``str`` patterns.

    Built from ``str.isspace`` (a rule), then collapsed into ranges.
    """
    cps = [c for c in range(sys.maxunicode + 1) if chr(c).isspace()]
    parts, start, prev = [], cps[0], cps[0]
    for c in cps[1:] + [-1]:
        if c == prev + 1:
            prev = c
            continue
        parts.append(f"\\x{{{start:x}}}" if start == prev else f"\\x{{{start:x}}}-\\x{{{prev:x}}}")
        start = prev = c
    return "[" + "".join(parts) + "]"


WS = _whitespace_class()
# The same set in Java's own syntax (Unicode White_Space plus U+001C..U+001F),
# which Java evaluates much faster than the spelled-out class; Spark patterns
# use it, the RE2 oracle uses WS. tests/test_text.py checks both are equal
# over every code point.
WS_JAVA = r"(?U:[\s\x1c-\x1f])"
DIGIT = r"\p{Nd}"
NOT_WORD = r"(?:[^\p{L}\p{N}_]|$)"

# Full-width ASCII block U+FF01..U+FF5E maps to U+0021..U+007E (offset 0xFEE0),
# and the ideographic space U+3000 maps to a plain space. Built by rule.
FULLWIDTH_FROM = "".join(chr(c) for c in range(0xFF01, 0xFF5F)) + "　"
FULLWIDTH_TO = "".join(chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)) + " "
# Every whitespace character (str.isspace), for single-pass deletion.
WS_CHARS = "".join(chr(c) for c in range(sys.maxunicode + 1) if chr(c).isspace())

# --------------------------------------------------------------------------
# FIXED VALUES (must match the original analysis exactly; natural order)
# --------------------------------------------------------------------------

# Phrases counted on the normalized pooled prompts for copy_paste_score.
COPY_KEYWORDS = [
    "如下", "如上", "这道题", "怎么做", "哪里错了",
    "A.", "B.", "C.", "D.",
    "做一下", "怎么写", "选什么", "解一下", "咋做", "答案", "结果", "求解",
    "解答", "回答", "解题", "单选题", "多选题",
    "描述错误的是", "描述正确的是", "回答下列问题", "a.", "b.", "c.", "d.",
    "有什么作用", "请上传你的文件", "please upload the file",
]

# Phrases counted on the normalized pooled prompts for answer_seeking_intensity.
ANSWER_SEEKING_KEYWORDS_PROMPT = [
    "答案", "选什么", "选哪个", "做一下", "解一下", "求解", "答案是什么",
    "帮我做", "直接告诉我", "怎么选", "结果是", "最终结果", "帮我算",
    "正确答案", "标准答案", "给我答案",
]

# Phrases counted on the normalized first 100 characters of the first AI reply.
ANSWER_SEEKING_KEYWORDS_AI = [
    "题目", "练习题", "习题", "选择题", "多选题", "单选题", "填空题",
    "这道题", "这题", "答案", "选项", "正确答案", "应该选",
]

# Phrases counted on the normalized pooled prompts for understanding_signal_strength.
UNDERSTANDING_KEYWORDS_PROMPT = [
    "为什么", "为啥", "怎么会", "原因", "机制", "如何理解", "怎么理解",
    "我的理解是", "我觉得", "是不是", "是因为", "区别", "不同",
    "相比", "比较", "有什么联系", "关系",
    "我尝试", "我试过", "关键在于", "核心是", "本质",
    "如果", "那如果", "会怎样", "会不会",
]

# Regexes counted on the raw pooled prompts for copy_paste_score. Original
# (Python) forms: \d+[\.、]\s*[A-D选项] ; [（\(]\s*\d+\s*分\s*[）\)] ; ``` ;
# _{3,} ; \[\s*\] ; [A-D][\.、)]\s*[^\n]{1,50}\s*[A-D][\.、)]
NON_NATURAL_PATTERNS = [
    DIGIT + r"+[\.、]" + WS + r"*[A-D选项]",
    r"[（\(]" + WS + "*" + DIGIT + "+" + WS + "*分" + WS + r"*[）\)]",
    r"```",
    r"_{3,}",
    r"\[" + WS + r"*\]",
    r"[A-D][\.、)]" + WS + r"*[^\n]{1,50}" + WS + r"*[A-D][\.、)]",
]

# Literals every match of the pattern above (same position in the list) must
# contain; a text without them cannot match, so the regex is skipped.
NON_NATURAL_REQUIRED = [[], ["分"], ["```"], ["___"], ["[", "]"], []]

# Regexes counted on the raw pooled prompts for understanding_signal_strength.
# Original forms: 如果.*会 ; 那如果 ; 可以.*吗
HYPOTHETICAL_PATTERNS = [r"如果[^\n]*会", r"那如果", r"可以[^\n]*吗"]
HYPOTHETICAL_REQUIRED = [["如果", "会"], ["那如果"], ["可以", "吗"]]

# Image predicate, per turn. Original form: !\[.*?\]\(.*?\)|<img\b
IMAGE_PATTERN = r"!\[[^\n]*?\]\([^\n]*?\)|<img" + NOT_WORD

# Entry values that mark a confusion entry.
CONFUSION_ENTRIES = ["课堂不懂", "课件不懂", "习题不懂"]

# Cleaning steps of the question-length feature, applied in this order.
# Original forms: !\[[^\]]*?\]\([^\)]*?\) ; 请上传你的文件（Please upload the file）(ignore case) ;
# (?:Notice|注意)[:：].*?(?=$|\n) (ignore case, dotall) ; <img\b[^>]*> (ignore case) ; \s+ -> ' '
UPLOAD_BOILERPLATE = "请上传你的文件（Please upload the file）"
QUESTION_CLEAN_STEPS = [
    (r"!\[[^\]]*?\]\([^\)]*?\)", ""),
    ("(?i)" + UPLOAD_BOILERPLATE.replace("(", r"\(").replace(")", r"\)"), ""),
    (r"(?i)(?:Notice|注意)[:：][^\n]*", ""),
    (r"(?i)<img(?:[^\p{L}\p{N}_>][^>]*)?>", ""),
    (WS + "+", " "),
]
# Literals a match of each cleaning step must contain (any of the listed,
# compared case-insensitively for (?i) steps); None: always run. Step 2 also
# needs a colon (":" or "："), checked first because it is cheap.
QUESTION_CLEAN_REQUIRED = [["!["], ["请上传你的文件"], ["注意", "notice"], ["<"], None]
QUESTION_CLEAN_PRECHECK = [None, None, [":", "："], None, None]
IMAGE_REQUIRED = ["![", "<img"]

# Session feature columns, in their canonical order.
FEATURE_COLUMNS = [
    "qa_turns", "avg_qa_time_minutes", "avg_question_length",
    "copy_paste_score", "answer_seeking_intensity", "understanding_signal_strength",
    "course_progress_ratio", "is_exam_week", "day_period", "is_in_class_time",
]

# Features transformed with log1p after imputation.
LOG_FEATURES = [
    "avg_qa_time_minutes", "avg_question_length", "copy_paste_score",
    "answer_seeking_intensity", "understanding_signal_strength", "qa_turns",
]

# Columns skipped by the class-median fill.
CLASS_FILL_SKIP = ["total_time_minutes", "avg_qa_time_minutes"]

# Markov states and their display labels.
STATES = ["START", "c0", "c1", "c2", "c3", "END"]
STATE_LABELS = {
    "START": "START",
    "c0": "Deep Engagement",
    "c1": "Shallow Engagement",
    "c2": "Routine-Learning Engagement",
    "c3": "Exam-Driven Engagement",
    "END": "END",
}

# Stability labels by mean ARI.
STABILITY_HIGH, STABILITY_MODERATE = 0.8, 0.5

# Defaults of the analysis.
GAP_MINUTES = 15
TOTAL_WEEKS = 20
EXAM_WINDOW_DAYS = 28
DAY_START_HOUR = 8
HISTOGRAM_BINS = 50
RANDOM_STATE = 42
N_INIT = 10
MAX_K = 10
VARIANCE_THRESHOLD = 0.8
STABILITY_ITERATIONS = 50
PAYLOAD_TEXT_CHARS = 500
FIRST_REPLY_CHARS = 100
HIGH_UNDERSTANDING = 10
LONG_QUESTION_CHARS = 500
