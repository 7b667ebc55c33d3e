"""Text scalar functions as Spark Column expressions.

All functions take and return :class:`pyspark.sql.Column`. Phrase lists are Python
parameters that *generate* expressions. Whole texts of many turns are measured in
Arrow batches (:mod:`.measures`), which is several times as fast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import lexicon as L
from . import measures as M


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def java_pattern(pattern: str) -> str:
    """A lexicon pattern in the form Spark (Java regex) runs fastest: the
    spelled-out whitespace class becomes Java's equivalent Unicode class."""
    return pattern.replace(L.WS, L.WS_JAVA)


def question_length(text: Column | str) -> Column:
    """SCL1: length of a question after removing images, upload boilerplate,
    ``Notice:`` lines and ``<img>`` tags, collapsing whitespace and trimming.
    Counts code points; null gives 0. (Column form; see
    :func:`with_question_length` for the faster DataFrame form.)"""
    s = _c(text)
    for pattern, repl in L.QUESTION_CLEAN_STEPS:
        s = F.regexp_replace(s, F.lit(java_pattern(pattern)), F.lit(repl))
    return F.coalesce(F.length(F.trim(s)), F.lit(0)).cast("int")


def with_question_length(df, text: str, out: str):
    """SCL1 as one Arrow pass (:func:`.measures.cleaned_length`), several times as
    fast as the Column form."""
    return df.withColumn(out, M.per_text(M.cleaned_length, "int", text))


def _contains_any(s: Column, literals: Sequence[str]) -> Column:
    cond = F.lit(False)
    for lit in literals:
        cond = cond | (F.instr(s, lit) > 0)
    return cond


def _contains_all(s: Column, literals: Sequence[str]) -> Column:
    cond = F.lit(True)
    for lit in literals:
        cond = cond & (F.instr(s, lit) > 0)
    return cond


def normalize(text: Column | str) -> Column:
    """SCL2: full-width ASCII to half-width, ideographic space to space, then
    delete every whitespace character. Null gives ''."""
    # one translate pass: full-width forms map to ASCII (never whitespace), and
    # every whitespace character (incl. U+3000, whose mapped space would be
    # removed anyway) has no counterpart, so it is deleted
    frm = L.FULLWIDTH_FROM[:-1] + L.WS_CHARS
    return F.translate(F.coalesce(_c(text), F.lit("")), frm, L.FULLWIDTH_TO[:-1])


def phrase_count(text: Column | str, phrase: str) -> Column:
    """SCL3: non-overlapping occurrences of a literal phrase (``str.count``).

    ``replace`` removes exactly the leftmost non-overlapping occurrences, so
    the length difference divided by the phrase length is the count."""
    if not phrase:
        raise ValueError("empty phrase")
    s = _c(text)
    # byte lengths: O(1) on Spark strings, and removing k copies removes
    # exactly k * bytes(phrase) bytes; replace() returns early when absent
    removed = F.octet_length(s) - F.octet_length(F.replace(s, F.lit(phrase), F.lit("")))
    return F.coalesce((removed / F.lit(len(phrase.encode("utf-8")))).cast("int"), F.lit(0))


def phrases_count(text: Column | str, phrases: Sequence[str]) -> Column:
    """Sum of :func:`phrase_count` over a list (nested phrases count twice,
    as in the original)."""
    total = F.lit(0)
    for p in phrases:
        total = total + phrase_count(text, p)
    return total


def pattern_count(text: Column | str, pattern: str, required: Sequence[str] = ()) -> Column:
    """SCL4: number of non-overlapping regex matches. ``required``: literals
    every match contains; texts lacking one skip the regex (count 0)."""
    s = F.coalesce(_c(text), F.lit(""))
    n = F.regexp_count(s, F.lit(java_pattern(pattern))).cast("int")
    return F.when(_contains_all(s, required), n).otherwise(F.lit(0)) if required else n


def patterns_count(text: Column | str, patterns: Sequence[str], required: Sequence[Sequence[str]] | None = None) -> Column:
    total = F.lit(0)
    for i, p in enumerate(patterns):
        total = total + pattern_count(text, p, required[i] if required else ())
    return total


def has_image(text: Column | str) -> Column:
    """SCL5: markdown image or ``<img`` tag present (case-sensitive)."""
    s = _c(text)
    return F.coalesce(_contains_any(s, L.IMAGE_REQUIRED) & s.rlike(L.IMAGE_PATTERN), F.lit(False))


def is_confusion_entry(entry: Column | str, entries: Sequence[str] = tuple(L.CONFUSION_ENTRIES)) -> Column:
    return F.coalesce(_c(entry).isin(list(entries)), F.lit(False))


def truncate(text: Column | str, n: int) -> Column:
    """First ``n`` code points (Python ``s[:n]``)."""
    return F.substring(F.coalesce(_c(text), F.lit("")), 1, n)


def ordered_concat(value: Column | str, *order: Column | str, sep: str = " ") -> Column:
    """AGG10: aggregate that joins ``value`` in the order of ``order`` with ``sep``.

    Use inside ``groupBy().agg``. The sort key is carried in a struct, so ties
    are broken by the later order columns (pass a unique tie-breaker last)."""
    keyed = F.struct(*[_c(o).alias(f"k{i}") for i, o in enumerate(order)], _c(value).alias("v"))
    sorted_ = F.array_sort(F.collect_list(keyed))
    return F.array_join(F.transform(sorted_, lambda x: F.coalesce(x["v"], F.lit(""))), sep)


EDGE_CHARS, EDGE_SEARCH = M.EDGE_CHARS, M.EDGE_SEARCH
_NO_LABEL = r"(?:(?![A-D][\.、)])[\s\S])"


def _gap(phrases: Sequence[str]) -> str:
    """Where an edge may end: two plain characters (in no pattern but the one of option
    labels, and in none of its labels) further apart than that pattern spans, without
    a label between. No match reaches over both, and no chain of phrases that
    overlap themselves over one."""
    chained = {c for p in phrases if any(p[:i] == p[-i:] for i in range(1, len(p))) for c in p}
    wide = dict(zip(L.FULLWIDTH_TO, L.FULLWIDTH_FROM))
    own = "".join(f"\\x{{{ord(x):x}}}" for c in sorted(chained) for x in {c, wide.get(c, c)})
    plain = r"[^\s\p{Z}\p{C}\p{Nd}A-D\.、\)\(（）分选项\[\]_`如果会可以吗那" + own + "]"
    return plain + _NO_LABEL + "{51}" + _NO_LABEL + "{0,200}?" + plain


def _hypothetical_gist(s: Column) -> Column:
    """A short text with the same effect on the spanning patterns as ``s``, one line."""
    def words(a: str, b: str) -> Column:
        loose = F.concat(F.when(F.instr(s, b) > 0, b).otherwise(""), F.when(F.instr(s, a) > 0, a).otherwise(""))
        return F.when(s.rlike(f"{a}[^\\n]*{b}"), F.lit(a + b)).otherwise(loose)

    return F.concat(F.lit(" "), words("如果", "会"), F.lit(" "), words("可以", "吗"), F.lit(" "))


def with_edges(df, text: str, out: str, when: Column, phrases: Sequence[str]):
    """``out``: the text, or where ``when`` holds only its edges and the gist of what
    is between, so that for the default patterns and the ``phrases``

        count(t1 + " " + t2 ...) = sum(count(t) - count(out)) + count(out1 + " " + out2 ...)

    Matches of the patterns are settled by the characters near them, but for option
    labels (pairs depend on where the scan comes from, which an edge's gap resets) and
    ``A[^\\n]*B`` (at most one a line; the gist keeps which words a line has, in order).
    A text without such gaps near its ends stays whole, and so does every text if a
    phrase is longer than ``EDGE_CHARS``."""
    if any(len(p) > EDGE_CHARS for p in phrases):
        return df.withColumn(out, F.col(text))
    t, gap = F.col(text), _gap(phrases)
    head = F.regexp_extract(F.substring(t, 1, EDGE_SEARCH), f"^([\\s\\S]*?{gap})", 1)
    tail = F.regexp_extract(F.right(t, F.lit(EDGE_SEARCH)), f"^[\\s\\S]*({gap}[\\s\\S]*)$", 1)
    d = df.withColumn("__head", F.when(when, head)).withColumn("__tail", F.when(when, tail))
    between = F.length(t) - F.length("__head") - F.length("__tail")
    cut = (between > 0) & (F.length(normalize("__head")) >= EDGE_CHARS) & (F.length(normalize("__tail")) >= EDGE_CHARS)
    d = d.withColumn("__mid", F.when(cut, F.substring(t, F.length("__head") + 1, between)))
    mid = F.col("__mid")
    gist = F.when(F.instr(mid, "\n") > 0, F.concat(_hypothetical_gist(F.substring_index(mid, "\n", 1)), F.lit("\n"), _hypothetical_gist(F.substring_index(mid, "\n", -1)))).otherwise(_hypothetical_gist(mid))
    return d.withColumn(out, F.when(mid.isNotNull(), F.concat("__head", gist, "__tail")).otherwise(t)).drop("__head", "__tail", "__mid")
