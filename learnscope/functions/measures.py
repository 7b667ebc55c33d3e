"""Per-text measures in Arrow batches: normalized text, cleaned length, phrase and
pattern counts, edges. Each reads one text at a time with Python's own ``str`` and
``re``, which the lexicon's patterns were written for; the results are those of the
Column forms in :mod:`.text` (tests compare them).

Measures are taken where the texts are read, so that what is shuffled afterwards is
numbers and edges, not texts.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from . import lexicon as L

WIDE = re.compile("[" + L.FULLWIDTH_FROM[0] + "-" + L.FULLWIDTH_FROM[-2] + "]")
NARROW = dict(zip(L.FULLWIDTH_FROM, L.FULLWIDTH_TO))
EDGE_CHARS = 32  # normalized characters that an edge keeps at least: phrases are not longer
EDGE_SEARCH = 4096  # characters in which the end of an edge is looked for
EDGE_FROM = 512  # texts of more characters are cut to their edges


def python_pattern(pattern: str) -> str:
    """A pattern of the lexicon in Python's dialect (ASCII case folding, as in Java)."""
    p = pattern.replace(L.NOT_WORD, r"(?:\W|$)").replace(r"[^\p{L}\p{N}_>]", r"[^\w>]").replace(L.WS, r"\s").replace(L.DIGIT, r"\d")
    return p.replace("(?i)<img", "<[iI][mM][gG]").replace("(?i)", "(?ai)")


def normalized(s: str | None) -> str:
    """SCL2 of one text."""
    if not s:
        return ""
    return "".join(s.split() if s.isascii() else WIDE.sub(lambda m: NARROW[m[0]], s).split())


#: what SCL2 does with a byte of UTF-8: 0 keeps it, 1 drops it, 2 may begin a longer
#: character that is white space or full-width (then the pair of its first two bytes tells)
_SPACES = np.array([ord(c) for c in L.WS_CHARS])
_SPECIAL = [c.encode() for c in L.FULLWIDTH_FROM + L.WS_CHARS if not c.isascii()]
_BYTE = np.zeros(256, np.uint8)
_BYTE[[b[0] for b in _SPECIAL]] = 2
_BYTE[_SPACES[_SPACES < 128]] = 1
_PAIR = np.zeros(65536, bool)
_PAIR[[b[0] << 8 | b[1] for b in _SPECIAL]] = True
PIECE_BYTES = 1 << 18  # bytes of a batch that are looked at together


def _normalized_bytes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes with full-width characters made half-width at their first byte, and
    which bytes SCL2 keeps."""
    kind = _BYTE[data]
    keep = kind != 1
    at = np.flatnonzero(kind == 2)
    at = at[_PAIR[data[at].astype(np.uint16) << 8 | data[np.minimum(at + 1, len(data) - 1)]]]
    if len(at):
        n = np.where(data[at] < 0xE0, 2, 3)
        a, b, c = (data[np.minimum(at + i, len(data) - 1)].astype(np.int32) & 63 for i in range(3))
        code = np.where(n == 2, (a & 31) << 6 | b, (a & 15) << 12 | b << 6 | c)
        wide = (code >= ord(L.FULLWIDTH_FROM[0])) & (code <= ord(L.FULLWIDTH_FROM[-2]))
        data = data.copy()
        data[at[wide]] = code[wide] - (ord(L.FULLWIDTH_FROM[0]) - ord(L.FULLWIDTH_TO[0]))
        space = np.isin(code, _SPACES)
        keep[at[space]] = False
        for i in (1, 2):
            keep[at[(wide | space) & (n > i)] + i] = False
    return data, keep


def normalized_texts(texts: pa.Array) -> pa.Array:
    """SCL2 of a batch: :func:`normalized` on the batch's UTF-8 bytes, in pieces of whole texts."""
    if not len(texts):
        return texts
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    at = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, texts.offset * 4)
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and at[-1] > at[0] else np.zeros(0, np.uint8)
    ends, parts, i = np.zeros(len(at), np.int32), [], 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(at, int(at[i]) + PIECE_BYTES, "right")) - 1)
        piece, keep = _normalized_bytes(data[at[i]:at[j]])
        parts.append(piece[keep])
        end = at[i + 1:j + 1] - at[i]
        ends[i + 1:j + 1] = ends[i] + end - np.searchsorted(np.flatnonzero(~keep), end)
        i = j
    return pa.StringArray.from_buffers(len(texts), pa.py_buffer(ends), pa.py_buffer(np.concatenate(parts)))


_CLEAN = [re.compile(python_pattern(p)) for p, _ in L.QUESTION_CLEAN_STEPS[:-1]]
_IMAGE = re.compile(python_pattern(L.IMAGE_PATTERN))


def cleaned_length(s: str | None) -> int:
    """SCL1 of one text: the last step (white space to one space) and the trim are a split."""
    if not s:
        return 0
    if "![" in s:
        s = _CLEAN[0].sub("", s)
    if "请上传你的文件" in s:
        s = _CLEAN[1].sub("", s)
    if ":" in s or "：" in s:
        s = _CLEAN[2].sub("", s)
    if "<" in s:
        s = _CLEAN[3].sub("", s)
    return len(" ".join(s.split()))


def has_image(s: str | None) -> bool:
    """SCL5 of one text."""
    return bool(s) and ("![" in s or "<img" in s) and bool(_IMAGE.search(s))


def phrase_counter(lists: Sequence[Sequence[str]]) -> Callable[[str], list[int]]:
    """SCL3: for a normalized text, the summed counts of each list's phrases. A phrase is
    counted once for all lists; phrases beyond ASCII only in runs of characters that are
    not below all of theirs."""
    if any(not p for ps in lists for p in ps):
        raise ValueError("empty phrase")
    uses: dict[str, list[int]] = {}
    for i, phrases in enumerate(lists):
        for p in phrases:
            uses.setdefault(p, []).append(i)
    low = min((min(p) for p in uses if min(p) > "\x7f"), default=None)
    beyond = [(p, u) for p, u in uses.items() if low and min(p) >= low]
    other = [(p, u) for p, u in uses.items() if not (low and min(p) >= low)]
    runs = re.compile(f"[{low}-\U0010ffff]+") if low else None

    def count(norm: str) -> list[int]:
        out = [0] * len(lists)
        rest = "\n".join(runs.findall(norm)) if runs and not norm.isascii() else ""
        for text, phrases in ((norm, other), (rest, beyond)):
            if text:
                for p, used in phrases:
                    n = text.count(p)
                    if n:
                        for i in used:
                            out[i] += n
        return out

    return count


#: the default lists of patterns, in Python's dialect with the literals they require
#: (the first one is found by its end, a digit before it tells: no two ends overlap)
NUMBERED = re.compile(r"[\.、]\s*[A-D选项]")
COPY_PATTERNS = [(re.compile(python_pattern(p)), r) for p, r in zip(L.NON_NATURAL_PATTERNS, L.NON_NATURAL_REQUIRED)]
HYPOTHETICAL = [(re.compile(python_pattern(p)), r) for p, r in zip(L.HYPOTHETICAL_PATTERNS, L.HYPOTHETICAL_REQUIRED)]


def patterns_found(s: str, patterns: Sequence[tuple[re.Pattern, Sequence[str]]]) -> int:
    """SCL4: non-overlapping matches in a raw text."""
    found = 0
    for p, required in patterns:
        if p.pattern == COPY_PATTERNS[0][0].pattern:
            found += sum(s[m.start() - 1:m.start()].isdecimal() for m in NUMBERED.finditer(s))
        elif all(r in s for r in required):
            found += sum(1 for _ in p.finditer(s))
    return found


def _plain(phrases: Sequence[str]) -> re.Pattern:
    """As in :func:`learnscope.functions.text._gap`, but only letters and numbers that are
    no digits (fewer than there, so an edge ends there or later)."""
    chained = {c for p in phrases if any(p[:i] == p[-i:] for i in range(1, len(p))) for c in p}
    wide = dict(zip(L.FULLWIDTH_TO, L.FULLWIDTH_FROM))
    own = "".join(re.escape(x) for c in sorted(chained) for x in sorted({c, wide.get(c, c)}))
    return re.compile(r"[^\W\d_A-D分选项如果会可以吗那" + own + "]")


LABEL, LABEL_BACKWARDS = re.compile(r"[A-D][\.、)]"), re.compile(r"[\.、)][A-D]")


def _edge_end(s: str, plain: re.Pattern, label: re.Pattern) -> int:
    """Where an edge of ``s`` ends: after the second of two plain characters with 51 to
    251 others, and no option label, between; 0 if there are none."""
    at = 0
    while first := plain.search(s, at):
        at = first.start()
        second = plain.search(s, at + 52, at + 253)
        if not second:
            at += 100
            continue
        found = label.search(s, at + 1, second.start())
        if not found:
            return second.end()
        at = found.start() + 1
    return 0


def _gist(s: str) -> str:
    """A short text with the same effect on the spanning patterns as ``s``, one line."""
    def words(a: str, b: str) -> str:
        if a in s and b in s and re.search(f"{a}[^\n]*{b}", s):
            return a + b
        return (b if b in s else "") + (a if a in s else "")

    return " " + words("如果", "会") + " " + words("可以", "吗") + " "


def edge_cutter(phrases: Sequence[str]) -> Callable[[str], str]:
    """A text, or where it is long its edges and the gist of what is between (see
    :func:`learnscope.functions.text.with_edges`, which states what holds for it)."""
    if any(len(p) > EDGE_CHARS for p in phrases):
        return lambda s: s
    plain = _plain(phrases)

    def cut(s: str) -> str:
        if len(s) <= EDGE_FROM:
            return s
        h = _edge_end(s[:EDGE_SEARCH], plain, LABEL)
        t = len(s) - _edge_end(s[:-EDGE_SEARCH - 1:-1], plain, LABEL_BACKWARDS)
        if h >= t or min(len(normalized(s[:h])), len(normalized(s[t:]))) < EDGE_CHARS:
            return s
        between = s[h:t]
        lines = between.split("\n")
        return s[:h] + (_gist(lines[0]) + "\n" + _gist(lines[-1]) if len(lines) > 1 else _gist(between)) + s[t:]

    return cut


#: one character of a simple pattern (group 1) with its quantifier, or a bracket of a group
ATOM = re.compile(r"(\[\^?(?:\\n|\\[^\w\s]|[^\\\[\]^])+\]|\\[^\w\s]|[^\\^$.|?*+(){}\[\]])(?:(?:[*+?]|\{\d+(?:,\d*)?\})\??)?|\(\?:|\((?!\?)|\||\)(?:[*+?]|\{\d+(?:,\d*)?\})?")


def stops(pattern: str) -> re.Pattern | None:
    """A character that no match of the pattern holds, so that none reaches over it; None
    where that cannot be told (look-around, anchors, flags, ``.`` and escapes such as
    ``\\d``, which Java and Python read differently) or where the pattern matches ''."""
    atoms, at = [], 0
    while at < len(pattern):
        m = ATOM.match(pattern, at)
        if not m:
            return None
        atoms += [m[1]] if m[1] else []
        at = m.end()
    if not atoms or "&&" in pattern or re.fullmatch(pattern, ""):
        return None
    return re.compile("(?!" + "|".join(dict.fromkeys(atoms)) + r")[\s\S]")


def stop_cutter(phrases: Sequence[str], patterns: Sequence[str]) -> Callable[[str], str] | None:
    """As :func:`edge_cutter` for a caller's own patterns: an edge holds, for each
    pattern and phrase, a character that is in none of its matches, so what is counted
    beyond it does not depend on what the edge is joined to. None where a pattern
    has no such character that is known (:func:`stops`)."""
    wide = dict(zip(L.FULLWIDTH_TO, L.FULLWIDTH_FROM))
    own = [stops(p) for p in patterns]
    if None in own:
        return None
    own += [re.compile(r"[^\s" + "".join(re.escape(x) for c in sorted(set(p)) for x in sorted({c, wide.get(c, c)})) + "]") for p in dict.fromkeys(phrases)]

    def edge(s: str) -> int:
        found = [p.search(s) for p in own]
        return max((m.end() for m in found), default=0) if all(found) else len(s)

    def cut(s: str) -> str:
        if len(s) <= EDGE_FROM:
            return s
        h, t = edge(s), len(s) - edge(s[::-1])
        return s[:h] + s[t:] if h < t else s

    return cut


def signal_edges(lx: dict) -> Callable[[str], tuple] | None:
    """For one turn's text: its edges, and what they leave out of the counts for
    copy_paste_score, answer_seeking_intensity and understanding_signal_strength.
    None where a caller's own patterns need the whole text."""
    lists = [lx["copy"], lx["answer_prompt"], lx["understanding"]]
    every, phrases = [p for ps in lists for p in ps], phrase_counter(lists)
    copy_patterns, hypothetical = COPY_PATTERNS, HYPOTHETICAL
    if list(lx["copy_patterns"]) == L.NON_NATURAL_PATTERNS and list(lx["hypothetical"]) == L.HYPOTHETICAL_PATTERNS:
        cut = edge_cutter(every)
    else:
        cut = stop_cutter(every, [*lx["copy_patterns"], *lx["hypothetical"]])
        if cut is None:
            return None
        copy_patterns, hypothetical = ([(re.compile(p), ()) for p in lx[name]] for name in ("copy_patterns", "hypothetical"))

    def counts(s: str) -> list[int]:
        copy, answer, understanding = phrases(normalized(s))
        return [copy + patterns_found(s, copy_patterns), answer, understanding + patterns_found(s, hypothetical)]

    def run(s: str) -> tuple:
        edges = cut(s)
        if edges == s:
            return s, 0, 0, 0
        return edges, *(a - b for a, b in zip(counts(s), counts(edges)))

    return run


def per_batch(fn: Callable[[pa.Array], pa.Array], schema: str, text: Column | str) -> Column:
    """``fn`` of every batch of texts as an Arrow UDF."""
    return F.arrow_udf(fn, schema)(F.col(text) if isinstance(text, str) else text)


def per_text(fn: Callable, schema: str, text: Column | str) -> Column:
    """``fn`` of every text as an Arrow UDF; a tuple of values where ``schema`` names
    several columns (``struct<...>``)."""
    from pyspark.sql.types import _parse_datatype_string
    from pyspark.sql.pandas.types import to_arrow_type

    kind = to_arrow_type(_parse_datatype_string(schema))

    def run(texts: pa.Array) -> pa.Array:
        out = [fn(s) for s in texts.to_pylist()]
        if not pa.types.is_struct(kind):
            return pa.array(out, kind)
        columns = zip(*out) if out else [()] * kind.num_fields
        return pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kind)], fields=list(kind))

    return F.arrow_udf(run, schema)(F.col(text) if isinstance(text, str) else text)
