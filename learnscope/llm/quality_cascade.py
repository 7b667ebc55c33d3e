"""Quality rules as a short-circuit cascade, natively (no Python on the data).

Each rule is a Boolean column (true: reject). ``plan`` runs every rule on a
sample, measures its cost (seconds) and selectivity (share of rows rejected)
and orders the rules by rejection per cost; ``verdict`` evaluates them in that
order as one CASE, which stops at the first rule that rejects. The order
changes only the work: the verdict is the same for every order.

Defined cases: a null or empty text has no words; it fails any rule that asks
for words. A rule that is null on a row does not reject it. Rows with equal
text get equal verdicts; tied rules keep their given order. An empty table
keeps the given order. Columns of the input, whatever their names, pass
through; names the operator adds replace equal ones.
"""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, discard, fresh, materialize, word_array

SYMBOLS = "#*$%&|<>"
WINDOW = 8
Rule = tuple[str, Column]


def covered_words(grams: Column, n: int = WINDOW) -> Column:
    """How many words lie in windows whose value (a 64-bit hash of the words'
    hashes) the text has twice or more, the first one included."""
    pairs = F.array_sort(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
    same = F.zip_with(pairs, F.slice(pairs, F.lit(2), F.size(grams)), lambda a, b: F.struct(a["i"].alias("i"), F.coalesce(a["g"] == b["g"], F.lit(False)).alias("e")))
    before = F.concat(F.array(F.lit(False)), F.transform(same, lambda x: x["e"]))
    starts = F.array_sort(F.filter(F.zip_with(same, before, lambda a, p: F.when(a["e"] | p, a["i"])), lambda i: i.isNotNull()))
    zero = F.struct(F.lit(0).cast("long").alias("t"), F.lit(-n).alias("p"))
    return F.aggregate(
        starts,
        zero,
        lambda acc, i: F.struct((acc["t"] + F.least(F.lit(n), i - acc["p"])).cast("long").alias("t"), i.alias("p")),
        lambda acc: acc["t"],
    )


def measures(df: DataFrame, text: str = "text") -> DataFrame:
    """Add the base measures of every whole text: n_words, word_chars (code
    points in words), n_symbols, n_dup_lines (lines with a word that equal an
    earlier line), n_repeat_words (words in 8-word windows found twice)."""
    own, words, hashed, grams = fresh(df, "_lines", "_words", "_hashed", "_grams")
    t = F.coalesce(F.col(text), F.lit(""))
    df = df.withColumns(
        {
            "word_chars": F.length(F.translate(t, " \t\n\x0b\x0c\r", "")).cast("long"),
            "n_symbols": (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long"),
            own: F.filter(F.split(t, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
            words: word_array(F.col(text)),
        }
    )
    df = df.withColumns(
        {
            "n_words": F.size(words).cast("long"),
            "n_dup_lines": (F.size(own) - F.size(F.array_distinct(own))).cast("long"),
            hashed: F.transform(words, lambda w: F.xxhash64(w)),
        }
    ).drop(words, own)
    windows = F.transform(F.sequence(F.lit(1), F.size(hashed) - F.lit(WINDOW - 1)), lambda i: F.xxhash64(F.slice(F.col(hashed), i, WINDOW)))
    df = df.withColumn(grams, F.when(F.size(hashed) >= WINDOW, windows).otherwise(F.array().cast("array<long>"))).drop(hashed)
    repeats = F.size(F.array_distinct(grams)) < F.size(grams)
    return df.withColumn("n_repeat_words", F.when(repeats, covered_words(F.col(grams))).otherwise(F.lit(0).cast("long"))).drop(grams)


def default_rules(text: str = "text") -> list[Rule]:
    """Rules on top of the base measures. Thresholds are the customary ones of
    web-corpus filters, loose enough for short and long prose."""
    t = F.coalesce(F.col(text), F.lit(""))
    n = F.greatest(F.col("n_words"), F.lit(1))
    return [
        ("symbol_ratio", F.col("n_symbols") > 0.1 * n),
        ("word_length", (F.col("word_chars") < 2 * n) | (F.col("word_chars") > 15 * n)),
        ("duplicate_lines", F.col("n_dup_lines") > 0.3 * (F.length(t) - F.length(F.replace(t, F.lit("\n"), F.lit(""))) + 1)),
        ("exclamation_ratio", F.length(t) - F.length(F.replace(t, F.lit("!"), F.lit(""))) > 0.5 * n),
        ("few_letters", F.length(F.regexp_replace(t, r"[\p{L}" + SPACE[1:], "")) > 0.4 * F.col("word_chars")),
        ("upper_case", F.length(F.regexp_replace(t, r"[^\p{Lu}]+", "")) > 0.6 * F.col("word_chars")),
    ]


def plan(df: DataFrame, rules: Sequence[Rule], text: str = "text", fraction: float = 0.01, max_rows: int = 2000, seed: int = 7) -> list[dict]:
    """Cost and selectivity of each rule on a sample of at most ``max_rows``
    rows (the sample serves only to order the rules), best first."""
    # the sample is drawn from the raw rows, so only sampled rows are measured
    sample = materialize(measures(df.sample(fraction, seed).limit(max_rows), text), "cascade-sample")
    rows = sample.count()

    def timed(*cols):
        best, out = float("inf"), None
        for _ in range(2):
            t0 = time.perf_counter()
            out = sample.agg(*cols).first()
            best = min(best, time.perf_counter() - t0)
        return best, out

    base, _ = timed(F.count(F.lit(1)))
    found = []
    for name, reject in rules if rows else ():
        cost, out = timed(F.count(F.when(reject, True)).alias("n"))
        cost = max(cost - base, 1e-4)
        found.append({"rule": name, "cost": cost, "selectivity": out["n"] / rows, "rank": out["n"] / rows / cost})
    discard(sample)
    return sorted(found, key=lambda x: -x["rank"]) or [{"rule": name, "cost": None, "selectivity": None, "rank": 0.0} for name, _ in rules]


def verdict(rules: Sequence[Rule], order: Sequence[dict]) -> Column:
    """Name of the first rule, in ``order``, that rejects the row; null if none
    does. CASE evaluates its branches lazily, so later rules are not run."""
    by = dict(rules)
    out = None
    for x in order:
        c = F.coalesce(by[x["rule"]], F.lit(False))
        out = F.when(c, F.lit(x["rule"])) if out is None else out.when(c, F.lit(x["rule"]))
    return out if out is not None else F.lit(None).cast("string")


def cascade(df: DataFrame, rules: Sequence[Rule] | None = None, text: str = "text", fraction: float = 0.01) -> DataFrame:
    """Measures, ``base_failed`` and ``kept`` for every row. The base test (too
    few words, or over 30 % of the words in repeated windows) comes first; the
    ordered rules run only on rows that pass it."""
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    rules = list(default_rules(text) if rules is None else rules)
    order = plan(df, rules, text, fraction)
    return measures(df, text).withColumn("base_failed", failed).withColumn("kept", F.when(F.col("base_failed"), F.lit(False)).otherwise(verdict(rules, order).isNull()))
