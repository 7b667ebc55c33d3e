import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: names that the operators use inside; a table may have them too
CLASH = ["score", "kept", "size", "fp", "_doc", "_lines", "license", "n_words", "component_id", "removed", "label", "keys"]


@pytest.fixture(scope="session")
def make(spark):
    """A documents table from (doc_id, text[, source]) rows, with extra columns
    whose names clash with the operators' own on request."""
    from pyspark.sql import functions as F

    def build(rows, clash=False, parts=3):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1]) if r[1] is not None else None) for r in rows]
        df = spark.createDataFrame(full, DOCS).repartition(parts)
        return df.withColumns({c: F.lit("x") for c in CLASH}) if clash else df

    return build


@pytest.fixture(scope="session")
def odd():
    """Nulls, empty and white texts, one very long text, repeated rows, ties."""
    long = " ".join(f"w{i % 997}x{i % 13}" for i in range(30_000))
    same = "One two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen.\nA line of its own here."
    return [(1, None, None), (2, "", "a"), (3, " \t\n ", "a"), (4, same, "b"), (5, same, "b"), (5, same, "b"), (6, long, "c"), (7, "Ünïcode wörds ❤ and — dashes", None), (None, same, "b"), (8, "x", "b")]
