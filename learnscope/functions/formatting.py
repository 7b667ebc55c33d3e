"""Vectorized (Arrow-batched) formatting helpers where Spark's own formatting
differs from Python's. Kept free of postponed annotations so the pandas UDF
type hints are real types."""

import pandas as pd
from pyspark.sql import functions as F


@F.pandas_udf("string")
def prob_count_label(p: pd.Series, n: pd.Series) -> pd.Series:
    """``'%.2f\\n(%d)' % (p, n)`` with Python's exact rounding of the double."""
    return pd.Series([f"{a:.2f}\n({int(b)})" for a, b in zip(p, n)])
