"""The few text functions that Spark has no built-in for."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

_BLANKS = re.compile(r"\s+")


@F.pandas_udf(T.StringType())
def identity_text(col: pd.Series) -> pd.Series:
    """NFKC, blanks collapsed, case folded; null as ''."""
    return col.fillna("").map(lambda t: _BLANKS.sub(" ", unicodedata.normalize("NFKC", t)).strip().casefold())
