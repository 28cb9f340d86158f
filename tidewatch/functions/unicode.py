"""Unicode composition, the one text step the JVM functions cannot express."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Code points below U+0300 are already composed, so only texts beyond them go to Python.
_MAY_COMPOSE = "[^\\x{0000}-\\x{02ff}]"


@F.pandas_udf(StringType())
def _compose(texts: pd.Series) -> pd.Series:
    return texts.map(lambda text: None if text is None else unicodedata.normalize("NFC", text))


def composed(text: Column) -> Column:
    """NFC form of a text. Python receives nulls for every text that cannot change."""
    return F.coalesce(_compose(F.when(text.rlike(_MAY_COMPOSE), text)), text)
