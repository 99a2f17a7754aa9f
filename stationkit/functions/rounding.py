"""Output normalisation for comparisons with the SQL oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def round_doubles(df: DataFrame, places: int = 6) -> DataFrame:
    """Round every DOUBLE/FLOAT column; other columns pass unchanged."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(F.round(F.col(f"`{f.name}`").cast("double"), places).alias(f.name))
        else:
            out.append(F.col(f"`{f.name}`"))
    return df.select(*out)
