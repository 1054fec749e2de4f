"""Result columns in the types the SQL forms use: text, 64-bit integers, doubles rounded to six digits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankweave.functions.scoring import stable


def shape(df: DataFrame, columns: str) -> DataFrame:
    """Columns are space-separated `name:type` as in the SQL helper."""
    out = []
    for column in columns.split():
        name, kind = column.rsplit(":", 1)
        value = F.col(f"`{name}`")
        if kind == "i":
            value = value.cast("long")
        elif kind == "d":
            value = stable(value.cast("double"))
        out.append(value.alias(name))
    return df.select(*out)
