"""Surrogate keys: md5 over '-'-joined, null-safe text of the key columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: text that stands for NULL inside a surrogate key.
NULL_SENTINEL = "_dbt_utils_surrogate_key_null_"
TS_FORMAT = "yyyy-MM-dd HH:mm:ss"


def _text(c: Column, dtype: str | None) -> Column:
    if dtype is not None and dtype.startswith("timestamp"):
        c = F.date_format(c, TS_FORMAT)
    return F.coalesce(c.cast("string"), F.lit(NULL_SENTINEL))


def surrogate_key(df_or_types, *cols: str) -> Column:
    """md5 of the columns' text joined by '-'. Timestamps use a fixed format.

    ``df_or_types`` is the DataFrame the columns belong to (its schema decides
    how timestamps are rendered) or a ``{name: simpleString}`` mapping.
    """
    types = (df_or_types if isinstance(df_or_types, dict)
             else {f.name: f.dataType.simpleString() for f in df_or_types.schema.fields})
    return F.md5(F.concat_ws("-", *[_text(F.col(c), types.get(c)) for c in cols]))
