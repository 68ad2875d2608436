"""Surrogate keys: md5 over the text of the key parts joined with '-'."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value (must equal the published key macro for identical keys): text used for a NULL part.
NULL_KEY_TOKEN = "_dbt_utils_surrogate_key_null_"


def _part(c: Column | str) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(col.cast("string"), F.lit(NULL_KEY_TOKEN))


def surrogate_key(*parts: Column | str) -> Column:
    """Deterministic 32-hex-char key of one or more columns; a NULL part is replaced by a token so
    the key itself is never NULL."""
    if not parts:
        raise ValueError("surrogate_key needs at least one column")
    if len(parts) == 1:
        return F.md5(_part(parts[0]))
    return F.md5(F.concat_ws("-", *[_part(p) for p in parts]))
