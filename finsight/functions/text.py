"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A word is a run of letters/digits; every other run is a separator.
_RUNS = r"([\p{L}\p{N}]+|[^\p{L}\p{N}]+)"


def pg_initcap(c: Column | str) -> Column:
    """INITCAP where a word starts after any non-alphanumeric character
    ('saint-étienne' -> 'Saint-Étienne', "d'or" -> "D'Or"), unlike Spark's whitespace-only
    ``initcap``. NULL stays NULL."""
    col = F.col(c) if isinstance(c, str) else c
    runs = F.regexp_extract_all(F.lower(col), F.lit(_RUNS), F.lit(1))
    capped = F.transform(runs, lambda x: F.concat(F.upper(x.substr(F.lit(1), F.lit(1))),
                                                  x.substr(F.lit(2), F.length(x))))
    return F.array_join(capped, "")
