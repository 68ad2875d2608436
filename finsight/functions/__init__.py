"""Column-level functions (Column -> Column), all native Catalyst expressions."""

from finsight.functions.dates import (age_month_part, age_total_months, age_year_part,
                                      day_of_week0, ntz_literal, seconds_between)
from finsight.functions.keys import NULL_KEY_TOKEN, surrogate_key
from finsight.functions.numeric import pub, to_double
from finsight.functions.text import pg_initcap

__all__ = [
    "surrogate_key", "NULL_KEY_TOKEN", "pg_initcap", "age_total_months", "age_year_part",
    "age_month_part", "day_of_week0", "ntz_literal", "seconds_between", "pub", "to_double",
]
