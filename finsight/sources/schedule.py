"""Premium schedule expansion: one instalment every 30 days from ``date_effet`` through
``least(date_echeance, horizon)`` inclusive. A generator expression per contract row (no
shuffle); each contract yields at most (term / 30) + 1 rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STEP_DAYS = 30


def due_dates(start: Column, end: Column, horizon: dt.date | Column) -> Column:
    """Array of due dates start, start+30, ... <= least(end, horizon); empty when start is after
    the last date. Built from an integer sequence of step indexes (cheaper than a date/interval
    sequence and never an error)."""
    h = F.lit(horizon) if isinstance(horizon, dt.date) else horizon
    last = F.least(end, h)
    n = F.floor(F.datediff(last, start) / STEP_DAYS).cast("int")
    steps = F.when(n >= 0, F.sequence(F.lit(0), n)).otherwise(F.array().cast("array<int>"))
    return F.transform(steps, lambda k: F.date_add(start, k * STEP_DAYS))


def premium_schedule(contrats: DataFrame, horizon: dt.date) -> DataFrame:
    """(contrat_id, date_echeance, montant_prime) for every due date of every contract."""
    return (contrats
            .select("contrat_id", "prime_mensuelle",
                    F.explode(due_dates(F.col("date_effet"), F.col("date_echeance"), horizon))
                    .alias("date_echeance"))
            .select("contrat_id", "date_echeance", F.col("prime_mensuelle").alias("montant_prime")))
