"""Helpers of the operator tests (not a conftest, so that tests/conftest.py stays the only one)."""

import random

from pyspark.sql import functions as F

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use themselves; inputs may have them too.
CLASHING = ("n_words", "score", "id", "cls", "group", "data", "kept", "host", "bucket", "scan", "piece", "a", "b")
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi pi rho".split()


def make_docs(spark, rows, extra=True):
    """Documents from (doc_id, text[, lang, source]) rows, with extra columns of clashing names."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s",
             None if r[1] is None else len(r[1])) for r in rows]
    df = spark.createDataFrame(full, DOC_SCHEMA)
    return df.withColumns({c: F.lit("clash") for c in CLASHING}) if extra else df


def sentence(rng, n, words=WORDS):
    return " ".join(rng.choice(words) + str(rng.randrange(50)) for _ in range(n))


def generator():
    return random.Random(4)
