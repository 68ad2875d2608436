"""Quality rules: base counts of a text, and a hashed n-gram log-likelihood ratio between a trusted target and the raw corpus.

Built-in DataFrame functions only. Words are runs without ASCII white space. The base rules reject a text with fewer than 10 words
or with more than a fifth of its words inside 5-word windows that occur twice. Every other text is judged by the method: its
words and word pairs are hashed into ``BUCKETS`` buckets; two multinomials over the buckets, one counted over the trusted
texts and one over all texts, give each bucket a log ratio; the text's score is the mean over its n-grams. ``lm_ratio`` is
that score with add-one smoothing. It carries a bias that shrinks as the tables grow, and a trusted text has a share in its
own score, so the verdict is taken from ``held_ratio``: there the raw distribution, with the weight of ``PRIOR`` n-grams, is
the prior of the trusted one, and a text is scored by the trusted texts of the other ``FOLDS - 1`` folds only (folds by hash
of the text, so copies share one). A text is kept when ``held_ratio`` reaches the threshold, which is where labelled good and
poor rows that pass the base are told apart best (mean of both rates, over bins of 1 / ``BINS``). With fewer than
``LEAST`` rows of either label nothing can be derived, and ``lm_ratio`` is compared with ``THRESHOLD``. A text's
verdict depends on the counts alone, never on a draw.

Counting joins the texts with the trusted ids, then explodes n-grams and combines them to bucket counts before the
shuffle, so a word that is a third of all words costs one row per task; the table of ``BUCKETS`` numbers a fold has a fixed size and is read as a scalar subquery. Scoring is one pass without a
shuffle; its numbers (not the texts) are joined with the labels and counted in bins for the threshold. Windows are compared by 64-bit hashes of their words.

Edge cases: null and empty texts have no words, zero counts, fail the base and have a null score. Without trusted texts both multinomials are
taken as equal: every score is 0. An id labelled good and poor is good. Rows that repeat count each time. Ties do not arise.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finsight.llm.common import prepare, written

BUCKETS = 1 << 16
PRIOR = float(BUCKETS)
FOLDS = 4
THRESHOLD = -0.25
LEAST, BINS = 2, 1000
WINDOW = 5
SPACE = r"[\x20\x09-\x0D]+"
NOT_SYMBOL = r"[^#*$%&|<>]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def hashes_of(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def n_grams(hashes: Column) -> Column:
    """Buckets of the words and of the word pairs, from the word hashes."""
    bucket = lambda h: F.pmod(h, F.lit(BUCKETS)).cast("int")
    pairs = F.when(F.size(hashes) > 1, F.transform(
        F.slice(hashes, 2, F.greatest(F.size(hashes) - 1, F.lit(0))),
        lambda h, i: bucket(F.xxhash64(F.get(hashes, i), h)))).otherwise(F.array().cast("array<int>"))
    return F.concat(F.transform(hashes, bucket), pairs)


def repeated_words(hashes: Column, n: int = WINDOW) -> Column:
    """Words inside n-word windows that occur twice or more in the text."""
    window = lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(n)])
    windows = F.transform(F.sequence(F.lit(0), F.size(hashes) - n), window)

    def covered(w: Column) -> Column:
        placed = F.array_sort(F.transform(w, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return let(placed, lambda p: let(
            F.array_sort(F.transform(F.filter(p, lambda x, k: (
                F.get(p, k + 1)["h"].eqNullSafe(x["h"]) | ((k > 0) & F.get(p, F.greatest(k - 1, F.lit(0)))["h"].eqNullSafe(x["h"])))),
                lambda x: x["i"])),
            lambda at: F.aggregate(
                F.transform(at, lambda i, k: F.when(k == 0, n).otherwise(
                    F.least(F.lit(n), i - F.get(at, F.greatest(k - 1, F.lit(0)))))),
                F.lit(0).cast("long"), lambda total, x: total + x)))

    return F.when(F.size(hashes) >= 2, F.when(F.size(hashes) > n, let(windows, lambda w: F.when(
        F.size(F.array_distinct(w)) < F.size(w), covered(w)).otherwise(F.lit(0).cast("long"))))
        .otherwise(F.lit(0).cast("long"))).otherwise(F.lit(0).cast("long"))


def base_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with columns __hashes, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    counted = docs.withColumn("__hashes", hashes_of(words_of(F.col(text_col)))).withColumns({
        "n_words": F.size("__hashes").cast("long"),
        "word_chars": F.length(F.regexp_replace(text, SPACE, "")).cast("long"),
        "n_symbols": F.length(F.regexp_replace(text, NOT_SYMBOL, "")).cast("long"),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "n_repeat_words": let(F.col("__hashes"), lambda h: repeated_words(h)).cast("long")})
    return counted.withColumn("base_failed", (F.col("n_words") < 10) |
                              (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))


def fold_of(text: Column) -> Column:
    return F.pmod(F.xxhash64(text), F.lit(FOLDS)).cast("int")


def bucket_weights(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row with two arrays of log ratios, trusted texts against all texts: ``plain`` (``BUCKETS`` numbers) and ``held``
    (``BUCKETS`` numbers for each fold, without the trusted texts of that fold).

    ``trusted``: the ids of the trusted documents."""
    marks = trusted.select(F.col(id_col).alias("__id")).dropna().distinct().withColumn("__good", F.lit(1))
    # the text moves once, as text (hashes or n-grams would be larger), in the same way for any number of ids
    texts = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")).join(
        marks.hint("shuffle_hash"), "__id", "left")
    in_fold = lambda k: F.sum(F.when(F.col("fold") == k, F.col("n")).otherwise(0))
    # the fold below the explode: once for a text, not for every n-gram
    counts = texts.withColumn("fold", F.when(F.col("__good") == 1, fold_of(F.col("__text"))).otherwise(-1)) \
        .select(F.explode(let(hashes_of(words_of(F.col("__text"))), n_grams)).alias("bucket"), "fold") \
        .groupBy("bucket", "fold").agg(F.count(F.lit(1)).alias("n")) \
        .groupBy("bucket").agg(F.sum("n").alias("raw"), *[in_fold(k).alias(f"own{k}") for k in range(FOLDS)])
    own = [f"own{k}" for k in range(FOLDS)]
    every = docs.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("bucket")) \
        .join(counts, "bucket", "left").na.fill(0, ["raw", *own]).withColumn("own", sum(map(F.col, own[1:]), F.col(own[0])))
    pairs = every.agg(F.array_sort(F.collect_list(F.struct("bucket", "raw", "own", *own))).alias("p"),  # BUCKETS entries
                      *[F.sum(c).alias(c) for c in ("raw", "own", *own)])
    plain = F.transform("p", lambda x: F.when(F.col("own") == 0, F.lit(0.0)).otherwise(
        F.log((x["own"] + 1.0) / (F.col("own") + float(BUCKETS))) - F.log((x["raw"] + 1.0) / (F.col("raw") + float(BUCKETS)))))

    def held(k: int) -> Column:
        total = F.col("own") - F.col(f"own{k}")
        return F.transform("p", lambda x: F.when(x["raw"] == 0, F.lit(0.0)).otherwise(
            F.log(((x["own"] - x[f"own{k}"]) * F.col("raw") / x["raw"] + PRIOR) / (total + PRIOR))))

    return pairs.select(plain.alias("plain"), F.concat(*[F.when(F.col("own") == F.col(f"own{k}"), F.array_repeat(F.lit(0.0), BUCKETS))
                                                         .otherwise(held(k)) for k in range(FOLDS)]).alias("held"))


def scored(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the base counts, base_failed, lm_ratio and held_ratio (both null without words)."""
    prepare(docs.sparkSession)
    weights = written(bucket_weights(docs, trusted, id_col, text_col))
    counted = base_counts(docs, text_col).withColumns({
        "__plain": weights.select("plain").scalar(), "__held": weights.select("held").scalar()})
    mean = lambda g, w: F.aggregate(g, F.lit(0.0), lambda total, b: total + w(b)) / F.size(g)
    both = let(let(F.col("__hashes"), n_grams), lambda g: let(fold_of(F.col(text_col)) * BUCKETS, lambda start: F.struct(
        mean(g, lambda b: F.get(F.col("__plain"), b)).alias("lm"),
        mean(g, lambda b: F.get(F.col("__held"), b + start)).alias("held"))))
    return counted.withColumn("__both", F.when(F.col("n_words") > 0, both)) \
        .withColumns({"lm_ratio": F.col("__both.lm"), "held_ratio": F.col("__both.held")}) \
        .drop("__hashes", "__plain", "__held", "__both")


def derived_threshold(rows: DataFrame, trusted: DataFrame, poor: DataFrame, id_col: str = "doc_id") -> float | None:
    """The cut of held_ratio that tells the labelled rows of ``rows`` apart best, in the middle of the empty bins around
    it; the lowest of equally good ones. None with fewer than ``LEAST`` rows of either label."""
    ids = lambda df, good: df.select(F.col(id_col).alias("__id"), F.lit(good).alias("good"))
    marks = ids(trusted, 1).unionByName(ids(poor, 0)).dropna().groupBy("__id").agg(F.max("good").alias("good"))
    bins = rows.filter(~F.col("base_failed")).select(F.col(id_col).alias("__id"), F.floor(F.col("held_ratio") * BINS).alias("bin")) \
        .join(marks, "__id").groupBy("bin").agg(F.sum("good").alias("good"), F.sum(1 - F.col("good")).alias("poor"))
    found = sorted(tuple(r) for r in bins.select("bin", "good", "poor").collect())  # ratios are within -20 and 30
    n_good, n_poor = sum(r[1] for r in found), sum(r[2] for r in found)
    if min(n_good, n_poor) < LEAST:
        return None
    best, cut, below_good, below_poor = 0, found[0][0], 0, 0  # at first: everything is kept
    for (at, good, bad), after in zip(found, [r[0] for r in found[1:]] + [found[-1][0] + 1], strict=True):
        below_good, below_poor = below_good + good, below_poor + bad
        gain = below_poor * n_good - below_good * n_poor
        if gain > best:
            best, cut = gain, (at + 1 + after) / 2
    return cut / BINS


def judged(docs: DataFrame, trusted: DataFrame, poor: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """``docs`` without the text, with the base counts, base_failed, both ratios, kept and the threshold that decided.

    ``trusted``, ``poor``: ids labelled good and not good; ``threshold``: for lm_ratio, where too few are labelled."""
    rows = written(scored(docs, trusted, id_col, text_col).drop(text_col))
    cut = derived_threshold(rows, trusted, poor, id_col)
    ratio, least = ("lm_ratio", threshold) if cut is None else ("held_ratio", cut)
    return rows.withColumns({"kept": ~F.col("base_failed") & (F.col(ratio) >= least), "threshold": F.lit(float(least))})


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, the four base counts, base_failed, kept, lm_ratio, held_ratio, threshold.

    Trusted: quality 1; not good: quality 0."""
    found = judged(docs.select("doc_id", "text"), labels.filter("quality = 1"), labels.filter("quality = 0"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                        F.coalesce("kept", F.lit(False)).alias("kept"), "lm_ratio", "held_ratio", "threshold")
