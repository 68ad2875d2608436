"""URL filtering: rules first, then the ratio of two character language models.

The rules (allow or block a host with its subdomains, under a path prefix; the longest rule that fits wins) decide
the urls they fit. Those urls, all of them, are the training text of two variable-order Markov models, one of accepted and one of
rejected urls. A model predicts each character of a url from up to ``ORDER`` preceding ones; the orders are blended by
Witten-Bell smoothing, so a long context counts only as far as it was seen. The score of a url is the mean per character of
log P(accepted) - log P(rejected); the threshold is the one with the best balanced accuracy on the
urls that rules decide. Contexts of 3 and more characters are hashed into ``CONTEXTS`` rows, so the size of a model is fixed
by parameters, not by the data.

Edge cases: a null url and one without ``://`` have an empty host and path, fit no rule and are judged by the method as their
text (null: empty). Without accepted or without rejected training urls there is no ratio: the verdict
is then ``allow``. A score equal to the threshold is allowed. Repeated rows each count and each get a row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finsight.llm.common import fresh, prepare, ship_by_value, text_bytes

ORDER = 4
CONTEXTS = 1 << 14
SYMBOLS = 64
END, PAD = 62, 63
#: Character classes: a-z (A-Z as well), 0-9, punctuation of urls; 0 is every other byte.
ALPHABET = b"abcdefghijklmnopqrstuvwxyz0123456789-._~:/?#[]@!$&'()*+,;=%"
BIN = 0.005
SPREAD = 2000
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"),
         ("allow", "org", "/fr/"))

CODES = np.zeros(256, np.int64)
for _i, _b in enumerate(ALPHABET):
    CODES[_b] = _i + 1
    CODES[ord(chr(_b).upper())] = _i + 1


def host_of(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s).*?://([^/?#]*)", 1)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s).*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule text, verdict) of the longest rule that fits; nulls if none does."""
    name = verdict = F.lit(None).cast("string")
    for kind, on, under in sorted(rules, key=lambda r: len(r[1] + r[2])):  # the longest is tried first
        fits = ((host == on) | host.endswith("." + on)) & path.startswith(under)
        name, verdict = F.when(fits, on + under).otherwise(name), F.when(fits, kind).otherwise(verdict)
    return name, verdict


def rows_of_order(k: int) -> int:
    return SYMBOLS ** k if SYMBOLS ** k <= CONTEXTS else CONTEXTS


#: Where the context rows of each order start, and their number.
STARTS = [sum(rows_of_order(j) for j in range(k)) for k in range(ORDER + 2)]


def cells(urls: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each character of each url (and its end): the context row of every order, the symbol, the url's index."""
    sizes = np.array([len(u) + 1 for u in urls], np.int64)
    parts = []
    for u in urls:
        parts += [CODES[np.frombuffer(u, np.uint8)], [END]]
    symbols = np.concatenate(parts).astype(np.int64)
    owner = np.repeat(np.arange(len(urls)), sizes)
    place = np.arange(len(symbols)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    rows = np.zeros((ORDER + 1, len(symbols)), np.int64)
    context = np.zeros(len(symbols), np.int64)
    for k in range(1, ORDER + 1):
        before = np.full(len(symbols), PAD, np.int64)
        before[k:] = np.where(place[k:] >= k, symbols[:-k], PAD)
        context = context * SYMBOLS + before
        held = rows_of_order(k)
        rows[k] = STARTS[k] + (context if held == SYMBOLS ** k else (context * 2654435761 >> 13) % held)
    return rows, symbols, owner


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros((2, STARTS[-1] * SYMBOLS), np.int64)
    for batch in batches:
        urls, kinds = batch.column(0).to_pylist(), np.array(batch.column(1).to_pylist(), np.int64)
        if urls:
            rows, symbols, owner = cells(urls)
            for kind in (0, 1):
                mine = kinds[owner] == kind
                flat, times = np.unique(rows[:, mine] * SYMBOLS + symbols[mine], return_counts=True)
                counts[kind, flat] += times
    for kind in (0, 1):
        cell = np.flatnonzero(counts[kind])
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(cell), kind)), pa.array(cell),
                                          pa.array(counts[kind][cell])], ["kind", "cell", "n"])


@dataclass
class Model:
    """Counts of accepted (1) and rejected (0) urls, and the threshold of the score."""

    counts: list[tuple[np.ndarray, np.ndarray]]  # by kind: cells and how often
    threshold: float = 0.0

    def tables(self) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        out = []
        for cell, n in self.counts:
            dense = np.zeros(STARTS[-1] * SYMBOLS, np.float32)
            dense[cell] = n
            dense = dense.reshape(-1, SYMBOLS)
            out.append((dense, dense.sum(1), (dense > 0).sum(1).astype(np.float32)))
        return out


def scores(urls: list[bytes], tables) -> np.ndarray:
    rows, symbols, owner = cells(urls)
    logs = []
    for dense, total, kinds in tables:
        p = np.full(len(symbols), 1 / SYMBOLS)
        for k in range(ORDER + 1):
            r = rows[k]
            seen = total[r] > 0
            blend = (dense[r, symbols] + kinds[r] * p) / np.maximum(total[r] + kinds[r], 1)
            p = np.where(seen, blend, p)
        logs.append(np.log(p))
    n = np.bincount(owner)
    return np.bincount(owner, logs[1] - logs[0]) / n


def llr(url: Column, model: Model) -> Column:
    """Mean log-likelihood ratio per character, accepted against rejected."""

    @F.arrow_udf("double")
    def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tables = model.tables()
        for part in batches:
            urls = [x or b"" for x in part.to_pylist()]
            yield pa.array(scores(urls, tables) if urls else [], pa.float64())

    return judge(text_bytes(url))


def fit(ruled: DataFrame) -> Model | None:
    """From columns url, verdict (allow or block): both models over all rows, and the threshold."""
    train = ruled.filter(F.col("verdict").isNotNull()).select(
        F.coalesce(F.col("url"), F.lit("")).cast("binary").alias("url"),
        (F.col("verdict") == "allow").cast("long").alias("kind"))
    got = train.mapInArrow(_count, "kind bigint, cell bigint, n bigint").groupBy("kind", "cell") \
        .agg(F.sum("n").alias("n")).toPandas()  # at most 2 * STARTS[-1] * SYMBOLS cells
    parts = [got[got["kind"] == k].sort_values("cell") for k in (0, 1)]
    if any(p.empty for p in parts):
        return None
    model = Model([(p["cell"].to_numpy(np.int64), p["n"].to_numpy(np.float32)) for p in parts])
    binned = F.least(F.greatest(F.floor(llr(F.col("url"), model) / BIN), F.lit(-SPREAD)), F.lit(SPREAD))
    seen = train.withColumn("bin", binned).groupBy("kind", "bin").agg(F.count(F.lit(1)).alias("n")).toPandas()
    hist = np.zeros((2, 2 * SPREAD + 1))
    np.add.at(hist, (seen["kind"].to_numpy(int), seen["bin"].to_numpy(int) + SPREAD), seen["n"].to_numpy(float))
    share = hist / hist.sum(1, keepdims=True)
    above = np.cumsum(share[1][::-1])[::-1]            # accepted urls at or above the bin
    under = np.concatenate([[0], np.cumsum(share[0])[:-1]])  # rejected urls below it
    model.threshold = float((best_bin(above + under) - SPREAD) * BIN)
    return model


def best_bin(gain: np.ndarray) -> int:
    """Of the equally good bins the middle of the run nearest to zero (the middle of ``gain``)."""
    at = np.flatnonzero(gain >= gain.max() - 1e-12)
    runs = np.split(at, np.flatnonzero(np.diff(at) > 1) + 1)
    nearest = min(runs, key=lambda run: np.abs(run - len(gain) // 2).min())
    return int(np.median(nearest))


def judge_urls(pages: DataFrame, url_col: str = "url", rules=RULES) -> DataFrame:
    """``pages`` with host, path, rule, verdict and url_score as a struct column ``url_judged``."""
    prepare(pages.sparkSession)
    url = F.col(url_col)
    ruled = pages.select(url.alias("url")).withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    model = fit(ruled.select("url", rule_of(F.col("host"), F.col("path"), rules)[1].alias("verdict")))
    host, path = host_of(url), path_of(url)
    score = llr(F.coalesce(url, F.lit("")), model) if model else F.lit(None).cast("double")
    parts_col = fresh(pages, "url_parts")
    parts = pages.withColumn(parts_col, F.struct(host.alias("host"), path.alias("path"), score.alias("score")))
    part = F.col(parts_col)
    rule, verdict = rule_of(part["host"], part["path"], rules)
    own = F.when(part["score"] < (model.threshold if model else 0.0), "block").otherwise("allow")
    return parts.withColumn("url_judged", F.struct(
        part["host"].alias("host"), part["path"].alias("path"), rule.alias("rule"),
        F.coalesce(verdict, own).alias("verdict"), part["score"].alias("score"))).drop(parts_col)


def report(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, url_score."""
    j = F.col("url_judged")
    return judge_urls(pages.select("page_id", "url")).select(
        "page_id", j["host"].alias("host"), j["path"].alias("path"), j["rule"].alias("rule"),
        j["verdict"].alias("verdict"), j["score"].alias("url_score"))


ship_by_value(__name__)
