"""Toxicity scoring: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A word is the bag of its character n-grams (3 to 5, with word marks) and of itself, hashed into ``BUCKETS`` rows of an
embedding table; its vector is the mean of those rows, so an unseen misspelling shares most of its vector with the
word it distorts. The vectors of a run of ``SPAN`` words are averaged and go through a linear softmax. A document is
as toxic as its most toxic run of words, whole text included, so an insult deep in a long text weighs as much as one
in a short text. Training alternates between fitting runs and picking the runs that speak for each document; a last
logistic fit on rows kept apart turns the highest run score and the length into a probability.

The classifier is fitted on the driver on at most ``sample`` labelled rows of each class, drawn by hash of the
id from all training rows; the bound is a parameter. Every document is scored.

A clean text far longer than every labelled one can be flagged by chance: the highest of very many runs is compared with what
shorter texts showed.

Edge cases: null and empty texts and texts without letters or digits score 0. Without a labelled row of both classes
all scores are 0 (nothing to tell apart). Null labels do not train. A repeated id is sampled once
and trains with each of its rows. The hash order makes the sample, and with a fixed seed the model, deterministic.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finsight.llm.common import crc_mod, prepare, ship_by_value

BUCKETS = 1 << 16
DIM = 8
SPAN = 6
SAMPLE = 2500
THRESHOLD = 0.7
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


_KINDS: list[np.ndarray] = []


def kinds() -> np.ndarray:
    """Of each character: 2 letter or digit, 1 white space, 0 anything else (dropped)."""
    if not _KINDS:
        _KINDS.append(np.array([2 * chr(i).isalnum() or int(chr(i).isspace()) for i in range(0x110000)], np.uint8))
    return _KINDS[0]


def subwords(text: str) -> tuple[np.ndarray, np.ndarray, int]:
    """Embedding rows of all subwords of a text, the word that each belongs to, and the number of words.

    Words are lower-case and keep letters and digits only; the rows come from polynomial hashes of their characters."""
    points = np.frombuffer(text.lower().encode("utf-32-le"), np.uint32)
    kind = kinds()[points]
    points, kind = points[kind > 0], kind[kind > 0]
    letter = kind == 2
    starts = letter & ~np.concatenate([[False], letter[:-1]])
    count = int(starts.sum())
    if not count:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), 0
    word = (np.cumsum(starts) - 1)[letter]
    sizes = np.bincount(word, minlength=count) + 2  # with a mark on either side
    owner = np.repeat(np.arange(count), sizes)
    marked = np.full(len(owner), 1, np.uint64)
    first = np.cumsum(sizes) - sizes
    marked[first] = 2
    marked[np.arange(len(word)) + 2 * word + 1] = points[letter]
    rows, owners = [], []
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(int(sizes.max()), _MULTIPLIER)]), dtype=np.uint64)
        codes = np.add.reduceat(marked * powers[np.arange(len(owner)) - np.repeat(first, sizes)], first)
        rows.append(_bucket(codes))
        owners.append(np.arange(count))
        for n in (3, 4, 5):
            if len(marked) >= n:
                inside = np.flatnonzero(owner[n - 1:] == owner[:len(owner) - n + 1])
                codes = np.full(len(inside), n, np.uint64)
                for k in range(n):
                    codes = codes * _MULTIPLIER + marked[inside + k]
                rows.append(_bucket(codes))
                owners.append(owner[inside])
    return np.concatenate(rows), np.concatenate(owners), count


def _bucket(codes: np.ndarray) -> np.ndarray:
    codes = (codes ^ (codes >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return (codes >> np.uint64(48)).astype(np.int64) % BUCKETS


def tokens(text: str | None) -> list[str]:
    return [w for w in ("".join(c for c in x if c.isalnum()) for x in text.lower().split()) if w] if text else []


class Bags:
    """Distinct words of the training texts as rows of subword ids."""

    def __init__(self, texts: list[list[str]]):
        index: dict[str, int] = {}
        self.docs = [np.array([index.setdefault(w, len(index)) for w in words], np.int64) for words in texts]
        flat, sizes, words = [], [], list(index)
        for at in range(0, len(words), 20_000):  # in parts, to bound the arrays of characters
            rows, owner, count = subwords(" ".join(words[at:at + 20_000]))
            flat.append(rows[np.argsort(owner, kind="stable")].astype(np.int32))
            sizes.append(np.bincount(owner, minlength=count))
        self.flat, self.sizes = np.concatenate(flat), np.concatenate(sizes)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def words(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Subword ids of the given words, and the position in ``which`` that each belongs to."""
        sizes = self.sizes[which]
        owner = np.repeat(np.arange(len(which)), sizes)
        offset = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        return self.flat[self.starts[which][owner] + offset], owner


def highest(values: np.ndarray, span: int = SPAN) -> tuple[float, int]:
    """Largest mean of ``span`` consecutive values (of all, if fewer), and where that run starts."""
    if len(values) <= span:
        return float(values.mean()), 0
    total = np.concatenate([[0.0], np.cumsum(values)])
    means = (total[span:] - total[:-span]) / span
    at = int(means.argmax())
    return float(means[at]), at


def features(words: np.ndarray) -> list[float]:
    """What the last fit sees of a text: its highest run, and its length (the highest of more runs is higher by chance)."""
    return [highest(words)[0], float(np.log(len(words) + SPAN))]


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Slopes and offset of y on standardised columns of x, by Newton steps with a small ridge; both classes weigh the same."""
    mean, scale = x.mean(0), np.where(x.std(0) > 0, x.std(0), 1)
    z, w = np.hstack([(x - mean) / scale, np.ones((len(x), 1))]), np.zeros(x.shape[1] + 1)
    weight = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1)) * len(y)
    ridge = np.array([0.05, 20, 0])  # a few rows say little about the length
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        h = (z * (weight * p * (1 - p))[:, None]).T @ z + np.diag(ridge + 1e-6)
        w = w - np.linalg.solve(h, z.T @ (weight * (p - y)) + ridge * w)
    return w[:-1] / scale, float(w[-1] - (w[:-1] * mean / scale).sum())


def train(texts: list[str], labels: list[int], seed: int = 7, rounds: int = 10, least_steps: int = 60) -> dict | None:
    """Model of subword scores; None without texts of both classes."""
    held = [(tokens(t), int(y)) for t, y in zip(texts, labels, strict=True)]
    held = [(w, y) for w, y in held if w]
    y = np.array([k for _, k in held], np.int64)
    if len(set(y.tolist())) < 2:
        return None
    rng = np.random.default_rng(seed)
    bags = Bags([w for w, _ in held])
    table = (rng.standard_normal((BUCKETS, DIM)) * 0.1).astype(np.float32)
    out = (rng.standard_normal((DIM, 2)) * 0.3).astype(np.float32)
    bias = np.zeros(2, np.float32)
    seen_table, seen_out = np.full(BUCKETS, 1e-6, np.float32), np.full((DIM, 2), 1e-6, np.float32)
    apart = rng.permutation(len(held)) % 5 == 0  # rows for the last logistic fit
    if len(set(y[apart].tolist())) < 2 or len(set(y[~apart].tolist())) < 2:
        apart = np.zeros(len(held), bool)
    fit = np.flatnonzero(~apart)
    balance = np.array([1.0, max(1.0, (y[fit] == 0).sum() / max((y[fit] == 1).sum(), 1))], np.float32)

    def word_scores() -> np.ndarray:
        gap = (table @ (out[:, 1] - out[:, 0]))[bags.flat]
        return np.add.reduceat(gap, bags.starts) / bags.sizes

    for turn in range(rounds):
        runs: list[tuple[np.ndarray, int]] = []
        scores = word_scores()
        for d in fit:
            words = bags.docs[d]
            cuts = [int(x) for x in rng.integers(0, max(1, len(words) - SPAN + 1), 1 if y[d] else 2)]
            if turn:
                cuts = [highest(scores[words])[1], *cuts[: 1 - y[d]]]  # the run that speaks for the document
            else:
                cuts = rng.permutation(range(0, len(words), SPAN))[:20].tolist() if y[d] else cuts
            runs += [(words[c:c + SPAN], int(y[d])) for c in cuts]
        # a few rows are gone through several times, so that they too get enough steps
        order = np.concatenate([rng.permutation(len(runs)) for _ in range(max(1, least_steps * 64 // len(runs)))])
        rate = 0.5 / (1 + turn / 2)
        for at in range(0, len(order), 64):
            part = [runs[i] for i in order[at:at + 64]]
            which = np.concatenate([w for w, _ in part])
            goal = np.array([k for _, k in part])
            sizes = np.array([len(w) for w, _ in part])
            ids, owner = bags.words(which)
            share = 1 / (bags.sizes[which] * np.repeat(sizes, sizes))
            run_of = np.repeat(np.arange(len(part)), sizes)[owner]
            weight = share[owner].astype(np.float32)
            hidden = np.zeros((len(part), DIM), np.float32)
            np.add.at(hidden, run_of, table[ids] * weight[:, None])
            logits = hidden @ out + bias
            p = np.exp(logits - logits.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(part)), goal] -= 1
            p *= balance[goal][:, None]
            back = p @ out.T
            step = hidden.T @ p
            seen_out += step ** 2
            out -= rate * step / np.sqrt(seen_out)
            bias -= 0.01 * p.sum(0)
            touched, place = np.unique(ids, return_inverse=True)
            change = np.zeros((len(touched), DIM), np.float32)
            np.add.at(change, place, back[run_of] * weight[:, None])
            seen_table[touched] += (change ** 2).mean(1)
            table[touched] -= rate * (change / np.sqrt(seen_table[touched])[:, None] + 1e-3 * table[touched])
    scores = word_scores()
    last = np.flatnonzero(apart) if apart.any() else fit
    slope, offset = _logistic(np.array([features(scores[bags.docs[d]]) for d in last]), y[last].astype(float))
    return {"gap": (table @ (out[:, 1] - out[:, 0])).astype(np.float32), "slope": slope, "offset": offset}


def score(text: str | None, model: dict | None) -> float:
    """Probability that the most toxic run of words of a text is toxic."""
    if model is None or not text:
        return 0.0
    rows, owner, count = subwords(text)
    if not count:
        return 0.0
    words = np.bincount(owner, model["gap"][rows], count) / np.bincount(owner, minlength=count)
    at = float(model["slope"] @ features(words)) + model["offset"]
    return float(1 / (1 + np.exp(-np.clip(at, -30, 30))))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", label_col: str = "toxic",
        folds: int = 3, held: int = 1) -> dict | None:
    """Train on at most ``sample`` labelled documents of each class whose id hash is not in the held-out fold."""
    prepare(docs.sparkSession)
    usable = labels.select(F.col(id_col).alias("__id"), F.col(label_col).cast("int").alias("__y")).dropna() \
        .filter(crc_mod("__id", folds) != held).distinct()
    order = [F.xxhash64("__id"), F.col("__id")]
    drawn = usable.filter("__y = 1").orderBy(*order).limit(sample) \
        .unionByName(usable.filter("__y = 0").orderBy(*order).limit(sample))  # at most 2 * sample ids
    rows = docs.select(F.col(id_col).alias("__id"), F.col("text")).join(F.broadcast(drawn), "__id") \
        .filter(F.col("text").isNotNull()).select("__id", "text", "__y").toPandas()
    rows = rows.sort_values(["__id", "__y", "text"], kind="stable")
    return train(rows["text"].tolist(), rows["__y"].tolist())


def toxic_score(text: Column, model: dict | None) -> Column:
    """Probability (double, 0 to 1) that a text is toxic."""

    @F.arrow_udf("double")
    def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([score(t, model) for t in texts.to_pylist()], pa.float64())

    return judge(text)


def report(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    model = fit(docs, labels, id_col=id_col)
    judged = docs.select(F.col(id_col), F.col("text"), (crc_mod(id_col, 3) == 1).alias("held_out")) \
        .withColumn("score", toxic_score(F.col("text"), model))
    return judged.select(F.col(id_col), "held_out", "score",
                         F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))


def keep_harmless(docs: DataFrame, labelled_docs: DataFrame, labels: DataFrame,
                  threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score below the threshold, with their own columns."""
    model = fit(labelled_docs, labels)
    return docs.filter(toxic_score(F.col("text"), model) < threshold)


ship_by_value(__name__)
