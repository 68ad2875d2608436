"""Language identification by rank-order n-gram profiles.

Training counts the n-grams (1 to 3 characters, words padded with a blank) of every training text per
language, and keeps each language's ``PROFILE`` most frequent ones in rank order. A document's own most frequent
n-grams are compared with each profile by out-of-place distance: the sum of rank differences, with the
profile length as the penalty for an n-gram the profile lacks. The nearest language wins; the score is one
minus the distance over its largest possible value.

Ranks in a document count the strictly more frequent n-grams, so ties share a rank and the outcome does not
depend on any order; equal distances go to the alphabetically first language; in a profile equal counts
rank by n-gram. Null texts and texts without a letter (the empty one too) get ``und`` with score 0; without any
training row every text does. Rows with a null language do not train. Repeated rows count each time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from finsight.llm.common import crc_mod, fresh, prepare, ship_by_value

PROFILE = 300
ORDERS = (1, 2, 3)
UNKNOWN = "und"
#: Distinct n-grams a task numbers at a time; beyond it counts are handed on and the numbering starts anew.
HELD_GRAMS = 1_000_000
LETTERS = 127
CODES = (LETTERS + 1) ** 3


def grams_of(text: str) -> list[str]:
    """n-grams of the letter runs of a lower-case text."""
    out = []
    for run in "".join(c if c.isalpha() else " " for c in text).split():
        padded = f" {run} "
        for n in ORDERS:
            out += [padded[i:i + n] for i in range(len(padded) - n + 1)]
    return [g for g in out if g != " "]


class Grams:
    """Numbers n-grams. The first ``LETTERS`` letters met are coded in arrays; texts with further letters go one by one."""

    def __init__(self):
        size = LETTERS + 1
        self.codes = np.full(0x110000, 255, np.uint8)  # of characters: 0 no letter, 254 beyond, 255 not met yet
        self.letters = [" "]
        self.number_of: dict[str, int] = {}
        self.names: list[str] = []
        self.known = np.full(CODES + size * size + size, -1, np.int32)

    def number(self, gram: str) -> int:
        at = self.number_of.get(gram)
        if at is None:
            at = self.number_of[gram] = len(self.names)
            self.names.append(gram)
        return at

    def name(self, code: int) -> str:
        size, letters = LETTERS + 1, self.letters
        if code < CODES:
            return letters[code // size ** 2] + letters[code // size % size] + letters[code % size]
        code -= CODES
        if code < size * size:
            return letters[code // size] + letters[code % size]
        return letters[code - size * size]

    def of(self, text: str) -> np.ndarray:
        """Numbers of all n-grams of a text, repeated as they repeat."""
        text = text.lower()
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        codes = self.codes[points]
        if (codes >= 254).any():
            for point in np.unique(points[codes == 255]).tolist():
                if not chr(point).isalpha():
                    self.codes[point] = 0
                elif len(self.letters) <= LETTERS:
                    self.codes[point] = len(self.letters)
                    self.letters.append(chr(point))
                else:
                    self.codes[point] = 254
            codes = self.codes[points]
            if (codes == 254).any():
                return np.array([self.number(g) for g in grams_of(text)], np.int64)
        size = LETTERS + 1
        c = np.zeros(len(codes) + 2, np.int32)
        c[1:-1] = codes
        pair = c[:-1] * size + c[1:]
        inner = np.flatnonzero(codes)
        found = np.concatenate([CODES + size * size + c[inner + 1], CODES + pair[pair > 0],
                                pair[inner] * size + c[inner + 2]])
        numbers = self.known[found]
        if (numbers < 0).any():
            for code in np.unique(found[numbers < 0]).tolist():
                self.known[code] = self.number(self.name(code))
            numbers = self.known[found]
        return numbers


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    grams, held = Grams(), {}

    def drained() -> pa.RecordBatch:
        cols: tuple[list, list, list] = ([], [], [])
        for lang, counts in held.items():
            found = np.flatnonzero(counts)
            cols[0].extend([lang] * len(found))
            cols[1].extend(grams.names[i] for i in found)
            cols[2].extend(counts[found].tolist())
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.string()),
                                           pa.array(cols[2], pa.int64())], ["lang", "gram", "n"])

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            new = np.bincount(grams.of(text))
            old = held.get(lang)
            if old is None or len(old) < len(new):
                new[:0 if old is None else len(old)] += 0 if old is None else old
                held[lang] = new
            else:
                old[:len(new)] += new
            if len(held) * len(grams.names) > 8 * HELD_GRAMS or len(grams.names) > HELD_GRAMS:
                yield drained()
                grams = Grams()
    yield drained()


def fit_profiles(docs: DataFrame, lang_col: str = "lang", text_col: str = "text",
                 length: int = PROFILE) -> dict[str, list[str]]:
    """Language -> its ``length`` most frequent n-grams in rank order, from all rows of ``docs``.

    What reaches the driver is ``length`` n-grams per language."""
    prepare(docs.sparkSession)
    texts = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).dropna()
    counts = texts.mapInArrow(_count_grams, "lang string, gram string, n bigint") \
        .groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = counts.withColumn("at", F.row_number().over(order)).filter(F.col("at") <= length)
    profiles: dict[str, dict[int, str]] = {}
    for r in top.select("lang", "gram", "at").collect():
        profiles.setdefault(r["lang"], {})[r["at"]] = r["gram"]
    return {lang: [g for _, g in sorted(p.items())] for lang, p in sorted(profiles.items())}


class Identifier:
    """Out-of-place comparison of texts with the profiles."""

    def __init__(self, profiles: dict[str, list[str]], length: int):
        self.langs, self.length = sorted(profiles), length
        self.places: dict[str, np.ndarray] = {}  # rank of an n-gram in each profile; the length where it has none
        for k, lang in enumerate(self.langs):
            for at, g in enumerate(profiles[lang]):
                self.places.setdefault(g, np.full(len(self.langs), length))[k] = at
        self.restart()

    def restart(self) -> None:
        self.grams = Grams()
        self.ranks = np.zeros((0, len(self.langs)), np.int64)

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.langs:
            return UNKNOWN, 0.0
        if len(self.grams.names) > HELD_GRAMS:
            self.restart()
        counts = np.bincount(self.grams.of(text))
        found = np.flatnonzero(counts)
        if not len(found):
            return UNKNOWN, 0.0
        if len(self.ranks) < len(self.grams.names):
            none = np.full(len(self.langs), self.length)
            more = [self.places.get(g, none) for g in self.grams.names[len(self.ranks):]]
            self.ranks = np.concatenate([self.ranks, np.array(more, np.int64)])
        counts = counts[found]
        ordered = np.sort(counts)
        rank = len(ordered) - np.searchsorted(ordered, counts, "right")
        top = rank < self.length
        found, rank = found[top], rank[top]
        theirs = self.ranks[found]
        away = np.where(theirs == self.length, self.length, np.abs(theirs - rank[:, None])).sum(0)
        best = int(away.argmin())
        return self.langs[best], float(1 - away[best] / (self.length * len(found)))


def identify(text: Column, profiles: dict[str, list[str]], length: int = PROFILE) -> Column:
    """struct<lang, score> of a text column."""

    @F.arrow_udf("struct<lang:string,score:double>")
    def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = Identifier(profiles, length)
        for texts in batches:
            found = [model.predict(t) for t in texts.to_pylist()]
            yield pa.StructArray.from_arrays([pa.array([x for x, _ in found], pa.string()),
                                              pa.array([y for _, y in found], pa.float64())], ["lang", "score"])

    return judge(text)


def training_rows(docs: DataFrame, id_col: str = "doc_id", folds: int = 4, held: int = 2) -> DataFrame:
    return docs.filter(crc_mod(id_col, folds) != held)


def report(docs: DataFrame, id_col: str = "doc_id", folds: int = 4, held: int = 2) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score."""
    profiles = fit_profiles(training_rows(docs, id_col, folds, held))
    judged = docs.select(F.col(id_col), F.col("text"), (crc_mod(id_col, folds) == held).alias("held_out")) \
        .withColumn("__lang", identify(F.col("text"), profiles))
    return judged.select(F.col(id_col), "held_out", F.col("__lang")["lang"].alias("lang_pred"),
                         F.col("__lang")["score"].alias("score"))


def keep_identified(docs: DataFrame, training: DataFrame, accepted: list[str] | None = None,
                    least: float = 0.0) -> DataFrame:
    """The documents whose language is known (and among ``accepted``, when given) with a score of ``least`` or more."""
    profiles, judged = fit_profiles(training), fresh(docs, "language")
    verdict = F.col(judged)
    keep = (verdict["lang"] != UNKNOWN) & (verdict["score"] >= least)
    if accepted is not None:
        keep &= verdict["lang"].isin(accepted)
    return docs.withColumn(judged, identify(F.col("text"), profiles)).filter(keep) \
        .select(*[F.col(f"`{c}`") for c in docs.columns])


ship_by_value(__name__)
