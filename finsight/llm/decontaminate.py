"""Benchmark decontamination: broadcast hash set of normalised test n-grams.

Words are ``[0-9a-z]`` and every non-ASCII character after lower-casing A-Z. Every run of ``n`` consecutive
words of a benchmark item is a window; an item with 1 to n-1 words is one window of that length. Each training
text is scanned once per window length with a rolling hash over word ids; a hash hit is verified
against the words themselves before it counts.

The window set of one pass is bounded: benchmark items are dealt into blocks of at most
``block_words`` words (counted first), each block is broadcast and scanned in turn, and with more than one
block the hits of a document are merged by position. One item longer than a whole block forms a block of its own.

Edge cases: a null or empty text (document or item) has no words, hits nothing and is never hit. Repeated
items keep their separate ids; a null item_id takes part in hits but not in the list of ids. Repeated
document rows each get a row. Columns other than those named are passed through or ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finsight.llm.common import fresh, prepare, ship_by_value, text_bytes

WINDOW = 10
BLOCK_WORDS = 200_000
#: Byte table: A-Z lower-cased, every byte that is no word byte turned into a space.
WORD_TABLE = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256))
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
SCAN_TYPE = "struct<n_words:bigint,n_hit:bigint,starts:array<int>,ends:array<int>,items:array<string>>"


def words_of(data: bytes | None) -> list[bytes]:
    return data.translate(WORD_TABLE).split() if data else []


class WindowSet:
    """Windows of a block of benchmark items, by length: rolling hash -> exact words -> item ids."""

    def __init__(self, items: list[tuple[str | None, bytes | None]], n: int):
        self.ids: dict[bytes, int] = {}
        windows: dict[int, dict[tuple, list]] = {}
        for item, data in items:
            w = words_of(data)
            if not w:
                continue
            length = min(n, len(w))
            for x in w:
                self.ids.setdefault(x, len(self.ids) + 1)
            for at in range(len(w) - length + 1):
                held = windows.setdefault(length, {}).setdefault(tuple(w[at:at + length]), [])
                if not held or held[-1] != item:
                    held.append(item)
        self.tables = []
        for length, found in sorted(windows.items()):
            by_hash: dict[int, list] = {}
            for gram, held in found.items():
                code = int(self.rolling(np.array([self.ids[x] for x in gram], np.uint64), length)[0])
                by_hash.setdefault(code, []).append((gram, held))
            self.tables.append((length, np.array(sorted(by_hash), np.uint64), by_hash))

    @staticmethod
    def rolling(ids: np.ndarray, length: int) -> np.ndarray:
        out = np.zeros(len(ids) - length + 1, np.uint64)
        with np.errstate(over="ignore"):
            for k in range(length):
                out = out * MULTIPLIER + ids[k:k + len(out)]
            out ^= out >> np.uint64(29)
        return out

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Merged hit spans [start, end) in words, and the ids of the items that occur."""
        if not words or not self.tables:
            return [], set()
        known = self.ids
        ids = np.array([known.get(w, 0) for w in words], np.uint64)
        spans, items = [], set()
        gaps = np.concatenate([[0], np.cumsum(ids == 0)])
        for length, hashes, by_hash in self.tables:
            if len(ids) < length:
                continue
            clear = np.flatnonzero(gaps[length:] == gaps[:-length])  # windows made of benchmark words only
            if not len(clear):
                continue
            codes = self.rolling(ids, length)[clear]
            at = np.searchsorted(hashes, codes)
            at[at == len(hashes)] = 0
            for k in np.flatnonzero(hashes[at] == codes):
                start = int(clear[k])
                gram = tuple(words[start:start + length])
                for own, held in by_hash[int(codes[k])]:
                    if own == gram:
                        spans.append((start, start + length))
                        items.update(held)
        return merged(spans), items


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _scanner(shared, n: int):
    kind = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("starts", pa.list_(pa.int32())),
                      ("ends", pa.list_(pa.int32())), ("items", pa.list_(pa.string()))])

    @F.arrow_udf(SCAN_TYPE)
    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        windows = WindowSet(shared.value, n)
        for texts in batches:
            rows = []
            for data in texts:
                words = words_of(data.as_py())
                spans, items = windows.scan(words)
                rows.append({"n_words": len(words), "n_hit": sum(b - a for a, b in spans),
                             "starts": [a for a, _ in spans], "ends": [b for _, b in spans],
                             "items": sorted(x for x in items if x is not None)})
            yield pa.array(rows, kind)

    return scan


def benchmark_blocks(benchmark: DataFrame, block_words: int, item_col: str, text_col: str) -> list[DataFrame]:
    """Benchmark rows dealt by hash into as many blocks as keep a block near ``block_words`` words."""
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), text_bytes(text_col).alias("data"))
    size = items.agg(F.coalesce(F.sum(F.length("data")), F.lit(0)).alias("b")).first()["b"]
    count = max(1, -(-int(size) // (6 * block_words)))
    if count == 1:
        return [items]
    deal = F.pmod(F.xxhash64("item", "data"), F.lit(count))
    return [items.filter(deal == k) for k in range(count)]


def scan_documents(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, block_words: int = BLOCK_WORDS,
                   text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
                   out: str = "scan") -> DataFrame:
    """``docs`` with a struct column ``out``: n_words, n_hit, starts, ends (hit word spans), items."""
    spark = prepare(docs.sparkSession)
    scans = []
    for block in benchmark_blocks(benchmark, block_words, item_col, item_text_col):
        shared = spark.sparkContext.broadcast([(r["item"], None if r["data"] is None else bytes(r["data"]))
                                               for r in block.collect()])  # at most one block
        scans.append(_scanner(shared, n)(text_bytes(text_col)))
    if len(scans) == 1:
        return docs.withColumn(out, scans[0])
    return docs.withColumn(out, _merge()(*scans))


def _merge():
    @F.udf(SCAN_TYPE)
    def merge(*parts):
        spans = merged([s for p in parts for s in zip(p["starts"], p["ends"], strict=True)])
        return (parts[0]["n_words"], sum(b - a for a, b in spans), [a for a, _ in spans], [b for _, b in spans],
                sorted({x for p in parts for x in p["items"]}))

    return merge


def report(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    scanned = scan_documents(docs.select(id_col, options.get("text_col", "text")), benchmark, out="__scan", **options)
    s = F.col("__scan")
    return scanned.select(
        F.col(id_col), s["n_words"].alias("n_words"), s["n_hit"].alias("n_hit"),
        F.size(s["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(s["items"], ","), 256).alias("items_sha256"),
        (s["n_hit"] > 0).alias("contaminated"))


def clean_documents(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents in which no benchmark window occurs, with their own columns."""
    out = fresh(docs, "scan")
    scanned = scan_documents(docs, benchmark, out=out, **options)
    return scanned.filter(F.col(out)["n_hit"] == 0).select(*[F.col(f"`{c}`") for c in docs.columns])


def _cutter():
    @F.arrow_udf("string")
    def cut(texts: pa.Array, starts: pa.Array, ends: pa.Array) -> pa.Array:
        return pa.array([_without(t, a, b) for t, a, b in
                         zip(texts.to_pylist(), starts.to_pylist(), ends.to_pylist(), strict=True)], pa.string())

    return cut


def _without(data: bytes | None, starts: list[int], ends: list[int]) -> str | None:
    if data is None:
        return None
    if not starts:
        return data.decode()
    spaced, at, bounds = data.translate(WORD_TABLE), 0, []
    for word in spaced.split():
        at = spaced.index(word, at)
        bounds.append((at, at + len(word)))
        at += len(word)
    out, last = [], 0
    for a, b in zip(starts, ends, strict=True):
        out.append(data[last:bounds[a][0]])
        last = bounds[b - 1][1]
    return b"".join([*out, data[last:]]).decode()


def remove_spans(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """All documents; from the text of each the hit spans are cut, from first to last hit word."""
    scanned = scan_documents(docs, benchmark, text_col=text_col, out="__scan", **options)
    s = F.col("__scan")
    cut = _cutter()(text_bytes(text_col), s["starts"], s["ends"])
    return scanned.select(*[cut.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns])


ship_by_value(__name__)
