"""Best-fit packing of documents into training sequences, with conflicts.

A document has one token per word and one end token. Documents longer than ``capacity`` are cut into pieces of
``capacity`` tokens, the last one shorter; nothing is dropped. A bin holds at most ``capacity`` tokens, and no two pieces of the same source
or of the same duplicate cluster (by default: texts with the same words, A-Z lower-cased).

The pieces are dealt by hash into blocks of about ``block`` pieces, so every source and every cluster is spread over
all blocks and a block is packed in one task, whatever a source holds. In a block, pieces go from the
largest to the smallest. Bins are kept in order of their residual; each carries a bitmap of the sources and one of the clusters it
holds. A piece looks up the first bin whose residual is enough and goes on to the successors until the bitmaps allow
one: the tightest compatible bin. If none does, it opens a bin.

Edge cases: a null or empty text is its end token and has no cluster; a null source conflicts with nothing. Equal
sizes go by id, then piece, and equal residuals by age of the bin. Repeated rows are packed each on its own; pieces of one document
share its cluster and therefore never a bin. An empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finsight.llm.common import prepare, ship_by_value, written

CAPACITY = 2048
BLOCK = 4096
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PACKED = "id string, piece long, size long, cluster binary, source string, bin_id long, bin_offset long"


def pack_block(pieces: list[tuple[int, object, object]], capacity: int) -> list[tuple[int, int]]:
    """(bin, offset) for each (size, source, cluster), in the order given."""
    residuals: list[tuple[int, int]] = []  # (residual, bin), in order
    sources: list[int] = []
    clusters: list[int] = []
    bits: tuple[dict, dict] = ({}, {})
    out = []
    for size, source, cluster in pieces:
        s = 0 if source is None else 1 << bits[0].setdefault(source, len(bits[0]))
        c = 0 if cluster is None else 1 << bits[1].setdefault(cluster, len(bits[1]))
        at = bisect_left(residuals, (size, -1))
        while at < len(residuals) and (sources[(b := residuals[at][1])] & s or clusters[b] & c):
            at += 1
        if at < len(residuals):
            left, b = residuals.pop(at)
        else:
            left, b = capacity, len(sources)
            sources.append(0)
            clusters.append(0)
        out.append((b, capacity - left))
        sources[b] |= s
        clusters[b] |= c
        insort(residuals, (left - size, b))
    return out


def items_of(docs: DataFrame, id_col: str, text_col: str, source_col: str, cluster_col: str | None) -> DataFrame:
    """id, tokens, source, cluster of each document."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    words = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))
    plain = F.trim(F.regexp_replace(F.translate(text, UPPER, LOWER), r"[\x20\x09-\x0D]+", " "))
    cluster = F.unhex(F.md5(plain)) if cluster_col is None else F.unhex(F.md5(F.col(cluster_col).cast("string")))
    return docs.select(F.col(id_col).alias("id"), (words + 1).cast("long").alias("tokens"),
                       F.col(source_col).cast("string").alias("source"),
                       (F.when(words > 0, cluster) if cluster_col is None else cluster).alias("cluster"),
                       F.monotonically_increasing_id().alias("row"))


def pack(docs: DataFrame, capacity: int = CAPACITY, block: int = BLOCK, id_col: str = "doc_id", text_col: str = "text",
         source_col: str = "source", cluster_col: str | None = None) -> DataFrame:
    """One row per piece: ``id_col``, piece, first_token, n_tokens, source, bin_id, bin_offset."""
    prepare(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    items = written(items_of(docs, id_col, text_col, source_col, cluster_col))
    cut = items.withColumn("piece", F.explode(F.sequence(F.lit(0), F.floor((F.col("tokens") - 1) / capacity)))) \
        .withColumn("size", F.least(F.col("tokens") - F.col("piece") * capacity, F.lit(capacity)).cast("long"))
    total = items.agg(F.sum(F.floor((F.col("tokens") - 1) / capacity) + 1).alias("n")).first()["n"] or 0
    blocks = max(1, -(-int(total) // block))
    key = F.xxhash64(F.coalesce(F.col("id").cast("string"), F.concat(F.lit("row "), F.col("row").cast("string"))),
                     "cluster", "piece")
    dealt = cut.select(F.col("id").cast("string").alias("id"), "piece", "size", "cluster", "source",
                       F.pmod(key, F.lit(blocks)).alias("block"), "row")

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each():
            for batch in batches:
                yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

        for number, rows in groupby(each(), key=lambda r: r[5]):  # about ``block`` pieces
            rows = list(rows)
            placed = pack_block([(r[2], r[4], r[3]) for r in rows], capacity)
            cols = list(zip(*[(*r[:5], (number << 24) + b, at) for r, (b, at) in zip(rows, placed, strict=True)],
                            strict=True))
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                                             ["id", "piece", "size", "cluster", "source", "bin_id", "bin_offset"])

    packed = dealt.repartition("block").sortWithinPartitions("block", F.desc("size"), "id", "piece", "row") \
        .mapInArrow(fill, PACKED)
    return packed.select(F.col("id").cast(kind).alias(id_col), "piece",
                         (F.col("piece") * capacity).alias("first_token"), F.col("size").alias("n_tokens"),
                         "source", "bin_id", "bin_offset")


ship_by_value(__name__)
