"""Alignment of two tokenizers over the same texts, and how often their ids are linked.

Tokenizer A (byte-level BPE) reads a space and the text, tokenizer B (sentencepiece) the text, before which it puts the space itself.
Both give bytes: A's entries byte-level decoded, B's pieces in UTF-8 with U+2581 as a space and <0xHH> as that byte. Where tokens of
both end at the same byte, the text is cut into groups, and those two tokens are linked.

A batch of documents is one Arrow pipeline: the token lists are flattened with their parent indices; token lengths are taken from
a table by id and summed up, less the sum before the document, to the end of each token in its document; an Acero hash join on
document-end keys gives the links; their positions cut the tokens into groups, joined to text list by list; ``Table.group_by`` counts
the id pairs, first a document, then over many documents, and Spark adds up these partial counts.

An id pair's count is the number of links in the whole corpus that hold it. Pairs with at least 1/``FREQUENT`` of all links (so at
most ``FREQUENT`` pairs) are sent to the tasks; the others, each rare, are joined by pair.

Edge cases: texts that are null, empty, or whose A or B bytes are not the space and the text (as where a text holds U+2581) have no
tokens: zeros and an empty ``groups``. Strings of special tokens in a text are plain text. Every token has a byte at least, so no two tokens
of a side end together and a group has one link. Repeated rows count each and each get a row; null ids stay null; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType
from tokenizers import Tokenizer

from finsight.llm.common import prepare, ship_by_value, written
from finsight.llm.subwords import byte_level_encode, byte_table, listed, piece_encoder

TOKENIZER_A = "/opt/tokenizers/byte_bpe_50k.json"
TOKENIZER_B = "/opt/tokenizers/piece_bpe_32k.model"
FREQUENT = 1 << 17
HELD_PAIRS = 1 << 20
SLICE_BYTES = 1 << 20  # of text in one run of the pipeline (a longer text is a run of its own)
PAIR = 1 << 32  # a pair of ids is a * PAIR + b
END = 1 << 32  # a document-end key is document * END + end
#: Pairs recur from document to document: a large dictionary page lets the file hold short references.
PAIR_FILES = {"compression": "zstd", "parquet.dictionary.page.size": str(8 << 20)}
COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def piece_table(model: sentencepiece.SentencePieceProcessor) -> pa.Array:
    """Bytes of each id of a sentencepiece model."""
    return pa.array([bytes([int(p[3:-1], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode()
                     for i in range(model.get_piece_size()) for p in [model.id_to_piece(i)]], pa.binary())


class Aligner:
    """Both tokenizers and the bytes of their ids."""

    def __init__(self, a: bytes, b: bytes):
        model = sentencepiece.SentencePieceProcessor(model_proto=b)
        encode = byte_level_encode(a)
        self.encoders = (lambda texts: listed(encode([" " + t for t in texts])), piece_encoder(b).ids)
        self.bytes = pa.array(byte_table(Tokenizer.from_buffer(a)), pa.binary()), piece_table(model)
        self.lengths = tuple(pc.cast(pc.binary_length(t), pa.int64()) for t in self.bytes)

    def lists(self, texts: list[str]) -> tuple[pa.Array, list[pa.ListArray]]:
        """Which texts both tokenizers give back byte for byte, and the token lists of these."""
        sides = [pa.LargeListArray.from_arrays(pa.array(offsets), pa.array(flat)) for flat, offsets in
                 (encode(texts) for encode in self.encoders)]
        whole = pa.array([b" " + t.encode() for t in texts], pa.large_binary())
        good = pc.fill_null(pc.not_equal(pc.binary_length(whole), 1), False)
        for side, table in zip(sides, self.bytes, strict=True):
            pieces = pc.take(table, side.flatten()).cast(pa.large_binary())
            joined = pc.binary_join(pa.LargeListArray.from_arrays(side.offsets, pieces), pa.scalar(b"", pa.large_binary()))
            good = pc.and_(good, pc.equal(joined, whole))
        return good, [side.filter(good) for side in sides]

    def ends(self, side: pa.ListArray, lengths: pa.Array, start: pa.Array, id_name: str) -> pa.Table:
        """A row per token: the key of its document and where it ends in it, its place in the flat list, and its id."""
        flat = side.flatten()
        doc = pc.list_parent_indices(side)
        end = pc.subtract(pc.cumulative_sum(pc.take(lengths, flat)), pc.take(start, doc))
        return pa.table({"key": pc.add(pc.multiply(doc, END), end), f"at_{id_name}": np.arange(len(flat), dtype=np.int32), id_name: flat})

    def align(self, texts: list[str | None]) -> dict[str, pa.Array]:
        """Columns n_a, n_b, n_groups, n_links, groups, pairs and times (how often the document links each pair)."""
        good, (la, lb) = self.lists([t or "" for t in texts])
        n = len(la)
        size = pc.cast(pc.binary_length(pa.array([t.encode() for t, g in zip(texts, good.to_pylist(), strict=True) if g], pa.large_binary())), pa.int64())
        size = pc.add(size, 1)
        start = pc.subtract(pc.cumulative_sum(size), size)
        ta, tb = self.ends(la, self.lengths[0], start, "a"), self.ends(lb, self.lengths[1], start, "b")
        links = ta.join(tb, keys="key", join_type="inner", use_threads=False).sort_by("at_a")
        doc = links["key"].to_numpy() // END
        per_doc = np.bincount(doc, minlength=n)

        def joined(values: pa.Array, border: np.ndarray, separator: str) -> pa.Array:
            """The strings up to each border (its place is the last of its list) as one."""
            offsets = pa.array(np.concatenate([[0], border + 1]).astype(np.int64))
            return pc.binary_join(pa.LargeListArray.from_arrays(offsets, values), pa.scalar(separator, pa.large_string()))

        group = pc.binary_join_element_wise(
            *(joined(side.flatten().cast(pa.large_string()), links[f"at_{name}"].to_numpy(), ",") for side, name in ((la, "a"), (lb, "b"))),
            pa.scalar("|", pa.large_string()))
        groups = joined(group, np.cumsum(per_doc) - 1, ";")
        pair = pc.add(pc.multiply(links["a"].cast(pa.int64()), PAIR), links["b"].cast(pa.int64()))
        counted = pa.table({"doc": doc, "pair": pair}).group_by(["doc", "pair"], use_threads=False) \
            .aggregate([([], "count_all")]).sort_by([("doc", "ascending"), ("pair", "ascending")])
        runs = pa.array(np.searchsorted(counted["doc"].to_numpy(), np.arange(n + 1)).astype(np.int32))
        lists = [pa.ListArray.from_arrays(runs, counted[c].combine_chunks().cast(pa.int64())) for c in ("pair", "count_all")]
        found = {"n_a": pc.list_value_length(la), "n_b": pc.list_value_length(lb), "n_groups": pa.array(per_doc), "n_links": pa.array(per_doc),
                 "groups": groups.cast(pa.string()), "pairs": lists[0], "times": lists[1]}
        # back to all texts: those without tokens take the row behind the last
        row = np.where(good.to_numpy(zero_copy_only=False), np.cumsum(good.to_numpy(zero_copy_only=False)) - 1, n)
        nothing = {k: pa.array([0], pa.int64()) for k in COUNTS} | {"groups": pa.array([""])} \
            | {k: pa.array([[]], pa.list_(pa.int64())) for k in ("pairs", "times")}
        return {k: pa.concat_arrays([found[k].cast(v.type), v]).take(pa.array(row)) for k, v in nothing.items()}


def slices(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Runs of rows whose texts are about SLICE_BYTES."""
    begin, held = 0, 0
    for k, t in enumerate(texts):
        held += len(t or "")
        if held >= SLICE_BYTES:
            yield begin, k + 1
            begin, held = k + 1, 0
    if begin < len(texts):
        yield begin, len(texts)


def align(docs: DataFrame, tokenizer_a: str = TOKENIZER_A, tokenizer_b: str = TOKENIZER_B, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """Per document: ``id_col``, n_a, n_b, n_groups, n_links, groups (text), pairs and times (links of each id pair)."""
    spark = prepare(docs.sparkSession)
    chosen = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    longs = ArrayType(LongType())
    schema = StructType([chosen.schema["id"], *(StructField(c, LongType()) for c in COUNTS), StructField("groups", StringType()),
                         StructField("pairs", longs), StructField("times", longs)])
    files = spark.sparkContext.broadcast((Path(tokenizer_a).read_bytes(), Path(tokenizer_b).read_bytes()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = None
        for batch in batches:
            aligner = aligner or Aligner(*files.value)
            texts = batch.column(1).to_pylist()
            for lo, hi in slices(texts):
                got = aligner.align(texts[lo:hi])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), *got.values()], schema.names)

    return chosen.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def _partial_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of each pair in many documents."""
    held: pa.Table | None = None
    for batch in batches:
        some = pa.table({"pair": batch.column(0).flatten(), "n": batch.column(1).flatten()})
        held = some if held is None else pa.concat_tables([held, some])
        held = held.group_by("pair", use_threads=False).aggregate([("n", "sum")]).rename_columns(["pair", "n"])
        if len(held) > HELD_PAIRS:
            yield from held.combine_chunks().to_batches()
            held = None
    if held is not None:
        yield from held.combine_chunks().to_batches()


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, n, best) over all documents; best: no pair with the same B id has more links (ties are all best)."""
    counts = aligned.select("pairs", "times").mapInArrow(_partial_counts, "pair bigint, n bigint") \
        .groupBy("pair").agg(F.sum("n").alias("n"))
    same_b = Window.partitionBy(F.col("pair") % F.lit(PAIR))  # at most one row an A id
    return counts.withColumn("best", F.col("n") == F.max("n").over(same_b))


def scored(aligned: DataFrame, counts: DataFrame, key: str) -> DataFrame:
    """``aligned`` (with a unique ``key``) and per document n_best and count_sum over its links."""
    spark = aligned.sparkSession
    total = counts.agg(F.sum("n")).first()[0] or 0
    often = F.col("n") * FREQUENT >= F.lit(total)
    top = counts.where(often).toArrow().sort_by("pair") if total else None  # at most FREQUENT rows
    known = spark.sparkContext.broadcast([top[c].to_numpy() for c in ("pair", "n", "best")] if top is not None
                                         else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)])

    def found(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The pairs, their place among the frequent ones, and whether they are there."""
        flat, table = lists.flatten().to_numpy(), known.value[0]
        at = np.minimum(np.searchsorted(table, flat), max(len(table) - 1, 0))
        return flat, at, (table[at] == flat) if len(table) else np.zeros(len(flat), bool)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, at, there = found(batch.column(1))
            times, doc = batch.column(2).flatten().to_numpy()[there], batch.column(1).value_parent_indices().to_numpy()[there]
            _, n, best = known.value
            add = [np.zeros(batch.num_rows, np.int64) for _ in range(2)]
            for out, value in zip(add, (best, n), strict=True):
                np.add.at(out, doc, times * value[at[there]])
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, add)], ["key", "n_best", "count_sum"])

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, _, there = found(batch.column(1))
            doc = batch.column(1).value_parent_indices().to_numpy()[~there]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(doc)), pa.array(flat[~there]),
                                              batch.column(2).flatten().filter(pa.array(~there))], ["key", "pair", "times"])

    lists = aligned.select(F.col(key).alias("key"), "pairs", "times")
    frequent = lists.mapInArrow(sums, "key bigint, n_best bigint, count_sum bigint")
    rare = lists.mapInArrow(others, "key bigint, pair bigint, times bigint").join(counts.where(~often), "pair") \
        .select("key", F.when(F.col("best"), F.col("times")).otherwise(0).alias("n_best"),
                (F.col("times") * F.col("n")).alias("count_sum"))
    sums_of = frequent.unionByName(rare).groupBy("key").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return aligned.drop("pairs", "times").join(sums_of.withColumnRenamed("key", key), key)


def report(docs: DataFrame, **options) -> DataFrame:
    """Per document the counts, n_best, count_sum, and the hash of its groups."""
    found = align(docs, **options)
    digest = F.when(F.col("groups") == "", F.lit("")).otherwise(F.sha2("groups", 256))
    kept = written(found.withColumn("groups", digest).withColumnRenamed("groups", "groups_sha256")
                   .withColumn("row", F.monotonically_increasing_id()), **PAIR_FILES)
    out = scored(kept, written(pair_counts(kept)), "row")
    return out.select(found.columns[0], *COUNTS, "n_best", "count_sum", "groups_sha256")


ship_by_value(__name__)
