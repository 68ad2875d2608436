"""Mixture-controlled packing: deficit round-robin over source queues into windows of a fixed number of tokens.

A document is its subword ids and one end id. Every source is a queue of documents in the order of the table's files. The queues
are visited in turn, each earns tokens by its target share, and one whose deficit covers a grain of ``grain`` tokens hands it
out, until the window is full; what is left of the deficits goes on to the next window. So after any number of windows each queue is
within a grain or so of its share. In a window a queue's grains lie together. The windows in a row are one stream of tokens that is cut every ``window`` tokens
(the last grain of a queue may be shorter, which moves the cuts by less than a grain). A queue that has run dry is passed over and
the others fill the windows. The tail of the stream, less than a window, is cut into powers of two, so nothing is padded.

What a queue has earned and given when a window is full follows from the shares alone, so the position of any grain follows from its
place in its queue: every partition starts with the deficits of the one before without waiting for it. Places in a queue are running sums
in a task plus the tokens of the tasks before (one row a task and source). A source with less than 1/``OWN`` of all tokens and no target
of its own shares one of ``OWN`` queues with others, so the schedule is at most 2 ``OWN`` numbers (and the targets) however many sources there are.

``targets`` maps sources to shares. Sources not named split what the named ones leave of 1 (at least 1/1000) by their tokens;
without targets every source gets its share of all tokens. Shares below 1e-9 count as 1e-9, so no queue starves.

Edge cases: a null or empty text is its end id alone. A null source is a source of its own. Repeated rows are packed each on its own; null ids
stay null. An empty table gives no rows. Every id of every document lies in exactly one piece.
"""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from finsight.llm.common import prepare, ship_by_value, written
from finsight.llm.subwords import word_encoder

TOKENIZER = "/opt/tokenizers/word_bpe_49k.json"
WINDOW, GRAIN, END_ID = 2048, 64, 1
OWN = 1024
LEAST_SHARE, LEFT_SHARE = 1e-9, 1e-3
#: A frame of at most so many rows (about 100 bytes each) is broadcast; a longer one is joined by shuffling.
BROADCAST_ROWS = 100_000


class Schedule:
    """Where each queue's tokens lie in the stream. Time is counted in grains earned by all queues together."""

    def __init__(self, totals: np.ndarray, shares: np.ndarray, window: int, grain: int):
        self.totals, self.grain, self.window = totals.astype(np.int64), grain, window
        self.rates = np.maximum(shares / max(shares.sum(), LEAST_SHARE), LEAST_SHARE)  # grains earned in a unit of time
        self.grains = -(-self.totals // grain)
        self.fill = window // grain  # grains of a window
        self.size = int(self.totals.sum())
        left = self.size % window
        tail = [1 << b for b in range(window.bit_length(), -1, -1) if left >> b & 1]
        self.body = self.size - left
        self.tail = self.body + np.concatenate([[0], np.cumsum(tail)]).astype(np.int64)  # borders behind the body

    def earned(self, time: np.ndarray) -> np.ndarray:
        """Whole grains covered by each queue's deficit at a time (a row each)."""
        return np.minimum(np.floor(time[:, None] * self.rates), self.grains).astype(np.int64)

    def given(self, windows: np.ndarray) -> np.ndarray:
        """Grains that each queue has handed out when so many windows are full (a row each).

        The windows are full at the first time whose earned grains suffice; of queues that earn one at that very time the first ones give."""
        need = np.minimum(windows.astype(np.int64) * self.fill, self.grains.sum())
        high = np.full(len(need), 2 + 2 * (self.grains / self.rates).max(initial=0))
        low = np.where(need > 0, np.maximum(need / self.rates.sum() * (1 - 1e-9) - 1, 0), high)
        while True:
            middle = (low + high) / 2
            if not ((middle > low) & (middle < high)).any():
                break
            enough = self.earned(middle).sum(axis=1) >= need
            low, high = np.where(enough, low, middle), np.where(enough, middle, high)
        before = self.earned(low)
        before[need == 0] = 0
        more = self.earned(high) - before
        spare = (need - before.sum(axis=1))[:, None] - (np.cumsum(more, axis=1) - more)
        return before + np.clip(spare, 0, more)

    def window_of(self, grain: np.ndarray, queue: np.ndarray) -> np.ndarray:
        """The window (from 0) into which a queue's grain goes."""
        at = self.earned((grain + 1) / self.rates[queue]).sum(axis=1) // self.fill
        while True:  # the estimate is off by a window where queues earn at about the same time
            distinct, inverse = np.unique(at, return_inverse=True)
            rows = np.arange(len(distinct))
            low, high = self.given(distinct), self.given(distinct + 1)
            late, early = low[rows[inverse], queue] > grain, high[rows[inverse], queue] <= grain
            if not (late | early).any():
                return at
            at += early.astype(np.int64) - late

    def place(self, grain: np.ndarray, queue: np.ndarray) -> np.ndarray:
        """Stream position of the first token of each grain."""
        step = max(1, (1 << 22) // max(1, len(self.totals)))  # bounds the tables of windows and queues
        parts = [self._place(grain[lo:lo + step], queue[lo:lo + step]) for lo in range(0, len(grain), step)]
        return np.concatenate(parts) if parts else np.zeros(0, np.int64)

    def _place(self, grain: np.ndarray, queue: np.ndarray) -> np.ndarray:
        distinct, at = np.unique(self.window_of(grain, queue), return_inverse=True)
        before, after = (np.minimum(self.given(w) * self.grain, self.totals) for w in (distinct, distinct + 1))
        held = after - before
        # all earlier windows, the queues before this one in the window, less what the queue had given before
        base = before.sum(axis=1)[:, None] + np.cumsum(held, axis=1) - held - before
        return base[at, queue] + grain * self.grain

    def sequence_of(self, position: np.ndarray) -> np.ndarray:
        late = np.searchsorted(self.tail, position, side="right") - 1
        return np.where(position < self.body, position // self.window, self.body // self.window + late)

    def sequence_start(self, sequence: np.ndarray) -> np.ndarray:
        late = np.clip(sequence - self.body // self.window, 0, len(self.tail) - 1)
        return np.where(sequence * self.window < self.body, sequence * self.window, self.tail[late])

    def sequence_size(self, sequence: np.ndarray) -> np.ndarray:
        return self.sequence_start(sequence + 1) - self.sequence_start(sequence)

    def pieces(self, start: np.ndarray, size: np.ndarray, queue: np.ndarray) -> tuple[np.ndarray, ...]:
        """(document, first token in it, tokens, sequence, offset) of the pieces of documents that lie in their queues from ``start`` on."""
        first, last = start // self.grain, (start + size - 1) // self.grain
        doc = np.repeat(np.arange(len(start)), last - first + 1)
        grain = first[doc] + np.arange(len(doc)) - np.repeat(np.cumsum(last - first + 1) - (last - first + 1), last - first + 1)
        low = np.maximum(start[doc], grain * self.grain)
        high = np.minimum((start + size)[doc], (grain + 1) * self.grain)
        position = self.place(grain, queue[doc]) + low - grain * self.grain
        # grains of a document that follow each other in the stream are one run
        opens = np.ones(len(doc), bool)
        opens[1:] = (doc[1:] != doc[:-1]) | (position[1:] != position[:-1] + (high - low)[:-1])
        at = np.flatnonzero(opens)
        doc, low, position = doc[at], low[at], position[at]
        length = high[np.append(at[1:], len(high)) - 1] - low if len(at) else low
        one, two = self.sequence_of(position), self.sequence_of(position + length - 1)
        run = np.repeat(np.arange(len(doc)), two - one + 1)
        sequence = one[run] + np.arange(len(run)) - np.repeat(np.cumsum(two - one + 1) - (two - one + 1), two - one + 1)
        begin = np.maximum(position[run], self.sequence_start(sequence))
        end = np.minimum((position + length)[run], self.sequence_start(sequence + 1))
        return doc[run], (low - start[doc])[run] + begin - position[run], end - begin, sequence, \
            begin - self.sequence_start(sequence)


def tokenized(docs: DataFrame, tokenizer: bytes, id_col: str, text_col: str, source_col: str, end_id: int) -> DataFrame:
    """id, source, ids (unsigned little-endian 32 bits), n, part (task), key, and the tokens of the same source before it in the task."""
    chosen = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").cast("binary").alias("text"),
                         F.col(source_col).cast("string").alias("source"))
    schema = StructType([chosen.schema["id"], StructField("source", StringType()), StructField("key", StringType()),
                         StructField("ids", BinaryType()), StructField("n", LongType()), StructField("part", LongType()),
                         StructField("before", LongType())])
    shipped = docs.sparkSession.sparkContext.broadcast(tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, encoder, seen = TaskContext.get().partitionId(), None, {}
        for batch in batches:
            encoder = encoder or word_encoder(shipped.value)
            flat, offsets = encoder.ids([t or b"" for t in batch.column(1).to_pylist()])
            sources = batch.column(2).to_pylist()
            keys, ids, sizes, before = [], [], (np.diff(offsets) + 1).tolist(), []
            end = np.asarray([end_id], "<u4").tobytes()
            flat = flat.astype("<u4").tobytes()
            for row, (source, n) in enumerate(zip(sources, sizes, strict=True)):
                keys.append("" if source is None else "=" + source)
                before.append(seen.get(keys[-1], 0))
                seen[keys[-1]] = before[-1] + n
                ids.append(flat[4 * offsets[row]:4 * offsets[row + 1]] + end)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(keys, pa.string()), pa.array(ids, pa.binary()),
                 pa.array(sizes, pa.int64()), pa.array([part] * len(ids), pa.int64()), pa.array(before, pa.int64())],
                schema.names)

    return chosen.mapInArrow(run, schema)


def shares_of(queues: list[str], totals: np.ndarray, targets: dict[str, float] | None) -> np.ndarray:
    """Target share of each queue, not yet brought to a sum of 1."""
    named = {"=" + k: v for k, v in (targets or {}).items()}
    rest = np.asarray([0 if q in named else n for q, n in zip(queues, totals, strict=True)], float)
    left = max(1 - sum(named.values()), LEFT_SHARE)
    return np.asarray([named.get(q, left * r / max(rest.sum(), 1)) for q, r in zip(queues, rest, strict=True)])


def pack(docs: DataFrame, tokenizer: str = TOKENIZER, window: int = WINDOW, grain: int = GRAIN, end_id: int = END_ID,
         targets: dict[str, float] | None = None, id_col: str = "doc_id", text_col: str = "text",
         source_col: str = "source") -> DataFrame:
    """One row per piece: ``id_col``, start, length, ids (binary), doc_tokens, sequence_id, offset, sequence_tokens, source."""
    spark = prepare(docs.sparkSession)
    rows = written(tokenized(docs, Path(tokenizer).read_bytes(), id_col, text_col, source_col, end_id), compression="zstd")
    sums = rows.groupBy("part", "key").agg(F.sum("n").alias("n"))
    total = sums.agg(F.sum("n")).first()[0] or 0
    own = F.sum("n").over(Window.partitionBy("key")) * OWN >= total
    own = own | F.col("key").isin(["=" + t for t in targets]) if targets else own
    shared = F.concat(F.lit("#"), F.pmod(F.xxhash64("key"), F.lit(OWN)).cast("string"))
    ahead = Window.partitionBy("queue").orderBy("key", "part").rowsBetween(Window.unboundedPreceding, -1)
    carry = written(sums.withColumn("queue", F.when(own, F.col("key")).otherwise(shared))
                    .withColumn("ahead", F.coalesce(F.sum("n").over(ahead), F.lit(0))))
    # at most 2 OWN queues and the targets
    lengths = sorted(tuple(r) for r in carry.groupBy("queue").agg(F.sum("n")).collect())
    queues, totals = [q for q, _ in lengths], np.asarray([n for _, n in lengths], np.int64)
    schedule = Schedule(totals, shares_of(queues, totals, targets), window, grain)
    number = {q: k for k, q in enumerate(queues)}
    small = carry.count() <= BROADCAST_ROWS
    carry = carry.drop("n")
    placed = rows.join(F.broadcast(carry) if small else carry, ["part", "key"]) \
        .select("id", "source", "ids", "n", (F.col("before") + F.col("ahead")).alias("start"), "queue")
    schema = StructType([rows.schema["id"], *(StructField(n, LongType()) for n in ("start", "length")), StructField("ids", BinaryType()),
                         *(StructField(n, LongType()) for n in ("doc_tokens", "sequence_id", "offset", "sequence_tokens")),
                         StructField("source", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, start = (batch.column(c).to_numpy(zero_copy_only=False) for c in (3, 4))
            queue = np.asarray([number[q] for q in batch.column(5).to_pylist()], np.int64)
            doc, first, length, sequence, offset = schedule.pieces(start, size, queue)
            ids = batch.column(2).to_pylist()
            cut = [ids[d][4 * a:4 * b] for d, a, b in zip(doc.tolist(), first.tolist(), (first + length).tolist(), strict=True)]
            rows_of = pa.array(doc)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(rows_of), pa.array(first), pa.array(length), pa.array(cut, pa.binary()), pa.array(size[doc]),
                 pa.array(sequence), pa.array(offset), pa.array(schedule.sequence_size(sequence)), batch.column(1).take(rows_of)],
                schema.names)

    return placed.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def report(docs: DataFrame, **options) -> DataFrame:
    """The pieces with a checksum in place of their ids."""
    packed = pack(docs, **options)
    at = packed.columns.index("ids")
    return packed.select(*packed.columns[:at], F.crc32("ids").alias("ids_crc32"), *packed.columns[at + 1:])


ship_by_value(__name__)
