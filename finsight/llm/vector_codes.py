"""Product quantisation of vectors: integer k-means on each of ``PARTS`` parts, with adaptive distance bounds.

Components become integers, floor(1024 x); each part of a vector is coded by the nearest entry of that part's codebook (squared Euclidean
distance, ties to the lower index). Codebooks start as the parts of the smallest ids and are refined in ``ROUNDS`` rounds: assign, then
replace each entry by the floored mean of its parts (entries without parts stay).

Between rounds every part keeps its entry, an upper bound of the distance to it, its b closest other entries with ordered lower
bounds, and one outer bound for all the rest, stored with the vector. When the entries have moved, the bounds are widened by how far. An entry is
left out only if its lower bound lies above the upper bound, with a margin for rounding; the first entries for which that is not certain are verified
by their integer distances, all entries if even the outer bound is too low, and the verified ones get exact bounds again. Ties are
never decided by a bound. b is adapted each round: to what the parts needed in the last one, or twice as many when too many fell through to all entries.

Sums and counts of entries are added up in the tasks and by Spark; ``PARTS`` times ``ENTRIES`` rows reach the driver a round. The state of a
round is a table in the shared checkpoint folder; the one before is deleted when it is there.

Edge cases: vectors that are null or hold null or non-finite components are dropped. Equal ids are ordered by their vectors, null ids come last; repeated
rows count each. With fewer vectors than entries the codebooks are as long as there are vectors. A vector whose length is not that of the first kept one
(smallest id), or is no multiple of ``PARTS``, cannot be cut: it stays, with null code and errors. Components beyond the range in which squared
distances fit a long (|x| above 131 072 for 64 components) count as its border. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructField, StructType

from finsight.llm.common import discard, prepare, ship_by_value, written

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024.0
FIRST_B, LEAST_B, MOST_B = 8, 2, 16
#: Share of rows that may fall through to all entries before b is doubled, and of those that b should serve.
THROUGH, SERVED = 0.25, 0.95
#: A label with at least 1/HOT of all rows gets its sum by broadcast (at most HOT rows), the others by a join.
HOT = 1024
MARGIN = 2.0 ** -20
FAR = 1e30  # no bound: above every distance


def up(x: np.ndarray) -> np.ndarray:
    """A 32-bit number that is certainly not below the exact value."""
    return (x + np.abs(x) * MARGIN + MARGIN).astype(np.float32)


def down(x: np.ndarray) -> np.ndarray:
    return (x - np.abs(x) * MARGIN - MARGIN).astype(np.float32)


def squared(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances (points by entries) in 64-bit integers."""
    most = max(int(np.abs(points).max(initial=0)), int(np.abs(entries).max(initial=0)))
    if 4 * points.shape[1] * most * most < 1 << 52:  # every intermediate sum is a whole number that a double holds
        p, e = points.astype(float), entries.astype(float)
        return ((p * p).sum(1)[:, None] - 2 * (p @ e.T) + (e * e).sum(1)).astype(np.int64)
    out = np.zeros((len(points), len(entries)), np.int64)
    for d in range(points.shape[1]):
        out += (points[:, d, None] - entries[None, :, d]) ** 2
    return out


def state_type(b: int) -> np.dtype:
    return np.dtype([("entry", "u1"), ("upper", "<f4"), ("outer", "<f4"), ("near", "u1", (b,)), ("low", "<f4", (b,))])


def search_all(points: np.ndarray, entries: np.ndarray, state: np.ndarray) -> np.ndarray:
    """Fill ``state`` from the distances to all entries; gives the squared distance to the nearest."""
    d2 = squared(points, entries)
    rows = np.arange(len(points))
    nearest = d2.argmin(axis=1)  # the first of equal ones
    best = d2[rows, nearest]
    state["entry"], state["upper"] = nearest, up(np.sqrt(best))
    d2[rows, nearest] = np.iinfo(np.int64).max
    b, others = state["near"].shape[1], len(entries) - 1
    order = np.argpartition(d2, min(b, others), axis=1)[:, :b + 1] if others > b else np.argsort(d2, axis=1)[:, :others]
    d = np.take_along_axis(d2, order, 1)
    sort = np.argsort(d, axis=1)
    order, d = np.take_along_axis(order, sort, 1), np.sqrt(np.take_along_axis(d, sort, 1))
    state["near"], state["low"], state["outer"] = nearest[:, None], FAR, FAR
    held = min(b, others)
    state["near"][:, :held], state["low"][:, :held] = order[:, :held], down(d[:, :held])
    if others > b:
        state["outer"] = down(d[:, b])
    return best


def search_bounded(points: np.ndarray, entries: np.ndarray, moved: np.ndarray, old: np.ndarray, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(new state, squared distance or -1 where it was not needed, how many bounds were needed; b + 1: all entries)."""
    held = old["near"].shape[1]
    near, low = old["near"], down(old["low"] - moved[old["near"]])
    outer = down(old["outer"] - moved.max())
    upper = up(old["upper"] + moved[old["entry"]])
    state = np.zeros(len(old), state_type(b))
    state["entry"], state["near"], state["low"] = old["entry"], old["entry"][:, None], FAR
    if b < held:  # what is given up goes under the outer bound
        outer = np.minimum(outer, low[:, b:].min(axis=1))
    low = np.minimum(np.minimum.accumulate(low[:, ::-1], axis=1)[:, ::-1], outer[:, None])
    keep = min(b, held)
    state["near"][:, :keep], state["low"][:, :keep] = near[:, :keep], low[:, :keep]
    d2 = np.full(len(old), -1, np.int64)

    def exact(rows: np.ndarray, ids: np.ndarray) -> np.ndarray:
        return ((points[rows][:, None, :] - entries[ids]) ** 2).sum(axis=2)

    def unsure(rows: np.ndarray) -> np.ndarray:
        """How many leading bounds do not lie above the upper one."""
        return (state["low"][rows] <= upper[rows, None]).sum(axis=1)

    rows = np.flatnonzero((state["low"][:, 0] <= upper) | (outer <= upper))
    if len(rows):  # first make the upper bound exact
        d2[rows] = exact(rows, state["entry"][rows, None])[:, 0]
        upper[rows] = up(np.sqrt(d2[rows]))
    need = np.zeros(len(old), np.int64)
    need[rows] = np.where(outer[rows] <= upper[rows], b + 1, unsure(rows))
    for z in np.unique(need[(need > 0) & (need <= b)]):
        some = np.flatnonzero(need == z)
        ids = np.concatenate([state["entry"][some, None], state["near"][some, :z]], axis=1)
        d = np.concatenate([d2[some, None], exact(some, ids[:, 1:])], axis=1)
        order = np.lexsort((ids, d), axis=1)
        ids, d = np.take_along_axis(ids, order, 1), np.take_along_axis(d, order, 1)
        state["entry"][some], d2[some], upper[some] = ids[:, 0], d[:, 0], up(np.sqrt(d[:, 0]))
        state["near"][some, :z], state["low"][some, :z] = ids[:, 1:], down(np.sqrt(d[:, 1:]))
    state["upper"], state["outer"] = upper, outer
    if len(rows := np.flatnonzero(need > b)):
        fresh = np.zeros(len(rows), state.dtype)
        d2[rows] = search_all(points[rows], entries, fresh)
        state[rows] = fresh
    return state, d2, need


@dataclass
class Codebooks:
    entries: np.ndarray  # part, entry, component
    moved: np.ndarray | None = None  # part, entry: how far each has moved, rounded up

    def replaced(self, sums: np.ndarray, counts: np.ndarray) -> Codebooks:
        fresh = np.where(counts[..., None] > 0, sums // np.maximum(counts, 1)[..., None], self.entries)
        away = np.sqrt(((fresh - self.entries).astype(float) ** 2).sum(axis=2))
        return Codebooks(fresh, np.where((fresh == self.entries).all(axis=2), 0, up(away)).astype(float))


def whole_numbers(vectors: np.ndarray) -> np.ndarray:
    """floor(1024 x), within the range whose squared distances fit a long."""
    border = int((2 ** 62 / max(vectors.shape[-1], 1)) ** 0.5 / 2)
    with np.errstate(over="ignore"):
        return np.clip(np.floor(vectors * SCALE), -border, border).astype(np.int64)


def binary(rows: np.ndarray) -> pa.Array:
    """One value per row of a structured array."""
    width = rows.dtype.itemsize * (rows.shape[1] if rows.ndim > 1 else 1)
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(rows).tobytes())])


def assigned(rows: DataFrame, books: Codebooks, width: int, b_old: int, b: int, last: bool) -> DataFrame:
    """Each vector's state under the codebooks and how many bounds it needed; in the last round its code and error instead."""
    parts, size = books.entries.shape[0], width // books.entries.shape[0]
    first = "state" not in rows.columns
    keys = [rows.schema["id"], rows.schema["label"]]
    new = [StructField("code", BinaryType()), StructField("error", LongType())] if last else \
        [StructField("ints", ArrayType(IntegerType())), StructField("state", BinaryType()), StructField("need", IntegerType())]
    schema = StructType([*keys, *new])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if first:
                flat = whole_numbers(batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, width))
            else:
                flat = batch.column(2).flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)
                old = np.frombuffer(b"".join(batch.column(3).to_pylist()), state_type(b_old)).reshape(-1, parts)
            states, need, error = np.zeros((len(flat), parts), state_type(b)), np.zeros(len(flat), np.int32), np.zeros(len(flat), np.int64)
            for p in range(parts):
                points = flat[:, p * size:(p + 1) * size]
                if first:
                    error += search_all(points, books.entries[p], state := np.zeros(len(flat), state_type(b)))
                else:
                    state, d2, needed = search_bounded(points, books.entries[p], books.moved[p], old[:, p], b)
                    need = np.maximum(need, needed)
                    if last and len(skipped := np.flatnonzero(d2 < 0)):
                        d2[skipped] = ((points[skipped] - books.entries[p][state["entry"][skipped]]) ** 2).sum(axis=1)
                    error += d2
                states[:, p] = state
            if last:
                own = [binary(np.ascontiguousarray(states["entry"])), pa.array(error)]
            else:
                ints = pa.ListArray.from_arrays(np.arange(len(flat) + 1, dtype=np.int32) * width, pa.array(flat.ravel().astype(np.int32)))
                own = [ints, binary(states), pa.array(need.astype(np.int32))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *own], schema.names)

    return rows.select("id", "label", *(["vector"] if first else ["ints", "state"])).mapInArrow(run, schema)


def sums_of(rows: DataFrame, books: Codebooks, b: int) -> tuple[np.ndarray, np.ndarray]:
    """Component sums and counts of each part's entries: at most PARTS x ENTRIES rows."""
    parts, k, size = books.entries.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((parts * k, size), np.int64), np.zeros(parts * k, np.int64)
        for batch in batches:
            flat = batch.column(0).flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, parts, size)
            entry = np.frombuffer(b"".join(batch.column(1).to_pylist()), state_type(b)).reshape(-1, parts)["entry"]
            cell = entry + np.arange(parts) * k
            np.add.at(sums, cell.ravel(), flat.reshape(-1, size))
            counts += np.bincount(cell.ravel(), minlength=parts * k)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at]), pa.array(sums[at].tolist(), pa.list_(pa.int64()))],
                                         ["cell", "n", "sums"])

    added = rows.select("ints", "state").mapInArrow(run, "cell bigint, n bigint, sums array<bigint>").groupBy("cell") \
        .agg(F.sum("n"), *(F.sum(F.col("sums")[d]) for d in range(size))).collect()
    sums, counts = np.zeros((parts * k, size), np.int64), np.zeros(parts * k, np.int64)
    for row in added:
        counts[row[0]], sums[row[0]] = row[1], row[2:]
    return sums.reshape(parts, k, size), counts.reshape(parts, k)


def adapted(rows: DataFrame, b: int, k: int) -> int:
    """The next b, from how many bounds the rows needed (one row a number)."""
    needs = dict(rows.groupBy("need").count().collect())
    total, through = sum(needs.values()), needs.get(b + 1, 0)
    if through > THROUGH * total:
        return max(1, min(2 * b, MOST_B, k - 1))
    served, enough = 0, 0
    for z in sorted(n for n in needs if n <= b):
        served, enough = served + needs[z], z
        if served >= SERVED * (total - through):
            break
    return max(1, min(max(enough, LEAST_B), k - 1))


def finite_of(column: str):
    """Whether no component is null or non-finite."""
    return F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))


def encode(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> tuple[DataFrame, Codebooks | None]:
    """(id, label, code, error) of each kept vector, stored, and the final codebooks (None without vectors that can be cut)."""
    spark = prepare(vectors.sparkSession)
    vector = F.col(vec_col).cast("array<double>")
    kept = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), vector.alias("vector")) \
        .where(F.col("vector").isNotNull()).where(F.coalesce(finite_of("vector"), F.lit(False)))
    start = kept.orderBy(F.col("id").asc_nulls_last(), "vector").limit(ENTRIES).select("vector").collect()
    width = len(start[0][0]) if start else 0
    if not start or width % PARTS:
        none = kept.select("id", "label", F.lit(None).cast("binary").alias("code"), F.lit(None).cast("long").alias("error"))
        return none, None
    fits = F.size("vector") == width
    same = [r[0] for r in start if len(r[0]) == width]
    if len(same) < len(start):  # vectors of other lengths stood among the first
        same = [r[0] for r in kept.where(fits).orderBy(F.col("id").asc_nulls_last(), "vector").limit(ENTRIES).select("vector").collect()]
    entries = whole_numbers(np.asarray(same, float).reshape(len(same), width)).reshape(len(same), PARTS, width // PARTS)
    books, k = Codebooks(np.ascontiguousarray(entries.transpose(1, 0, 2))), len(same)
    b_old = b = max(1, min(FIRST_B, k - 1))
    rows = kept.where(fits)
    for _ in range(ROUNDS):
        fresh = written(assigned(rows, books, width, b_old, b, last=False))
        if "state" in rows.columns:
            discard(rows)
        rows, b_old = fresh, b
        b = adapted(rows, b, k)
        books = books.replaced(*sums_of(rows, books, b_old))
    coded = assigned(rows, books, width, b_old, b, last=True)
    odd = kept.where(~fits).select("id", "label", F.lit(None).cast("binary").alias("code"), F.lit(None).cast("long").alias("error"))
    out = written(coded.unionByName(odd))
    discard(rows)
    return out, books


def with_label_errors(coded: DataFrame) -> DataFrame:
    """``coded`` and label_error, the sum of ``error`` over rows of equal label (nulls together)."""
    sums = written(coded.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).cast("long").alias("label_error"),
                                              F.count(F.lit(1)).alias("n")))
    total = sums.agg(F.sum("n")).first()[0] or 0
    hot = sums.withColumn("hot", F.col("n") * HOT >= F.lit(total)).withColumnRenamed("label", "of_label").drop("n")
    same = F.col("label").eqNullSafe(F.col("of_label"))
    few = hot.where("hot")  # at most HOT rows
    often = coded.join(F.broadcast(few), same).drop("of_label", "hot")
    seldom = coded.join(F.broadcast(few), same, "left_anti").join(hot.where("NOT hot"), same).drop("of_label", "hot")
    return often.unionByName(seldom)


def report(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """Per kept vector: id, code (hex), error, label_error, and the hash of all codebooks."""
    coded, books = encode(vectors, id_col, vec_col, label_col)
    digest = None if books is None else hashlib.sha256(",".join(map(str, books.entries.ravel().tolist())).encode()).hexdigest()
    return with_label_errors(coded).select(F.col("id").alias(id_col), F.lower(F.hex("code")).alias("code"), "error", "label_error",
                                           F.lit(digest).cast("string").alias("codebooks_sha256"))


ship_by_value(__name__)
