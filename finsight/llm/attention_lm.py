"""Language-model scoring with a causal self-attention model trained in numpy on subword ids.

Tokens of the base score are words (A-Z lower-cased) and one end per text. Their counts over all training texts
are gathered by Spark; the base score of a text is the sum of smoothed log10 unigram probabilities. The most frequent tokens
(at most ``FREQUENT``, a fixed bound) are broadcast, all others are joined by token, so the vocabulary may grow with the corpus
and a hot token is never a join key.

The model predicts the next subword of a public tokenizer (its file is a parameter, read on the driver). Subwords fall into
``CLASSES`` classes by their counts in the whole training corpus:
P(id | context) = P(class | context) * P(id | class, class before). The latter and a class transition table come from the
pairs of neighbouring subwords in all training texts, also across words. One layer of causal self-attention with a feed-forward part
on top of that table gives P(class | context). All its weights are learned from all training texts, none on the driver: the texts are dealt by hash
to ``rounds`` rounds and, in each, to replicas. A replica begins with the weights of the round before and takes small steps until every window
of its texts was in one, ``steps`` or more in all rounds; Spark averages the weights of a round's replicas by their subwords (as integers, so in any
order). The number of replicas grows with the corpus, each having some ``sample`` texts a round or more. Without ``steps`` a round is one
step on the gradients of all its texts, which Spark sums. A text is cut into windows of ``CONTEXT`` context and
``CONTEXT`` scored subwords that overlap by half, so each subword is scored once, by masked attention over a batch of windows of
whole texts. ``score`` is the log10 probability of all subwords and the end.

Edge cases: a null or empty text is its end token alone. Without any training text N = V = 0, the base score is 0 and the
model predicts with its smoothed uniform tables. Repeated rows count each time and each get a row. Ties in the frequency order go
by token, so the result does not depend on partitioning.
"""

from __future__ import annotations

from array import array
from collections import Counter
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finsight.llm.common import by_value, crc_mod, prepare, ship_by_value, text_bytes, written

TOKENIZER = "/opt/tokenizers/piece_bpe_32k.model"
FREQUENT = 1 << 17
HELD_WORDS = 400_000
CLASSES, SINGLE = 96, 64
CONTEXT, DIM, HIDDEN, OWN_ROWS = 16, 16, 24, 4096
SAMPLE, STEPS, ROUNDS, BATCH = 400, 2000, 8, 48
UNIT = float(1 << 20)  # gradients and weights are summed in whole numbers of 1 / UNIT
END = b"\n"  # no word contains white space


def words_of(data: bytes | None) -> list[bytes]:
    return data.lower().split() if data else []


def words_in(data: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """``words_of`` all texts of a column, one after the other, and how many each text has."""
    data = pc.fill_null(data.cast(pa.binary()), b"")
    text = pa.Array.from_buffers(pa.string(), len(data), data.buffers(), offset=data.offset)  # the ASCII functions go byte by byte
    parts = pc.ascii_split_whitespace(pc.ascii_lower(text))
    found = parts.flatten().cast(pa.binary())
    full = pc.greater(pc.binary_length(found), 0)  # white space at either end leaves an empty word
    before = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False))])
    return found.filter(full), np.diff(before[parts.offsets.to_numpy()])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter = Counter()

    def drained() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(list(held.keys()), pa.binary()),
                                          pa.array(list(held.values()), pa.int64())], ["token", "n"])
        held.clear()
        return out

    for batch in batches:
        found = words_in(batch.column(0))[0].value_counts()
        for word, n in zip(found.field(0).to_pylist(), found.field(1).to_pylist(), strict=True):
            held[word] += n
        held[END] += batch.num_rows
        if len(held) > 2 * HELD_WORDS:
            yield drained()
    yield drained()


def token_counts(texts: DataFrame) -> DataFrame:
    """(token, n) over all rows of a column ``data`` of text bytes."""
    return texts.select("data").mapInArrow(_counted, "token binary, n bigint").groupBy("token").agg(F.sum("n").alias("n"))


class Pieces(dict):
    """Subword ids of words, kept for the words of a task."""

    def __init__(self, model: bytes):
        super().__init__()
        self.encoder = sentencepiece.SentencePieceProcessor(model_proto=model)

    def __missing__(self, word: bytes) -> bytes:
        self.learn([word])
        return self[word]

    def learn(self, words: list[bytes]) -> None:
        if len(self) > HELD_WORDS:
            self.clear()
        for word, ids in zip(words, self.encoder.encode([w.decode("utf-8", "replace") for w in words], num_threads=1), strict=True):
            self[word] = array("i", ids).tobytes()
        self[END] = array("i", [self.encoder.eos_id()]).tobytes()

    def of(self, words: list[bytes]) -> np.ndarray:
        """Ids of all subwords of the words, in order."""
        if new := [w for w in set(words) if w not in self]:
            self.learn(new if len(self) <= HELD_WORDS else list(set(words)))  # a full one forgets the others
        return np.frombuffer(b"".join(map(self.__getitem__, words)), np.int32)

    def spread(self, words: list[bytes], stream: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all subwords of a stream of places in the distinct ``words``, and how many each place has."""
        flat = self.of(words)
        lengths = np.fromiter(map(len, map(self.__getitem__, words)), np.int64, len(words)) // flat.itemsize
        counts = lengths[stream]
        shift = (np.cumsum(lengths) - lengths)[stream] - (np.cumsum(counts) - counts)
        return flat[np.arange(counts.sum()) + np.repeat(shift, counts)], counts


def id_type(size: int) -> type:
    """Type of the stored ids of a tokenizer with ``size`` ids."""
    return np.uint16 if size <= 1 << 16 else np.int32


class Tokens:
    """The tokens of a column of texts: the distinct ones (END the last), and the stream of their places, text by text."""

    def __init__(self, data: pa.Array):
        words, counts = words_in(data)
        coded = words.dictionary_encode()
        self.names = [*coded.dictionary.to_pylist(), END]
        self.stream = np.insert(coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), np.cumsum(counts), len(self.names) - 1)
        self.counts = counts + 1
        self.owner = np.repeat(np.arange(len(counts)), self.counts)

    def ids(self, pieces: Pieces, kind: type) -> pa.Array:
        """The subword ids of each text, as bytes."""
        flat, counts = pieces.spread(self.names, self.stream)
        ends = np.cumsum(counts)[np.cumsum(self.counts) - 1] if len(self.counts) else []
        offsets = (np.concatenate([[0], ends]) * np.dtype(kind).itemsize).astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(self.counts), [None, pa.py_buffer(offsets), pa.py_buffer(flat.astype(kind))])


def stored(texts: DataFrame, model: bytes, size: int) -> DataFrame:
    """The frame with the subword ``ids`` of its column ``data`` (left alone if it has them)."""
    if "ids" in texts.columns:
        return texts

    @F.arrow_udf("binary")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        pieces = Pieces(model)
        for data in batches:
            yield Tokens(data).ids(pieces, id_type(size))

    return texts.withColumn("ids", encode(F.col("data")))


def hashed(texts: DataFrame) -> DataFrame:
    """With what deals the texts of a column ``data`` to the replicas and the rounds; copies with ids of their own are dealt apart."""
    own = [F.col(c) for c in ("data", "id") if c in texts.columns]
    return texts.withColumns({"key": F.xxhash64(*own), "turn": F.xxhash64(*own, F.lit("round"))})


def ids_of(column: pa.Array, kind: type) -> list[np.ndarray]:
    """Ids of each text of a column of ``ids``."""
    return [np.frombuffer(x.as_buffer(), kind) for x in column]


def subword_counts(vocabulary: DataFrame, model: bytes, size: int) -> np.ndarray:
    """Counts of subword ids over the corpus, from its token counts: ``size`` numbers reach the driver."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, total = Pieces(model), np.zeros(size, np.int64)
        for batch in batches:
            tokens = batch.column(0).to_pylist()
            pieces.learn(tokens)  # one call of the encoder for the batch
            for token, n in zip(tokens, batch.column(1).to_pylist(), strict=True):
                np.add.at(total, pieces.of([token]), n)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], ["id", "n"])

    got = vocabulary.select("token", "n").mapInArrow(spread, "id bigint, n bigint").groupBy("id") \
        .agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(size)
    out[got["id"].to_numpy(int)] = got["n"].to_numpy(float)
    return out


def transitions(texts: DataFrame, model: bytes, class_of: np.ndarray) -> np.ndarray:
    """Counts (class, next id) over all neighbouring subwords of all texts; the last row is the start of a text.

    At most (CLASSES + 1) numbers for each id reach the driver, whatever the corpus."""
    size = len(class_of)
    cells = (CLASSES + 1) * size

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, parts, held = np.zeros(cells, np.int64), [], 0
        for batch in batches:
            for ids in ids_of(batch.column(0), id_type(size)):
                parts.append(np.concatenate([[CLASSES], class_of[ids[:-1]]]) * size + ids)
                held += len(ids)
                if held > 1 << 20:
                    total += np.bincount(np.concatenate(parts), minlength=cells)
                    parts, held = [], 0
        if parts:
            total += np.bincount(np.concatenate(parts), minlength=cells)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], ["cell", "n"])

    got = stored(texts, model, size).select("ids").mapInArrow(pairs, "cell bigint, n bigint").groupBy("cell") \
        .agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(cells, np.float32)
    out[got["cell"].to_numpy(int)] = got["n"].to_numpy(np.float32)
    return out.reshape(CLASSES + 1, size)


def classes_by_count(counts: np.ndarray, pieces: list[str]) -> np.ndarray:
    """The most frequent subwords have classes of their own; the others, by first letters, share classes of equal mass."""
    order = np.lexsort((np.arange(len(counts)), -counts))
    out = np.zeros(len(counts), np.int64)
    out[order[:SINGLE]] = np.arange(SINGLE)
    rest = sorted(order[SINGLE:].tolist(), key=lambda i: (not pieces[i].startswith("▁"), pieces[i], i))
    mass = np.cumsum(counts[rest] + 0.5)
    shared = CLASSES - SINGLE
    out[rest] = SINGLE + np.minimum((mass / mass[-1] * shared).astype(np.int64), shared - 1)
    return out


def blocks_of(ids: np.ndarray, rows: np.ndarray, pad: int) -> tuple[np.ndarray, np.ndarray]:
    """Input blocks (one of padding, then those of one text's ids) and their targets (-1 in padding and beyond the end).

    A window is a block with the one before it as context."""
    count = -(-len(ids) // CONTEXT)
    inputs = np.full((count + 1) * CONTEXT, pad, np.int32)
    inputs[CONTEXT] = rows[-1]  # the row of the text's start
    inputs[CONTEXT + 1:CONTEXT + len(ids)] = rows[ids[:-1]]
    targets = np.full((count + 1) * CONTEXT, -1, np.int32)
    targets[CONTEXT:CONTEXT + len(ids)] = ids
    return inputs.reshape(-1, CONTEXT), targets.reshape(-1, CONTEXT)


def summed_rows(at: np.ndarray, rows: np.ndarray, size: int) -> np.ndarray:
    """The sum of the rows of each place: ``np.add.at`` on zeros, several times as fast, but for the rounding."""
    out = np.zeros((size, rows.shape[1]), rows.dtype)
    if len(at):
        order = np.argsort(at.astype(id_type(size)), kind="stable")  # a radix sort for two bytes
        places = at[order]
        starts = np.flatnonzero(np.concatenate([[True], places[1:] != places[:-1]]))
        out[places[starts]] = np.add.reduceat(rows.take(order, 0), starts, axis=0)
    return out


class Net:
    """One layer of causal attention over 2 * CONTEXT positions, a feed-forward part, and class logits."""

    NAMES = ("embed", "place", "wq", "wk", "wv", "w1", "b1", "w2")

    def __init__(self, rows: int, seed: int = 11):
        rng = np.random.default_rng(seed)
        draw = lambda *shape, by=1.0: (rng.standard_normal(shape) * by).astype(np.float32)
        self.p = {"embed": draw(rows, DIM, by=0.5), "place": draw(CONTEXT, 2 * CONTEXT, by=0.1),
                  "wq": draw(DIM, DIM, by=DIM ** -0.5), "wk": draw(DIM, DIM, by=DIM ** -0.5),
                  "wv": draw(DIM, DIM, by=DIM ** -0.5), "w1": draw(DIM, HIDDEN, by=DIM ** -0.5),
                  "b1": np.zeros(HIDDEN, np.float32), "w2": np.zeros((HIDDEN, CLASSES), np.float32)}
        self.reach = np.arange(2 * CONTEXT)[None, :] <= np.arange(CONTEXT)[:, None] + CONTEXT

    def small(self) -> bool:
        """Whether no attention score can be large enough to overflow without a shift."""
        p = self.p
        longest = lambda w: float(np.sqrt(((p["embed"] @ w) ** 2).sum(1).max()))
        return longest(p["wq"]) * longest(p["wk"]) * DIM ** -0.5 + float(np.abs(p["place"]).max()) < 60

    def forward(self, blocks: np.ndarray, pad: int, pairs: bool = False, small: bool = False) -> dict:
        """Scores every block but the first, with the one before it as context; ``pairs``: every second one."""
        p = self.p
        flat = lambda a, w: (a.reshape(-1, a.shape[-1]) @ w).reshape(*a.shape[:-1], -1)
        scored, context = (slice(1, None, 2), slice(0, None, 2)) if pairs else (slice(1, None), slice(0, -1))
        x = p["embed"].take(blocks, 0)
        own = x[scored]
        query = flat(own, p["wq"] * np.float32(DIM ** -0.5))
        keys, values = flat(x, p["wk"]), flat(x, p["wv"])
        key = np.concatenate([keys[context], keys[scored]], 1)
        value = np.concatenate([values[context], values[scored]], 1)
        scores = query @ key.transpose(0, 2, 1)
        scores += np.where(self.reach, p["place"], np.float32(-1e9))
        scores[blocks[context][:, 0] == pad, :, :CONTEXT] = -1e9  # a text's first block has no context
        if not small:
            scores -= scores.max(-1, keepdims=True)
        np.exp(scores, out=scores)
        total = flat(scores, np.ones((2 * CONTEXT, 1), np.float32))
        h = own + (scores @ value) / total
        hidden = h.reshape(-1, DIM) @ p["w1"]
        hidden += p["b1"]
        np.maximum(hidden, 0, out=hidden)
        return {"x": x, "own": own, "query": query, "key": key, "value": value, "scores": scores, "total": total, "h": h,
                "hidden": hidden, "logits": hidden @ p["w2"]}

    def backward(self, blocks: np.ndarray, f: dict, d_logits: np.ndarray, pairs: bool = True) -> dict:
        """Gradients for blocks in pairs (context, scored), or for a row of blocks as ``forward`` scores it."""
        p, n = self.p, len(f["own"])
        flat = lambda a: a.reshape(-1, a.shape[-1])
        g = {"w2": f["hidden"].T @ d_logits}
        d_hidden = (d_logits @ p["w2"].T) * (f["hidden"] > 0)
        g["w1"], g["b1"] = flat(f["h"]).T @ d_hidden, d_hidden.sum(0)
        d_h = (d_hidden @ p["w1"].T).reshape(n, CONTEXT, DIM)
        weights = f["scores"] / f["total"]
        d_scores = d_h @ f["value"].transpose(0, 2, 1)
        d_value = weights.transpose(0, 2, 1) @ d_h
        d_scores = weights * (d_scores - (d_scores * weights).sum(-1, keepdims=True))
        g["place"] = np.where(self.reach, d_scores.sum(0), 0)
        d_query, d_key = (d_scores @ f["key"]) * np.float32(DIM ** -0.5), d_scores.transpose(0, 2, 1) @ f["query"]
        if pairs:
            d_key, d_value = (a.reshape(2 * n, CONTEXT, DIM) for a in (d_key, d_value))
        else:
            for a in (d_key, d_value):  # a block's share as context goes to its share as a scored one
                a[:-1, CONTEXT:] += a[1:, :CONTEXT]
            d_key, d_value = (np.concatenate([a[:1, :CONTEXT], a[:, CONTEXT:]]).reshape(-1, DIM) for a in (d_key, d_value))
        g["wq"] = flat(f["own"]).T @ flat(d_query)
        g["wk"], g["wv"] = flat(f["x"]).T @ flat(d_key), flat(f["x"]).T @ flat(d_value)
        d_x = (d_key @ p["wk"].T + d_value @ p["wv"].T).reshape(f["x"].shape)
        d_x[1::2 if pairs else 1] += d_h + d_query @ p["wq"].T
        g["embed"] = summed_rows(blocks.reshape(-1), flat(d_x), len(p["embed"]))
        return g


class Adam:
    """Steps of weights ``p``, in place."""

    def __init__(self, p: dict):
        self.p, self.steps = p, 0
        self.mean = {k: np.zeros_like(v) for k, v in p.items()}
        self.square = {k: np.zeros_like(v) for k, v in p.items()}

    def step(self, gradients: dict, rate: float) -> None:
        self.steps += 1
        for k, g in gradients.items():
            self.mean[k] += 0.1 * (g - self.mean[k])
            self.square[k] += 0.01 * (g * g - self.square[k])
            self.p[k] -= rate * (self.mean[k] / (1 - 0.9 ** self.steps)) / (np.sqrt(self.square[k] / (1 - 0.99 ** self.steps)) + 1e-6)


class Language:
    """Everything that scoring needs; small and of fixed size."""

    def __init__(self, model: bytes, counts: np.ndarray, class_of: np.ndarray, pairs: np.ndarray):
        size = len(counts)
        self.model, self.class_of = model, class_of
        mass = np.bincount(class_of, counts + 0.5, CLASSES)
        by_class = np.stack([np.bincount(class_of, row, CLASSES) for row in pairs])
        # log P(id | its class, the class before): pair counts, smoothed with the counts in the class
        inside = (pairs + 20 * ((counts + 0.5) / mass[class_of]).astype(np.float32)) / (by_class[:, class_of] + 20)
        self.inside = np.log(inside).astype(np.float32)
        self.rows = np.zeros(size + 1, np.int64)  # embedding rows: frequent ids, classes of the others, start, padding
        order = np.lexsort((np.arange(size), -counts))
        self.rows[:size] = OWN_ROWS + class_of
        own = order[:OWN_ROWS]
        self.rows[own] = np.arange(len(own))
        self.start, self.pad = OWN_ROWS + CLASSES, OWN_ROWS + CLASSES + 1
        self.rows[size] = self.start
        prior = mass / mass.sum()
        smooth = (by_class + 5 * prior) / (by_class.sum(1, keepdims=True) + 5)
        self.logs = np.log(smooth).astype(np.float32)  # the last row: after the start
        self.row_class = np.full(self.pad + 1, CLASSES, np.int64)
        self.row_class[self.rows[:size]] = class_of
        self.net = Net(self.pad + 1)

    def log_classes(self, blocks: np.ndarray, pairs: bool = False, small: bool = False) -> tuple[dict, np.ndarray]:
        f = self.net.forward(blocks, self.pad, pairs, small)
        z = f["logits"]
        z += self.logs.take(self.before(blocks[1::2] if pairs else blocks[1:]), 0)
        return f, z

    def before(self, blocks: np.ndarray) -> np.ndarray:
        """Class of the subword before each scored one."""
        return self.row_class[blocks].reshape(-1)

    def windows(self, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Context and scored block of every window, and the targets."""
        cut = [blocks_of(t, self.rows, self.pad) for t in texts]
        return np.concatenate([np.stack([a[:-1], a[1:]], 1) for a, _ in cut]), np.concatenate([b[1:] for _, b in cut])

    def gradients(self, pairs: np.ndarray, targets: np.ndarray) -> tuple[dict, int]:
        """Gradients of the loss summed over the targets of some windows, and how many targets these are."""
        blocks, goal = pairs.reshape(-1, CONTEXT), targets.reshape(-1)
        f, z = self.log_classes(blocks, pairs=True)
        z -= z.max(1, keepdims=True)
        np.exp(z, out=z)
        z /= z.sum(1, keepdims=True)
        real = np.flatnonzero(goal >= 0)
        z[real, self.class_of[goal[real]]] -= 1
        z[goal < 0] = 0
        return self.net.backward(blocks, f, z), len(real)

    def joined(self, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The blocks of all texts one after the other, their targets, and how many blocks each text has."""
        cut = [blocks_of(t, self.rows, self.pad) for t in texts]
        return np.concatenate([a for a, _ in cut]), np.concatenate([b for _, b in cut]), np.array([len(b) for _, b in cut])

    def moderate(self, f: dict) -> bool:
        """Whether no class logit can be large enough to overflow without a shift."""
        return float((f["hidden"].max(0) @ np.abs(self.net.p["w2"])).max()) < 60

    def all_gradients(self, texts: list[np.ndarray], chunk: int = 256) -> tuple[dict, int]:
        """``gradients`` over every window of whole texts: a block is scored and is a context in one pass."""
        blocks, targets, _ = self.joined(texts)
        small, total, count, ones = self.net.small(), {}, 0, np.ones((CLASSES, 1), np.float32)
        for at in range(1, len(blocks), chunk):
            part, goal = blocks[at - 1:at + chunk], targets[at:at + chunk].reshape(-1)
            f, z = self.log_classes(part, small=small)
            if not self.moderate(f):
                z -= z.max(1, keepdims=True)
            np.exp(z, out=z)
            real = goal >= 0
            z *= real[:, None] / (z @ ones)
            real = np.flatnonzero(real)
            z[real, self.class_of[goal[real]]] -= 1
            count += len(real)
            for k, g in self.net.backward(part, f, z, pairs=False).items():
                total[k] = total.get(k, 0.0) + g.astype(np.float64)
        return total, count

    def train(self, texts: list[np.ndarray], steps: int, rate: float = 0.01, turn: int = 0, turns: int = 1) -> None:
        """``steps`` steps, or as many as it takes to see every window; the rate falls over all ``turns``."""
        if not texts:
            return
        pairs, targets = self.windows(texts)
        rng = np.random.default_rng(5 + turn)
        steps = max(steps, -(-len(pairs) // BATCH))
        order = np.concatenate([rng.permutation(len(pairs)) for _ in range(-(-steps * BATCH // len(pairs)))])
        adam = Adam(self.net.p)
        for step in range(1, steps + 1):
            at = order[(step - 1) * BATCH:step * BATCH]
            found, n = self.gradients(pairs[at], targets[at])
            left = 1 - (turn + step / (steps + 1)) / turns
            adam.step({k: g / max(n, 1) for k, g in found.items()}, rate * min(1.0, 2 * left, step / 10))

    def score(self, texts: list[np.ndarray], chunk: int = 256) -> np.ndarray:
        """log10 probability of each text of ids (each with its end)."""
        blocks, targets, counts = self.joined(texts)
        small, total = self.net.small(), np.zeros(len(targets))
        ones = np.ones(CLASSES, np.float32)
        for at in range(1, len(targets), chunk):
            part, goal = blocks[at - 1:at + chunk], targets[at:at + chunk].reshape(-1)
            f, z = self.log_classes(part, small=small)
            own = z[np.arange(len(goal)), self.class_of[goal]]
            low = 0.0 if self.moderate(f) else max(float(z.max()), 0.0)  # far from overflow there is no need to shift
            if low:
                z -= low
            np.exp(z, out=z)
            logs = own - low - np.log(z @ ones + np.float32(1e-30)) + self.inside[self.before(part[1:]), goal]
            total[at:at + chunk] = np.where(goal >= 0, logs, 0).reshape(-1, CONTEXT).sum(1)
        return np.bincount(np.repeat(np.arange(len(texts)), counts), total, len(texts)) / np.log(10)


def several(batches: Iterator[pa.RecordBatch], kind: type) -> Iterator[list[np.ndarray]]:
    """The ids of texts, as many at a time as make some 130 000."""
    texts, held = [], 0
    for batch in batches:
        for ids in ids_of(batch.column(0), kind):
            texts.append(ids)
            held += len(ids)
            if held > 1 << 17:
                yield texts
                texts, held = [], 0
    if texts:
        yield texts


def flattened(values: dict, last: int) -> np.ndarray:
    """The numbers of all weights, and one more."""
    return np.concatenate([*(values[k].reshape(-1) for k in Net.NAMES), [last]])


def cells_of(values: np.ndarray) -> pa.RecordBatch:
    """Numbers that Spark sums by their places, as integers."""
    whole = np.rint(values * UNIT).astype(np.int64)
    found = np.flatnonzero(whole)
    return pa.RecordBatch.from_arrays([pa.array(found), pa.array(whole[found])], ["cell", "n"])


def summed(cells: DataFrame, p: dict) -> tuple[dict, int]:
    """Sums over all tasks for each weight, and of the last number: one number for each weight reaches the driver."""
    got = cells.groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    total = np.zeros(sum(v.size for v in p.values()) + 1)
    total[got["cell"].to_numpy(int)] = got["n"].to_numpy(float) / UNIT
    out, at = {}, 0
    for k in Net.NAMES:
        out[k], at = total[at:at + p[k].size].reshape(p[k].shape), at + p[k].size
    return out, round(total[-1])


def summed_gradients(texts: DataFrame, language: Language) -> tuple[dict, int]:
    """Gradients over every window of every text, summed by Spark."""
    shared = texts.sparkSession.sparkContext.broadcast(by_value(language))
    kind = id_type(len(language.class_of))

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, total = cloudpickle.loads(shared.value), 0.0
        for texts in several(batches, kind):
            total += flattened(*model.all_gradients(texts))
        if np.ndim(total):
            yield cells_of(total)

    out, n = summed(stored(texts, language.model, len(language.class_of)).select("ids")
                    .mapInArrow(tasks, "cell bigint, n bigint"), language.net.p)
    shared.unpersist()
    return {k: v.astype(np.float32) for k, v in out.items()}, n


def learned(texts: DataFrame, language: Language, replicas: int, steps: int, turn: int, turns: int) -> tuple[dict, int]:
    """What each weight changes by in replicas that learn from all texts, summed over them in proportion to their subwords, and these."""
    shared = texts.sparkSession.sparkContext.broadcast(by_value(language))
    kind = id_type(len(language.class_of))

    def replica(table: pa.Table) -> pa.Table:
        model = cloudpickle.loads(shared.value)
        before = {k: v.copy() for k, v in model.net.p.items()}
        ids = ids_of(table.sort_by("key").column("ids").combine_chunks(), kind)
        model.train(ids, steps, turn=turn, turns=turns)
        n = sum(map(len, ids))
        return pa.Table.from_batches([cells_of(flattened({k: (v - before[k]).astype(float) * n for k, v in model.net.p.items()}, n))])

    dealt = texts.select(F.pmod("key", F.lit(replicas)).alias("replica"), "key", "ids")
    out = summed(dealt.repartition(2 * replicas, "replica").groupBy("replica").applyInArrow(replica, "cell bigint, n bigint"), language.net.p)
    shared.unpersist()
    return out


def train_on_all(texts: DataFrame, language: Language, rounds: int, replicas: int = 1, steps: int = 0, rate: float = 0.01) -> None:
    """Each text counts in the round of its hash: in steps of its replica, or without ``steps`` in one step of the round."""
    adam = Adam(language.net.p)
    for k in range(rounds):
        part = texts.filter(F.pmod("turn", F.lit(rounds)) == k)
        if steps:
            found, n = learned(part, language, replicas, -(-steps // rounds), k, rounds)
            for name, change in found.items():
                language.net.p[name] += (change / max(n, 1)).astype(np.float32)
            continue
        found, n = summed_gradients(part, language)
        if n:
            adam.step({name: g / n for name, g in found.items()}, rate * (1 - k / rounds))


def replicas_of(subwords: float, texts: float, sample: int, steps: int, rounds: int) -> int:
    """How many replicas a round has: as many as see every window in about ``steps`` steps in all rounds, with ``sample`` texts a round each."""
    windows = subwords / CONTEXT + texts / 2
    return max(1, min(int(np.ceil(windows / (max(steps, 1) * BATCH))), int(texts / (max(rounds, 1) * max(sample, 1)))))


def fit(texts: DataFrame, vocabulary: DataFrame, tokenizer: str, sample: int, steps: int, rounds: int = ROUNDS) -> Language:
    """Tables and attention weights from all training texts.

    ``texts``: a column ``data`` of text bytes, or the columns of ``hashed`` and ``stored``."""
    model = Path(tokenizer).read_bytes()
    encoder = sentencepiece.SentencePieceProcessor(model_proto=model)
    size = encoder.vocab_size()
    if "ids" not in texts.columns:
        texts = written(stored(hashed(texts.select("data")), model, size).drop("data"))  # encoded once for all passes
    counts = subword_counts(vocabulary, model, size)
    class_of = classes_by_count(counts, [encoder.id_to_piece(i) for i in range(size)])
    language = Language(model, counts, class_of, transitions(texts, model, class_of))
    train_on_all(texts, language, rounds, replicas_of(counts.sum(), counts[encoder.eos_id()], sample, steps, rounds), steps)
    return language


def score_documents(docs: DataFrame, learn, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = TOKENIZER,
                    sample: int = SAMPLE, steps: int = STEPS, rounds: int = ROUNDS) -> DataFrame:
    """One row per document: id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    ``learn``: condition for the rows whose texts are learned from."""
    spark = prepare(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), learn.alias("learned"), text_bytes(text_col).alias("data"))
    training = rows.filter("learned")
    vocabulary = written(token_counts(training))
    totals = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    top = vocabulary.orderBy(F.desc("n"), "token").limit(FREQUENT).collect()  # at most FREQUENT short rows
    floor = top[-1]["n"] if len(top) == FREQUENT else 0
    model = Path(tokenizer).read_bytes()
    kind = id_type(sentencepiece.SentencePieceProcessor(model_proto=model).vocab_size())
    frequent = spark.sparkContext.broadcast({bytes(r["token"]): r["n"] for r in top})

    @F.arrow_udf("struct<n_tokens:bigint,n_known:bigint,base:double,rest:array<binary>,ids:binary>")
    def read(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        logs = {w: float(np.log10(n + 0.5)) for w, n in frequent.value.items()}
        pieces = Pieces(model)
        for data in batches:
            tokens, size = Tokens(data), len(data)
            found = np.array([logs.get(w, np.nan) for w in tokens.names])[tokens.stream]
            rest = np.isnan(found)
            more = np.bincount(tokens.owner[rest], minlength=size)
            others = pa.array(tokens.names, pa.binary()).take(pa.array(tokens.stream[rest]))
            yield pa.StructArray.from_arrays([
                pa.array(tokens.counts), pa.array(tokens.counts - more),
                pa.array(np.bincount(tokens.owner, np.where(rest, 0.0, found), size)),
                pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(more)]), pa.int32()), others),
                tokens.ids(pieces, kind)], ["n_tokens", "n_known", "base", "rest", "ids"])

    # every text is split and encoded once; the passes to come read ids
    texts = written(hashed(rows).withColumn("j", read(F.col("data"))).select("id", "learned", "key", "turn", "j.*")
                    .withColumn("row", F.monotonically_increasing_id()))
    language = fit(texts.filter("learned"), vocabulary, tokenizer, sample, steps, rounds)
    shared = spark.sparkContext.broadcast(by_value(language))

    @F.arrow_udf("double")
    def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = cloudpickle.loads(shared.value)
        for column in batches:
            out: list[float] = []
            for some in several(iter([pa.record_batch([column], ["ids"])]), kind):
                out += model.score(some).tolist()
            yield pa.array(out, pa.float64())

    judged = written(texts.select("row", "id", "learned", "n_tokens", "n_known", "base", judge(F.col("ids")).alias("score")))
    others = vocabulary.filter(F.col("n") <= floor) if floor else vocabulary
    rest = texts.select("row", F.explode("rest").alias("token")).join(others, "token", "left") \
        .groupBy("row").agg(F.sum(F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("more"), F.count("n").alias("also"))
    norm = float(np.log10(totals["n"] + 0.5 * (totals["v"] + 1)))
    return judged.join(rest, "row", "left").select(
        F.col("id").alias(id_col), (~F.col("learned")).alias("held_out"), "n_tokens",
        (F.col("n_known") + F.coalesce("also", F.lit(0))).alias("n_known"),
        F.lit(int(totals["n"])).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more", F.lit(0.0)) - F.col("n_tokens") * norm).alias("base_score"), "score")


def report(docs: DataFrame, **options) -> DataFrame:
    return score_documents(docs, crc_mod("doc_id", 5) != 1, **options)


ship_by_value(__name__)
