"""MinHash near-duplicate detection with sequential Bayesian verification.

A document's set is its distinct 5-word shingles (fewer words: the whole sequence as one shingle). Texts with the same word
sequence form one class; every later step sees a class once, so copies are never paired.

1. One scan gives each document its class (128-bit digest of its words), set size and MinHash signature.
2. Signatures are cut into bands; classes that share a band are candidates. Each class first meets one hub only, the
   class in the middle of its candidates: of each band bucket the member whose buckets are the largest over all bands
   (in a group of near copies, the text that the others stem from), then the one that most of its buckets name.
3. Candidates are compared signature batch by signature batch. With a uniform prior the similarity after m
   matches in n hashes is Beta(m+1, n-m+1) distributed; as soon as P(similarity >= threshold) is below ``miss``, the
   pair is dropped. Survivors are verified exactly on the full sets, hub by hub in bounded chunks.
4. Components of the verified links: trees of hubs first, by pointer jumping, and large and small stars in turn where
   step 5 adds links.
5. Candidates whose classes are still in different components are compared and verified in blocks of bounded size:
   the classes of a hub form a cluster, visited by the candidates from other clusters; its classes outside its largest component
   and the visitors meet all its classes. A pair inside one component needs no comparison: it cannot change the result. Only
   the links that join components leave a block.

So n near copies of a text cost about n comparisons, not n squared, no list of pairs of a group is ever made, and nothing is capped. The chance that a
pair at the threshold shares no band is ``missed_by_bands`` (8e-7 at 0.85, 1e-7 at 0.8).

Edge cases: without words or text a document has an empty set, is its own component and is linked with nothing. Ties do not arise:
classes are ordered by digest, results by doc_id. A component's id is its smallest non-null doc_id (null if it has none).
Repeated rows share class and component. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finsight.llm.common import fresh, prepare, ship_by_value, text_bytes, written
from finsight.session import default_parallelism, ensure_checkpoint_dir

SHINGLE = 5
HASHES = 120
BATCH = 24
MISS = 1e-6
#: Rows of a verification chunk, and of each side of a comparison block.
CHUNK = 256
BLOCK, BLOCK_SHINGLES = 1024, 1_000_000
HELD_WORDS = 300_000
#: Classes a partition of the frames of ids may hold.
CLASSES_HELD = 200_000
_SEEDS = np.random.default_rng(20240215).integers(0, 1 << 63, (2, HASHES), np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
EMPTY = pa.array([], pa.binary())


def band_rows(threshold: float, hashes: int = HASHES, miss: float = MISS) -> int:
    """The most rows a band may have so that a pair at the threshold shares one with probability 1 - miss."""
    fits = [r for r in range(1, hashes + 1) if hashes % r == 0 and missed_by_bands(threshold, r, hashes) <= miss]
    return max(fits, default=1)


def missed_by_bands(threshold: float, rows: int, hashes: int = HASHES) -> float:
    return (1 - threshold ** rows) ** (hashes // rows)


def least_matches(threshold: float, n: int, miss: float = MISS) -> int:
    """Fewest matches in n hashes with P(similarity >= threshold | matches) >= miss, under a uniform prior."""
    total = 0.0
    for m in range(n + 1):  # P(Beta(m+1, n-m+1) >= t) = P(Binomial(n+1, t) <= m)
        total += comb(n + 1, m) * threshold ** m * (1 - threshold) ** (n + 1 - m)
        if total >= miss:
            return m
    return n


class WordHashes(dict):
    """64-bit hashes of words, kept for the words of a task."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > HELD_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingles(words: list[bytes], hashes: WordHashes) -> np.ndarray:
    """Sorted 64-bit codes of the distinct shingles."""
    if not words:
        return np.zeros(0, np.uint64)
    codes = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    width = min(SHINGLE, len(words))
    out = np.full(len(codes) - width + 1, width, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(width):
            out = out * _BASE + codes[k:k + len(out)]
            out ^= out >> np.uint64(32)
        out *= np.uint64(0xD6E8FEB86659FD93)
        out ^= out >> np.uint64(32)
    return np.unique(out)


def words_of(data: bytes | None) -> list[bytes]:
    """Words of a text; A-Z is lower-cased, spaces are the six ASCII ones."""
    return data.lower().split() if data else []


def signature(codes: np.ndarray) -> bytes:
    low = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for at in range(0, len(codes), 1024):
            part = codes[at:at + 1024] * _SEEDS[0][:, None]
            part += _SEEDS[1][:, None]
            np.minimum(low, part.min(1), out=low)
    return (low >> np.uint64(32)).astype("<u4").tobytes()


def shared(ours: np.ndarray, theirs: np.ndarray) -> int:
    """How many codes two sorted sets have in common."""
    if not len(ours) or not len(theirs):
        return 0
    at = theirs.searchsorted(ours)
    at[at == len(theirs)] = 0
    return int((theirs[at] == ours).sum())


def digest(words: list[bytes]) -> bytes | None:
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest() if words else None


def sketches(text: Column) -> Column:
    """struct<cls, n, sig>: class digest (null without words), set size, signature."""

    @F.arrow_udf("struct<cls:binary,n:bigint,sig:binary>")
    def sketch(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        hashes = WordHashes()
        for texts in batches:
            cls, n, sig = [], [], []
            for data in texts:
                words = words_of(data.as_py())
                codes = shingles(words, hashes)
                cls.append(digest(words))
                n.append(len(codes))
                sig.append(signature(codes) if words else None)
            yield pa.StructArray.from_arrays([pa.array(cls, pa.binary()), pa.array(n, pa.int64()),
                                              pa.array(sig, pa.binary())], ["cls", "n", "sig"])

    return sketch(text)


def classes_of(text: Column) -> Column:
    @F.arrow_udf("binary")
    def classify(texts: pa.Array) -> pa.Array:
        return pa.array([digest(words_of(x.as_py())) for x in texts], pa.binary())

    return classify(text)


def agree(ours: np.ndarray, theirs: np.ndarray, needed: list[int]) -> np.ndarray:
    """Which rows of ``ours`` survive the batch-wise comparison with ``theirs`` (one signature, or one for each row)."""
    alive = np.arange(len(ours))
    matches = np.zeros(len(ours), np.int64)
    for k, least in enumerate(needed):
        cut = slice(k * BATCH, (k + 1) * BATCH)
        other = theirs[cut] if theirs.ndim == 1 else theirs[alive, cut]
        matches[alive] += (ours[alive, cut] == other).sum(1)
        alive = alive[matches[alive] >= least]
        if not len(alive):
            break
    return alive


def unpacked(signatures: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(signatures), "<u4").reshape(-1, HASHES)


def _needed(threshold: float) -> list[int]:
    return [least_matches(threshold, n) for n in range(BATCH, HASHES + 1, BATCH)]


def partitions_for(classes: DataFrame) -> int:
    """Files of a frame with about as many short rows as there are classes."""
    return max(default_parallelism(classes.sparkSession), -(-classes.count() // CLASSES_HELD))


def stored(ids: DataFrame, parts: int) -> DataFrame:
    """A checkpointed frame of ids, in ``parts`` files where a shuffle has more partitions than that: many small frames are
    stored one after another. The rows are dealt anew, as one task that sorted many partitions in turn would hold them all."""
    fewer = parts < int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (ids.repartition(parts) if fewer else ids).checkpoint()


def plausible(pairs: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) whose set sizes and signatures leave the threshold possible."""
    needed = _needed(threshold)

    @F.arrow_udf("boolean")
    def likely(ours: pa.Array, theirs: pa.Array) -> pa.Array:
        keep = np.zeros(len(ours), bool)
        if len(ours):
            keep[agree(unpacked(ours.to_pylist()), unpacked(theirs.to_pylist()), needed)] = True
        return pa.array(keep)

    side = lambda x: classes.select(F.col("cls").alias(x), F.col("n").alias(f"n_{x}"), F.col("sig").alias(f"sig_{x}"))
    return pairs.join(side("a"), "a").join(side("b"), "b") \
        .filter(F.least("n_a", "n_b") >= F.lit(threshold) * F.greatest("n_a", "n_b") - 1e-9) \
        .filter(likely("sig_a", "sig_b")).select("a", "b")


def verified(pairs: DataFrame, texts: DataFrame, threshold_pct: int, parts: int) -> DataFrame:
    """Pairs (a, b) whose full shingle sets have 100 * intersection >= threshold_pct * union.

    A hub's text goes to each chunk of its partners, a partner's text to the chunk it is in."""
    pairs = stored(pairs, parts)
    sizes = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("chunks"))
    partners = pairs.join(sizes, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("chunks")).cast("int").alias("chunk")) \
        .join(texts.select(F.col("cls").alias("b"), "data"), "b").select("a", "chunk", F.lit(1).alias("role"), "b", "data")
    hubs = sizes.join(texts.select(F.col("cls").alias("a"), "data"), "a") \
        .select("a", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), F.lit(0).alias("role"),
                F.col("a").alias("b"), "data")

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, hub, held = WordHashes(), None, None
        for batch in batches:
            rows: list[tuple[bytes, bytes]] = []
            for a, _, role, b, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if role == 0:
                    if hub != a:
                        hub, held = a, shingles(words_of(data), hashes)
                elif hub == a:
                    own = shingles(words_of(data), hashes)
                    both = shared(own, held)
                    if 100 * both >= threshold_pct * (len(own) + len(held) - both):
                        rows.append((a, b))
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in rows], pa.binary()),
                                              pa.array([y for _, y in rows], pa.binary())], ["a", "b"])

    dealt = partners.unionByName(hubs).repartition(F.col("a"), F.col("chunk")).sortWithinPartitions("a", "chunk", "role")
    return stored(dealt.mapInArrow(confirm, "a binary, b binary").distinct(), parts)


def trees(links: DataFrame, parts: int) -> DataFrame:
    """(cls, comp) of links (a: hub, b: class) in which every class has one hub, by pointer jumping: the hub of the hub,
    until nothing moves. Hubs cannot form a cycle, as a hub's buckets weigh more than those of the class that names it."""
    up = links.select(F.col("b").alias("cls"), F.col("a").alias("comp"))
    while True:
        above = up.select(F.col("cls").alias("comp"), F.col("comp").alias("higher"))
        moved = stored(up.join(above, "comp", "left").select("cls", F.coalesce("higher", "comp").alias("comp"),
                                                             F.col("higher").isNotNull().alias("moved")), parts)
        up = moved.select("cls", "comp")
        if moved.filter("moved").isEmpty():
            return stored(up.unionByName(up.select(F.col("comp").alias("cls"), "comp").distinct()), parts)


def components(links: DataFrame, parts: int = 200) -> DataFrame:
    """(cls, comp): for every class with a link, the smallest class of its connected component."""
    edges = stored(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
                   parts)
    state = None
    while True:
        now = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if now == state or not now["n"]:
            return edges.select(F.col("u").alias("cls"), F.col("v").alias("comp")).unionByName(
                edges.select(F.col("v").alias("cls"), F.col("v").alias("comp")).distinct())
        state = now
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stored(large, parts)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stored(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), parts)


def buckets_of(classes: DataFrame, rows: int) -> DataFrame:
    """(key, cls, size) of every band bucket with two classes or more."""
    keys = F.transform(F.sequence(F.lit(0), F.lit(HASHES // rows - 1)), lambda k: F.xxhash64(
        k, F.substring(F.col("sig"), k * (4 * rows) + 1, F.lit(4 * rows))))
    bands = classes.select("cls", F.explode(keys).alias("key"))
    shared = bands.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    return bands.join(shared, "key")


def hubs_of(members: DataFrame) -> DataFrame:
    """(cls, hub): a class's hub is the one that most of its buckets name. A bucket names its member with the largest
    buckets over all bands: of a group of near copies the text in their middle."""
    weight = members.groupBy("cls").agg(F.sum("size").alias("weight"))
    named = members.join(weight, "cls").groupBy("key").agg(F.max(F.struct("weight", "cls")).alias("top"))
    votes = members.join(named, "key").groupBy("cls", "top").agg(F.count(F.lit(1)).alias("votes"))
    return votes.groupBy("cls").agg(F.max_by(F.col("top.cls"), F.struct("votes", "top")).alias("hub"))


def apart(members: DataFrame, hubs: DataFrame, classes: DataFrame, comps: DataFrame, texts: DataFrame,
          threshold_pct: int, parts: int) -> DataFrame:
    """Links (a, b) between different components among all candidates, found and verified in blocks.

    The classes of one hub are a cluster. A class visits the other clusters that its buckets reach. Of each cluster, the
    classes outside its largest component and the visitors are compared with all its classes, block by block."""
    threshold = threshold_pct / 100
    needed = _needed(threshold)
    placed = hubs.join(comps, "cls", "left").join(classes.select("cls", "n"), "cls") \
        .select("cls", "hub", "n", F.coalesce("comp", "cls").alias("comp"))
    near = members.select("key", "cls").join(hubs, "cls")
    reach = near.select("key", "hub").distinct()
    crossed = reach.groupBy("key").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("key")
    visits = near.join(crossed, "key").select("key", "cls", F.col("hub").alias("own")) \
        .join(reach, "key").filter("hub <> own").select("cls", "hub").distinct() \
        .join(placed.select("cls", "n", "comp"), "cls").select("cls", "hub", "n", "comp", F.lit(True).alias("visitor"))
    rows = stored(placed.select("cls", "hub", "n", "comp", F.lit(False).alias("visitor")).unionByName(visits), parts)
    counts = rows.groupBy("hub", "comp").agg(F.count_if(~F.col("visitor")).alias("own"), F.count_if("visitor").alias("guests"),
                                              F.sum("n").alias("n"))
    mixed = counts.groupBy("hub").agg(
        F.sum("own").alias("size"), F.sum("guests").alias("guests"), F.count(F.lit(1)).alias("comps"),
        F.sum("n").alias("n"), F.max(F.struct("own", "comp")).alias("top")).filter("comps > 1") \
        .withColumn("long", F.ceil(F.col("n") / BLOCK_SHINGLES)) \
        .select("hub", F.col("top.comp").alias("main"),
                F.greatest(F.ceil(F.col("size") / BLOCK), "long", F.lit(1)).cast("int").alias("wide"),
                F.greatest(F.ceil((F.col("size") - F.col("top.own") + F.col("guests")) / BLOCK),
                           F.least("long", F.col("size") + F.col("guests")), F.lit(1)).cast("int").alias("deep"))
    open_rows = rows.join(mixed, "hub")
    upto = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    held = open_rows.filter(~F.col("visitor")).withColumn("i", F.pmod(F.xxhash64("cls"), F.col("wide")).cast("int")) \
        .withColumn("j", upto("deep")).select("hub", "i", "j", F.lit(0).alias("role"), "cls", "comp",
                                             (F.col("comp") == F.col("main")).alias("settled"))
    asking = open_rows.filter(F.col("visitor") | (F.col("comp") != F.col("main"))) \
        .withColumn("j", F.pmod(F.xxhash64("cls", F.lit(1)), F.col("deep")).cast("int")).withColumn("i", upto("wide")) \
        .select("hub", "i", "j", F.lit(1).alias("role"), "cls", "comp", "visitor")
    block_rows = held.unionByName(asking.withColumnRenamed("visitor", "settled")) \
        .join(classes.select("cls", "n", "sig"), "cls").join(texts, "cls") \
        .select("hub", "i", "j", "role", "cls", "comp", "settled", "n", "sig", "data")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()

        def each():
            for batch in batches:
                yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

        for _, block in groupby(each(), key=lambda r: r[:3]):  # about 2 * BLOCK rows at most
            ours, queries = [], []
            for r in block:
                (queries if r[3] else ours).append(r)
            if not ours or not queries:
                continue
            sets: dict[bytes, np.ndarray] = {}
            root: dict[bytes, bytes] = {}

            def set_of(r):
                if r[4] not in sets:
                    sets[r[4]] = shingles(words_of(r[9]), hashes)
                return sets[r[4]]

            def find(c):
                while root.get(c, c) != c:
                    root[c] = root.get(root[c], root[c])
                    c = root[c]
                return c

            found: list[tuple[bytes, bytes]] = []
            sigs, n = unpacked([r[8] for r in ours]), np.array([r[7] for r in ours])
            cls = np.array([int.from_bytes(r[4][:7], "big") for r in ours])
            settled = np.array([r[6] for r in ours])
            for r in queries:
                fits = np.minimum(n, r[7]) >= threshold * np.maximum(n, r[7]) - 1e-9
                if not r[6]:  # two classes of the cluster that both ask meet once
                    fits &= settled | (cls <= int.from_bytes(r[4][:7], "big"))
                at = np.flatnonzero(fits)
                for k in at[agree(sigs[at], np.frombuffer(r[8], "<u4"), needed)].tolist():
                    mine, theirs = find(r[5]), find(ours[k][5])
                    if mine != theirs:  # inside one component a link changes nothing
                        both = shared(set_of(r), set_of(ours[k]))
                        if 100 * both >= threshold_pct * (r[7] + ours[k][7] - both):
                            found.append((r[4], ours[k][4]))
                            root[max(mine, theirs)] = min(mine, theirs)
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.binary()),
                                              pa.array([y for _, y in found], pa.binary())], ["a", "b"])

    dealt = block_rows.repartition("hub", "i", "j").sortWithinPartitions("hub", "i", "j")
    return stored(dealt.mapInArrow(compare, "a binary, b binary").distinct(), parts)


def near_duplicates(docs: DataFrame, threshold_pct: int = 85, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id``, cls (class digest), n (set size), group (component digest; null without words),
    component_id (smallest id of the component)."""
    spark = prepare(docs.sparkSession)
    ensure_checkpoint_dir(spark)
    threshold = threshold_pct / 100
    texts = docs.select(F.col(id_col).alias("id"), text_bytes(text_col).alias("data"))
    sketched = written(texts.withColumn("s", sketches(F.col("data"))).select("id", "s.cls", "s.n", "s.sig"))
    classes = written(sketched.filter("cls is not null").groupBy("cls").agg(
        F.min("id").alias("id"), F.max("n").alias("n"), F.max("sig").alias("sig")))
    parts = partitions_for(classes)
    members = written(buckets_of(classes, band_rows(threshold)))
    meant = members.select("cls").distinct().join(classes.select("cls", "id"), "cls")
    own = written(texts.withColumn("cls", classes_of(F.col("data"))).filter("cls is not null").alias("t").join(
        meant.alias("m"), (F.col("t.cls") == F.col("m.cls")) & F.col("t.id").eqNullSafe(F.col("m.id"))
    ).select(F.col("t.cls").alias("cls"), F.col("t.data").alias("data")))
    hubs = stored(hubs_of(members), parts)
    first = hubs.filter("hub <> cls").select(F.col("hub").alias("a"), F.col("cls").alias("b"))
    links = verified(plausible(first, classes, threshold), own, threshold_pct, parts)
    comps = trees(links, parts)
    more = apart(members, hubs, classes, comps, own, threshold_pct, parts)
    if not more.isEmpty():
        stars = comps.filter("cls <> comp").select(F.col("comp").alias("a"), F.col("cls").alias("b"))
        comps = stored(components(stars.unionByName(more), parts), parts)
    placed = classes.select("cls", "id").join(comps, "cls", "left").select("cls", "id", F.coalesce("comp", "cls").alias("group"))
    smallest = placed.groupBy("group").agg(F.min("id").alias("component_id"))
    found = placed.select("cls", "group").join(smallest, "group")
    rows = sketched.select("id", "cls", "n").join(found, "cls", "left")
    return rows.select("id", "cls", "n", "group", F.when(F.col("cls").isNull(), F.col("id"))
                       .otherwise(F.col("component_id")).alias("component_id"))


def report(docs: DataFrame, threshold_pct: int = 85) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    found = near_duplicates(docs, threshold_pct)
    return found.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id",
                        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def keep_one(docs: DataFrame, threshold_pct: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest id. Rows without words all stay; of rows
    that repeat that smallest id (or of a component without ids) one stays."""
    found = near_duplicates(docs, threshold_pct, id_col, text_col)
    gone = found.filter("group is not null").filter(~F.col("id").eqNullSafe(F.col("component_id"))) \
        .select(F.col("id").alias("__id"), F.col("cls").alias("__cls")).distinct()
    twice = stored(found.filter("group is not null").filter(F.col("id").eqNullSafe(F.col("component_id")))
        .groupBy("group").agg(F.count(F.lit(1)).alias("c"), F.min("cls").alias("__cls"), F.first("component_id").alias("__id")) \
        .filter("c > 1").select("__id", "__cls", "group"), default_parallelism(docs.sparkSession))
    mark, of_group = fresh(docs, "cls"), fresh(docs, "group")
    marked = docs.withColumn(mark, classes_of(text_bytes(text_col)))
    same = lambda other: marked[f"`{id_col}`"].eqNullSafe(other["__id"]) & (marked[mark] == other["__cls"])
    kept = marked.join(gone, same(gone), "left_anti")
    if twice.isEmpty():
        return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
    again = found.filter("group is not null").join(twice.select("group"), "group", "left_semi") \
        .filter(F.col("id").eqNullSafe(F.col("component_id"))).select(
            F.col("id").alias("__id"), F.col("cls").alias("__cls"), "group").distinct().checkpoint()
    whole = kept.join(again.drop("group"), same(again), "left_anti")
    one = kept.alias("k").join(again.select(F.col("__id").alias("__rid"), F.col("__cls").alias("__rcls"), F.col("group").alias(of_group)).alias("g"),
                               F.col(f"k.`{id_col}`").eqNullSafe(F.col("g.__rid")) & (F.col(f"k.{mark}") == F.col("g.__rcls"))) \
        .dropDuplicates([of_group]).select(*[F.col(f"k.`{c}`") for c in docs.columns])
    return whole.select(*[F.col(f"`{c}`") for c in docs.columns]).unionByName(one)


ship_by_value(__name__)
