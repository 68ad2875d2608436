from itertools import combinations

import numpy as np
from llm_util import generator, make_docs, sentence
from pyspark.sql import functions as F

from finsight.llm import minhash as op


def shingle_set(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(docs, pct):
    """doc index -> (set size, component's smallest id) by comparing all pairs."""
    sets = [shingle_set(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(docs)), 2):
        both = len(sets[i] & sets[j])
        if sets[i] and sets[j] and 100 * both >= pct * len(sets[i] | sets[j]):
            root[find(i)] = find(j)
    out = []
    for i, (doc_id, _) in enumerate(docs):
        ids = [docs[j][0] for j in range(len(docs)) if find(j) == find(i) and docs[j][0] is not None]
        comp = min(ids, default=None) if sets[i] else doc_id
        out.append((doc_id, len(sets[i]), comp, doc_id == comp))
    return sorted(out, key=repr)


def changed(rng, text, k):
    w = text.split()
    for _ in range(k):
        w[rng.randrange(len(w))] = "x" + str(rng.randrange(10 ** 6))
    return " ".join(w)


def corpus(rng):
    """Copies, near copies around the threshold, chains of near copies, shared passages, short and empty texts."""
    docs = [(900, None), (901, ""), (902, " \n\t "), (903, "one two"), (904, "One\tTWO"), (905, "one two three"),
            (906, "É a b c d"), (907, "é a b c d")]
    n = 0
    for _ in range(12):
        base = sentence(rng, 200)
        for k in (0, 0, 1, 2, 3, 4, 5, 6):
            docs.append((n, changed(rng, base, k)))
            n += 1
    step = sentence(rng, 160)
    for _ in range(25):  # each a little further from the first
        step = changed(rng, step, 1)
        docs.append((n, step))
        n += 1
    passage = sentence(rng, 60)
    for _ in range(20):
        docs.append((n, sentence(rng, 30) + " " + passage + " " + sentence(rng, 30)))
        n += 1
    docs += [(n, sentence(rng, 20000)), (n, docs[20][1]), (None, docs[20][1]), (None, "null ids only here please")]
    return docs


def rows_of(df):
    return sorted([(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect()], key=repr)


def test_components_match_brute_force(spark):
    docs = corpus(generator())
    assert rows_of(op.report(make_docs(spark, docs))) == brute(docs, 85)


def test_small_blocks_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(op, "CHUNK", 3)  # every group is split
    monkeypatch.setattr(op, "BLOCK", 3)
    docs = corpus(generator())
    assert rows_of(op.report(make_docs(spark, docs), threshold_pct=80)) == brute(docs, 80)


def test_empty_table(spark):
    assert op.report(make_docs(spark, [])).count() == 0
    assert op.keep_one(make_docs(spark, [])).count() == 0


def test_keep_one_leaves_one_row_of_each_group(spark):
    docs = corpus(generator()) + [(5, "again and again the same row of text here"), (5, "again and again the same row of text here")]
    given = make_docs(spark, docs)
    kept = op.keep_one(given)
    assert kept.columns == given.columns
    groups = {}
    for (doc_id, size, comp, _), k in zip(brute(docs, 80), range(len(docs)), strict=True):
        groups.setdefault((comp if size else ("empty", k)), doc_id)
    got = kept.select("doc_id", "text").collect()
    # null ids form one group of their own here; rows without words all stay
    assert len(got) == len({c for _, s, c, _ in brute(docs, 80) if s}) + sum(1 for _, t in docs if not shingle_set(t))
    assert sum(1 for r in got if r.text and r.text.startswith("again")) == 1


def test_bayes_bound_and_bands():
    # the posterior with a uniform prior, by simulation of the definition
    grid = (np.arange(20000) + 0.5) / 20000
    for n, t in ((24, 0.85), (72, 0.8)):
        least = op.least_matches(t, n, 1e-3)
        weight = lambda m, n=n: grid ** m * (1 - grid) ** (n - m)
        tail = lambda m, t=t: weight(m)[grid >= t].sum() / weight(m).sum()
        assert tail(least) >= 1e-3 > tail(least - 1)
    for t in (0.8, 0.85):
        assert op.missed_by_bands(t, op.band_rows(t)) <= op.MISS


def test_components_of_a_long_chain(spark):
    links = spark.range(60).select(F.md5(F.col("id").cast("string")).cast("binary").alias("a"),
                                   F.md5((F.col("id") + 1).cast("string")).cast("binary").alias("b"))
    assert op.components(links).select("comp").distinct().count() == 1
