import math
import re
from collections import Counter

import pytest
import xxhash
from llm_util import generator, make_docs, sentence

from finsight.llm import quality_ratio as op

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def h64(*values):
    """Spark's xxhash64 of strings or longs, seed chained."""
    seed = 42
    for v in values:
        data = v.encode() if isinstance(v, str) else (v & (2 ** 64 - 1)).to_bytes(8, "little")
        seed = xxhash.xxh64_intdigest(data, seed)
    return seed - 2 ** 64 if seed >= 2 ** 63 else seed


def words(text):
    return [w for w in SPACE.split(text or "") if w]


def base(text):
    w = words(text)
    grams = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    covered = {i + k for i in range(len(w) - 4) if grams[tuple(w[i:i + 5])] > 1 for k in range(5)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered),
            len(w) < 10 or 100 * len(covered) > 20 * len(w))


def grams(text):
    h = [h64(w) for w in words(text)]
    return [x % op.BUCKETS for x in h] + [h64(a, b) % op.BUCKETS for a, b in zip(h, h[1:])]


def brute(docs, trusted):
    raw, own = Counter(), Counter()
    for i, t in docs:
        g = grams(t)
        raw.update(g)
        if i in trusted:
            own.update(g)
    nr, no = sum(raw.values()), sum(own.values())
    weight = lambda b: 0.0 if not no else math.log((own[b] + 1) / (no + op.BUCKETS)) - math.log((raw[b] + 1) / (nr + op.BUCKETS))
    out = []
    for i, t in docs:
        g = grams(t)
        score = sum(map(weight, g)) / len(g) if g else None
        b = base(t)
        out.append((i, *b, not b[-1] and score >= op.THRESHOLD, score))
    return out


def corpus(rng):
    twice = sentence(rng, 30)
    docs = [(i, sentence(rng, rng.randint(1, 60))) for i in range(40)]
    docs += [(100, None), (101, ""), (102, " \n\t\r\x0b"), (103, twice + " " + twice), (104, "a b c d e f a b c d e f g"), (105, "x " * 30),
             (106, "line one two\nline one two\n\n \nother|#<>\nline one two"), (107, "é é\x1cz \U0001F600 word"), (108, "a b c d e"),
             (109, sentence(rng, 30000)), (110, " ".join(["p q r s t u v"] * 4000)), (None, twice), (7, twice), (7, twice), (111, "a\nb c d e a\nb c d e q")]
    return docs


def test_matches_brute_force(spark):
    docs = corpus(generator())
    trusted = set(range(0, 40, 2)) | {7, 109, 500}
    labels = spark.createDataFrame([(i, 1, None) for i in trusted] + [(1, 0, 1), (None, 1, 0), (2, None, 0), (4, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    got = [(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept, r.lm_ratio)
           for r in op.report(make_docs(spark, docs), labels).collect()]
    key = lambda r: (str(r[0]), r[1:8])
    got, want = sorted(got, key=key), sorted(brute(docs, trusted), key=key)
    assert [r[:8] for r in got] == [r[:8] for r in want]
    for a, b in zip(got, want, strict=True):
        assert a[8] == (None if b[8] is None else pytest.approx(b[8], abs=1e-9))


def test_no_trusted_and_empty(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = make_docs(spark, [(1, "a b c d e f g h i j k")])
    assert [(r.kept, r.lm_ratio) for r in op.report(docs, labels).collect()] == [(True, 0.0)]
    assert op.report(make_docs(spark, []), labels).count() == 0


def test_runs_without_python_workers(spark):
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    df = op.report(make_docs(spark, [(1, "a b")]), labels)
    plan = df._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_verdicts_do_not_depend_on_the_size_of_the_corpus(spark):
    rng = generator()
    common, rare, odd = ([f"{stem}{i}" for i in range(n)] for stem, n in (("c", 60), ("r", 4000), ("x", 400)))
    good = lambda: " ".join(rng.choice(common if rng.random() < 0.6 else rare) for _ in range(120))
    poor = lambda: " ".join(rng.choice(odd if rng.random() < 0.6 else rare) for _ in range(120))
    kinds = ["good"] * 40 + ["plain"] * 40 + ["poor"] * 20  # labelled 1, not labelled, labelled 0

    def drawn(start, times):
        return [(start + i, poor() if kind == "poor" else good(), kind) for i, kind in enumerate(kinds * times)]

    fixed = drawn(0, 1)
    kept = {}
    for name, rows in (("small", fixed), ("large", fixed + drawn(1000, 15))):
        labels = spark.createDataFrame([(i, int(k == "good"), 0) for i, _, k in rows if k != "plain"],
                                       "doc_id long, quality int, toxic int")
        got = op.report(make_docs(spark, [r[:2] for r in rows]), labels).filter("doc_id < 1000").collect()
        kept[name] = {r.doc_id: r.kept for r in got}
        for kind, least, most in (("good", 0.85, 1), ("plain", 0.85, 1), ("poor", 0, 0.1)):
            own = [kept[name][i] for i, _, k in fixed if k == kind]
            assert least <= sum(own) / len(own) <= most, (name, kind, sum(own) / len(own))
    assert sum(kept["small"][i] == kept["large"][i] for i, *_ in fixed) >= 0.95 * len(fixed)
