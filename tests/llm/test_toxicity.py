import numpy as np
from llm_util import generator, make_docs, sentence
from pyspark.sql import functions as F

from finsight.llm import toxicity as op


def brute_highest(values, span):
    if len(values) <= span:
        return sum(values) / len(values)
    return max(sum(values[i:i + span]) / span for i in range(len(values) - span + 1))


def test_highest_run():
    rng = np.random.default_rng(0)
    for n in (1, 3, 24, 25, 100):
        v = rng.standard_normal(n)
        assert abs(op.highest(v)[0] - brute_highest(v.tolist(), op.SPAN)) < 1e-9


def corpus(rng):
    insults = ["idiot", "moron", "scumbag", "worthless", "pathetic"]
    docs, labels = [], []
    for i in range(400):
        words = sentence(rng, rng.randint(5, 200)).split()
        bad = i % 4 == 0
        for _ in range(max(1, len(words) // 60) if bad else 0):
            words.insert(rng.randrange(len(words)), rng.choice(insults) + rng.choice(["", "!!", "***"]))
        docs.append((i, " ".join(words)))
        labels.append((i, None, int(bad)))
    return docs, labels


def test_learns_and_shares_character_n_grams(spark):
    rng = generator()
    docs, labels = corpus(rng)
    extra = [(900, None), (901, ""), (902, "... !!"), (903, sentence(rng, 20000)), (904, sentence(rng, 9000) + " idiot moron " + sentence(rng, 9000)),
             (905, "you are an idiiot and a morron my friend"), (None, "the idiot"), (5, docs[5][1]), (5, docs[5][1])]
    lab = spark.createDataFrame([*labels, (None, 1, 1), (3, 1, None)], "doc_id long, quality int, toxic int")
    given = make_docs(spark, docs + extra)
    got = op.report(given, lab).collect()
    assert len(got) == len(docs) + len(extra)
    score = {r.doc_id: r for r in got}
    held = [(r.predicted, dict((i, y) for i, _, y in labels)[r.doc_id]) for r in got if r.held_out and r.doc_id is not None and r.doc_id < 400]
    assert len(held) > 80 and np.mean([p == y for p, y in held]) >= 0.95
    assert score[900].score == score[901].score == score[902].score == 0.0
    assert score[904].predicted == 1 and score[904].score > score[903].score  # 100 times longer than any labelled text
    assert score[905].score > 0.5  # misspelt
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    kept = op.keep_harmless(given, given, lab)
    assert kept.columns == given.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in got if not r.predicted)


def test_nothing_to_learn(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = make_docs(spark, [(1, "idiot"), (2, "fine")])
    assert {r.score for r in op.report(docs, none).collect()} == {0.0}
    one = spark.createDataFrame([(2, 1, 0), (3, 1, 0)], "doc_id long, quality int, toxic int")
    assert {r.score for r in op.report(docs, one).collect()} == {0.0}
    assert op.report(make_docs(spark, []), none).count() == 0


def test_held_out_rows_on_the_given_tables(spark):
    from conftest import SF_SMALL
    docs, labels = (spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in ("documents", "labels"))
    held = op.report(docs, labels).join(labels, "doc_id").filter("held_out")
    got = held.select(F.col("predicted"), F.col("toxic")).collect()
    assert np.mean([r.predicted == r.toxic for r in got]) >= 0.9
