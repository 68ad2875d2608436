import math
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_util import generator, make_docs, sentence

from finsight.llm import attention_lm as op


def corpus(rng):
    docs = [(i, sentence(rng, rng.randint(1, 80))) for i in range(60)]
    return docs + [(100, None), (101, ""), (102, " \n"), (103, "Éa ÉA éa Word WORD"), (104, "unseen" + "z" * 3000), (105, sentence(rng, 9000)),
                   (None, "null id"), (7, "twice the same"), (7, "twice the same"), (106, "a b c\x1cd")]


def words(text):
    return (text or "").encode().lower().split()


def held(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1


def brute(docs):
    counts = Counter()
    for i, t in docs:
        if not held(i):
            counts.update(words(t))
            counts[b"\n"] += 1
    n, v = sum(counts.values()), len(counts)
    out = []
    for i, t in docs:
        w = [*words(t), b"\n"]
        out.append((str(i), held(i), len(w), sum(counts[x] > 0 for x in w), n,
                    sum(math.log10((counts[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w)))
    return sorted(out)


@pytest.mark.parametrize("frequent", [op.FREQUENT, 5])
def test_base_matches_brute_force(spark, monkeypatch, frequent):
    monkeypatch.setattr(op, "FREQUENT", frequent)  # with 5, nearly every token takes the join
    docs = corpus(generator())
    got = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score)
                 for r in op.report(make_docs(spark, docs), sample=20, steps=5).collect())
    want = brute(docs)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want, strict=True):
        assert g[5] == pytest.approx(w[5], abs=1e-6)


def test_empty_table_and_no_training(spark):
    assert op.report(make_docs(spark, []), sample=5, steps=2).count() == 0
    only = next(i for i in range(100) if held(i))
    r = op.report(make_docs(spark, [(only, "")]), sample=5, steps=2).collect()[0]
    assert (r.n_tokens, r.n_known, r.train_tokens, r.base_score) == (1, 0, 0, 0.0) and r.score < 0


def language(steps=40):
    rng = np.random.default_rng(1)
    size = 300
    counts = rng.integers(0, 50, size).astype(float)
    class_of = op.classes_by_count(counts, [f"{'▁' * (i % 2)}p{i}" for i in range(size)])
    lm = op.Language(b"", counts, class_of, rng.integers(0, 9, (op.CLASSES + 1, size)).astype(np.float32))
    texts = [np.cumsum(rng.integers(1, 3, n)) % size for n in (1, 15, 16, 17, 200, 33)]
    lm.train(texts, steps)
    return lm, texts


def test_windows_score_each_subword_once_like_one_by_one():
    lm, texts = language()
    for text, total in zip(texts, lm.score(texts), strict=True):
        want = 0.0
        for i, target in enumerate(text):
            # the window that scores position i: its context block, and its own block up to i
            block = i // op.CONTEXT
            inputs = np.full(2 * op.CONTEXT, lm.pad)
            stream = [lm.start, *lm.rows[text[:-1]]]
            for j in range(2 * op.CONTEXT):
                at = (block - 1) * op.CONTEXT + j
                if 0 <= at <= i:  # nothing after i is shown
                    inputs[j] = stream[at]
            blocks = inputs.reshape(2, -1)
            shown = lm.log_classes(blocks)[1][i % op.CONTEXT]
            shown = shown - shown.max()
            want += shown[lm.class_of[target]] - np.log(np.exp(shown).sum()) \
                + lm.inside[lm.before(blocks[1])[i % op.CONTEXT], target]
        assert total == pytest.approx(want / np.log(10), rel=1e-4)


def test_probabilities_sum_to_one():
    lm, _ = language()
    blocks, _ = op.blocks_of(np.array([3, 4, 5]), lm.rows, lm.pad)
    z = lm.log_classes(blocks)[1][1]
    p = np.exp(z - z.max())
    p /= p.sum()
    assert (p[lm.class_of] * np.exp(lm.inside[lm.before(blocks[1])[1]])).sum() == pytest.approx(1, abs=1e-4)


def test_gradients():
    lm, texts = language(steps=0)
    lm.net.p["w2"] = np.random.default_rng(2).standard_normal(lm.net.p["w2"].shape).astype(np.float64) * 0.1
    lm.net.p = {k: v.astype(np.float64) for k, v in lm.net.p.items()}
    blocks, targets = op.blocks_of(texts[4], lm.rows, lm.pad)
    blocks = np.stack([blocks[:-1], blocks[1:]], 1).reshape(-1, op.CONTEXT)
    goal = targets[1:].reshape(-1)
    real = np.flatnonzero(goal >= 0)

    def loss():
        z = lm.log_classes(blocks, pairs=True)[1]
        z = z - z.max(1, keepdims=True)
        return -(z[real, lm.class_of[goal[real]]] - np.log(np.exp(z).sum(1))[real]).sum()

    f, z = lm.log_classes(blocks, pairs=True)
    z = np.exp(z - z.max(1, keepdims=True))
    z /= z.sum(1, keepdims=True)
    z[real, lm.class_of[goal[real]]] -= 1
    z[goal < 0] = 0
    grads = lm.net.backward(blocks, f, z)
    for name in op.Net.NAMES:
        value, g = lm.net.p[name], grads[name]
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        old = value[at]
        value[at] = old + 1e-5
        up = loss()
        value[at] = old - 1e-5
        down = loss()
        value[at] = old
        assert g[at] == pytest.approx((up - down) / 2e-5, rel=2e-2), name


def test_training_lowers_the_loss(spark):
    docs = [(i, "the cat sat on the mat and the dog sat on the log " * 5) for i in range(40)]
    few = op.report(make_docs(spark, docs), sample=20, steps=0).agg({"score": "sum"}).first()[0]
    many = op.report(make_docs(spark, docs), sample=20, steps=150).agg({"score": "sum"}).first()[0]
    assert many > few


def test_pairs_across_words_are_counted_in_all_texts(spark):
    import sentencepiece
    encoder = sentencepiece.SentencePieceProcessor(model_file=op.TOKENIZER)
    model, size = open(op.TOKENIZER, "rb").read(), encoder.vocab_size()
    texts = ["the cat sat", "the dog ran", None, "cat the"] + [f"word{i} follows word{i + 1}" for i in range(500)]
    class_of = np.arange(size) % op.CLASSES
    want = Counter()
    for t in texts:
        before = op.CLASSES
        for i in [i for w in (t or "").split() for i in encoder.encode(w)] + [encoder.eos_id()]:
            want[before, i] += 1
            before = class_of[i]
    got = op.transitions(spark.createDataFrame([(t and t.encode(),) for t in texts], "data binary").repartition(3), model, class_of)
    assert {(int(c), int(i)): int(got[c, i]) for c, i in zip(*np.nonzero(got))} == {(int(c), int(i)): n for (c, i), n in want.items()}


def test_every_training_text_has_a_part_in_the_gradients(spark):
    model, rng = open(op.TOKENIZER, "rb").read(), generator()
    texts = [sentence(rng, rng.randint(1, 60)) for _ in range(30)] + [None, ""]
    data = [None if t is None else t.encode() for t in texts]
    rows = spark.createDataFrame([(d,) for d in data], "data binary")
    lm = op.fit(rows, op.token_counts(rows), op.TOKENIZER, sample=2, steps=30, rounds=0)
    pieces = op.Pieces(model)
    ids = [pieces.of([*op.words_of(d), op.END]) for d in data]
    want, n = lm.gradients(*lm.windows(ids))
    for parts in (1, 5):
        got, seen = op.summed_gradients(rows.repartition(parts), lm)
        assert seen == n == sum(map(len, ids))
        for k, g in want.items():
            assert got[k] == pytest.approx(g, abs=1e-3), k


def test_rounds_over_all_texts_lower_the_loss(spark):
    docs = [(i, "the cat sat on the mat and the dog sat on the log " * 5) for i in range(20)] \
        + [(i, "a cow ran by a tree while no fox hid in any den " * 5) for i in range(20, 60)]
    total = lambda rounds: op.report(make_docs(spark, docs), sample=1, steps=100, rounds=rounds).agg({"score": "sum"}).first()[0]
    assert total(8) > total(0)


def test_the_model_loads_where_the_package_is_not_installed(tmp_path):
    """Executors may lack the package: the model travels by value and scores in a bare interpreter."""
    import subprocess
    import sys

    from pyspark import cloudpickle

    from finsight.llm.common import by_value
    model = language()[0]
    ids = [np.asarray([5, 9, 11, 2], np.int32)]
    (tmp_path / "model").write_bytes(by_value((model, ids)))
    code = ("import sys; from pyspark import cloudpickle; m, ids = cloudpickle.loads(open(sys.argv[1], 'rb').read()); "
            "assert not any(k.startswith('finsight') for k in sys.modules); print(repr(float(m.score(ids)[0])))")
    out = subprocess.run([sys.executable, "-I", "-c", code, str(tmp_path / "model")], capture_output=True, text=True, cwd="/")
    assert out.returncode == 0, out.stderr[-800:]
    assert float(out.stdout) == pytest.approx(float(cloudpickle.loads(by_value(model)).score(ids)[0]))


def test_split_columns_are_the_words_of_each_text():
    import pyarrow as pa
    texts = [b"a" + bytes([i]) + b"B \xff" for i in range(256)] + [None, b"", b" \n ", b"\ta  B\x0b", "\u00c9A \u00a0x".encode()]
    for column in (pa.array(texts, pa.binary()), pa.array([b"x y", *texts], pa.binary())[1:], pa.array([], pa.binary())):
        found, counts = op.words_in(column)
        want = [op.words_of(t) for t in column.to_pylist()]
        assert counts.tolist() == list(map(len, want)) and found.to_pylist() == [w for t in want for w in t]


def test_gradients_of_whole_texts_are_those_of_their_windows():
    lm, texts = language()
    texts = [*texts, texts[4][:1], texts[4][::-1]]
    want, n = lm.gradients(*lm.windows(texts))
    for chunk in (1, 7, 256):
        got, seen = lm.all_gradients(texts, chunk)
        assert seen == n
        for k, g in want.items():
            assert got[k] == pytest.approx(g, abs=1e-3, rel=1e-3), (k, chunk)
    lm.net.p["w2"] *= 1e4  # logits that need a shift
    got = lm.all_gradients(texts)[0]
    assert all(np.isfinite(g).all() for g in got.values()) and np.isfinite(lm.score(texts)).all()


def test_texts_are_encoded_once(spark):
    """The pairs and the rounds read stored ids; they need neither the text nor the tokenizer."""
    import sentencepiece
    model, rng = open(op.TOKENIZER, "rb").read(), generator()
    size = sentencepiece.SentencePieceProcessor(model_proto=model).vocab_size()
    texts = [sentence(rng, rng.randint(1, 60)) for _ in range(20)] + [None, "", " Lead  and tail ", "Zz" * 50]
    rows = spark.createDataFrame([(None if t is None else t.encode(),) for t in texts], "data binary").repartition(3)
    kept = op.stored(op.hashed(rows), model, size).drop("data").localCheckpoint()
    pieces = op.Pieces(model)
    want = sorted(tuple(pieces.of([*words(t), op.END]).tolist()) for t in texts)
    assert sorted(tuple(np.frombuffer(r.ids, op.id_type(size)).tolist()) for r in kept.collect()) == want
    class_of = np.arange(size) % op.CLASSES
    assert (op.transitions(kept.select("ids"), b"", class_of) == op.transitions(rows, model, class_of)).all()
    lm = op.Language(b"", np.ones(size), class_of, np.ones((op.CLASSES + 1, size), np.float32))
    assert op.summed_gradients(kept.select("ids"), lm)[1] == sum(map(len, want))


def test_all_texts_are_learned_in_steps_of_their_own(spark, monkeypatch):
    """No sample is collected: every text is in the steps of exactly one replica, and the result does not depend on partitions."""
    import sentencepiece
    model, rng = open(op.TOKENIZER, "rb").read(), generator()
    size = sentencepiece.SentencePieceProcessor(model_proto=model).vocab_size()
    texts = [(i, sentence(rng, rng.randint(1, 60)).encode()) for i in range(60)] + [(60, None), (61, b""), (62, b"copy"), (63, b"copy")]
    rows = spark.createDataFrame(texts, "id long, data binary")
    kept = op.stored(op.hashed(rows), model, size).drop("data").localCheckpoint()
    seen, real = [], op.learned

    def learned(part, language, replicas, *more):
        seen.extend((r.id, r.turn % 3, r.key % replicas) for r in part.collect())
        assert replicas == 4
        return real(part, language, replicas, *more)

    monkeypatch.setattr(op, "learned", learned)
    monkeypatch.setattr(op, "BATCH", 4)
    nets = [op.fit(kept.repartition(n), op.token_counts(rows), op.TOKENIZER, sample=5, steps=15, rounds=3).net.p for n in (1, 4)]
    for got in (seen[:64], seen[64:]):
        assert sorted(i for i, _, _ in got) == list(range(64))
    assert len({(turn, replica) for _, turn, replica in seen}) == 12
    for k, value in nets[0].items():
        assert nets[1][k] == pytest.approx(value, abs=1e-5), k


def test_training_sees_every_window():
    lm, texts = language(steps=0)
    seen, real = Counter(), lm.gradients
    lm.gradients = lambda pairs, targets: (seen.update(map(bytes, targets)), real(pairs, targets))[1]
    lm.train(texts * 40, 2)
    assert all(seen[k] >= n for k, n in Counter(map(bytes, lm.windows(texts * 40)[1])).items())
