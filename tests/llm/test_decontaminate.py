import hashlib
import re

from llm_util import generator, make_docs, sentence

from finsight.llm import decontaminate as op

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute(docs, items, n=10):
    out = []
    for doc_id, text in docs:
        w = WORD.findall(lower(text))
        hit, found = set(), set()
        for item, t in items:
            iw = WORD.findall(lower(t))
            k = min(n, len(iw))
            grams = {tuple(iw[i:i + k]) for i in range(len(iw) - k + 1)} if k else set()
            for i in range(len(w) - k + 1):
                if k and tuple(w[i:i + k]) in grams:
                    hit.update(range(i, i + k))
                    found.add(str(item))
        out.append((doc_id, len(w), len(hit), len(found),
                    hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted([(r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in df.collect()], key=repr)


def cases(rng):
    long_item, passage = sentence(rng, 40), sentence(rng, 14)
    items = [(1, long_item), (2, passage), (2, passage), (10, passage + " tail word"), (3, "Short Item"), (4, None), (5, ""),
             (6, "Éé ÀB c1")]
    docs = [(1, None), (2, ""), (3, " ... !! "), (4, "before " + passage.upper() + " after"), (4, "before " + passage),
            (5, sentence(rng, 30)), (6, "a short-item here, short\nITEM"), (7, long_item[:len(long_item) // 2]),
            (8, "éé àb c1 Éé ÀB C1"), (9, sentence(rng, 3000) + " " + long_item + " " + sentence(rng, 3000)),
            (None, passage), (11, " ".join([passage] * 50))]
    return docs, items


def test_matches_brute_force(spark):
    docs, items = cases(generator())
    bench = spark.createDataFrame(items, "item_id long, text string")
    expected = brute(docs, items)
    assert rows_of(op.report(make_docs(spark, docs), bench)) == expected
    # the same with the benchmark dealt into many blocks
    assert rows_of(op.report(make_docs(spark, docs), bench, block_words=4)) == expected


def test_empty_tables(spark):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert rows_of(op.report(make_docs(spark, [(1, "a b")]), bench)) == brute([(1, "a b")], [])
    assert op.report(make_docs(spark, []), bench).count() == 0


def test_clean_documents_and_spans(spark):
    docs, items = cases(generator())
    bench = spark.createDataFrame(items, "item_id long, text string")
    given = make_docs(spark, docs)
    dirty = {r[0] for r in brute(docs, items) if r[5]}
    kept = op.clean_documents(given, bench)
    assert kept.columns == given.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, _ in docs if i not in dirty)
    cut = op.remove_spans(given, bench)
    assert cut.columns == given.columns and cut.count() == len(docs)
    texts = {(r.doc_id, r.text) for r in cut.collect()}
    assert (1, None) in texts and (2, "") in texts and (4, "before  after") in texts and (8, " ") not in texts
    assert not any(r.contaminated for r in op.report(cut.filter("doc_id in (4, 8, 11)"), bench).collect())
