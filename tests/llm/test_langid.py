import re
import zlib
from collections import Counter

from llm_util import make_docs

from finsight.llm import langid as op

TEXTS = {"en": "the quick brown fox jumps over the lazy dog and then the other thing with that",
         "de": "der schnelle braune Fuchs springt über den faulen Hund und dann noch die Sache mit dem",
         "fr": "le renard brun saute par-dessus le chien paresseux et puis une autre chose avec ça"}


def brute_profiles(rows, length=op.PROFILE):
    counts = {}
    for text, lang in rows:
        if text is None or lang is None:
            continue
        c = counts.setdefault(lang, Counter())
        for run in re.findall(r"[^\W\d_]+", text.lower()):
            p = f" {run} "
            c.update(g for n in (1, 2, 3) for i in range(len(p) - n + 1) if (g := p[i:i + n]) != " ")
    return {k: [g for g, _ in sorted(c.items(), key=lambda x: (-x[1], x[0]))[:length]] for k, c in sorted(counts.items()) if c}


def brute_predict(text, profiles, length=op.PROFILE):
    own = Counter()
    for run in re.findall(r"[^\W\d_]+", (text or "").lower()):
        p = f" {run} "
        own.update(g for n in (1, 2, 3) for i in range(len(p) - n + 1) if (g := p[i:i + n]) != " ")
    if not own or not profiles:
        return op.UNKNOWN, 0.0
    rank = {g: sum(v > own[g] for v in own.values()) for g in own}
    rank = {g: r for g, r in rank.items() if r < length}
    away = {k: sum(abs(p.index(g) - r) if g in p else length for g, r in rank.items()) for k, p in profiles.items()}
    best = min(away, key=lambda k: (away[k], k))
    return best, 1 - away[best] / (length * len(rank))


def rows():
    out, n = [], 0
    for _ in range(6):
        for lang, text in TEXTS.items():
            words = text.split()
            out.append((n, " ".join(words[n % 5:] + words[:n % 7]), lang))
            n += 1
    out += [(100, None, "en"), (101, "", "en"), (102, "123 ... !!", "de"), (103, "ÜBER den Hund", None), (104, "中文字符測試" * 9, "en"),
            (105, "the dog " * 20000, "en"), (None, "le chien", "fr"), (7, "the dog", "en"), (7, "the dog", "en")]
    return out


def test_matches_brute_force(spark):
    given = rows()
    train = [(t, lang) for i, t, lang in given if zlib.crc32(("" if i is None else str(i)).encode()) % 4 != 2]
    profiles = brute_profiles(train)
    assert op.fit_profiles(op.training_rows(make_docs(spark, given))) == profiles
    got = sorted([(str(r.doc_id), r.held_out, r.lang_pred, round(r.score, 9)) for r in op.report(make_docs(spark, given)).collect()])
    want = sorted([(str(i), zlib.crc32(("" if i is None else str(i)).encode()) % 4 == 2,
                    *((x := brute_predict(t, profiles))[:1]), round(x[1], 9)) for i, t, _ in given])
    assert got == want


def test_many_letters_take_the_same_numbers(monkeypatch):
    grams = op.Grams()
    want = [Counter(op.grams_of(t.lower())) for t in TEXTS.values()]
    assert [Counter(grams.names[i] for i in grams.of(t)) for t in TEXTS.values()] == want
    monkeypatch.setattr(op, "LETTERS", 5)  # nearly every text now has letters beyond the coded ones
    monkeypatch.setattr(op, "CODES", 6 ** 3)
    few = op.Grams()
    assert [Counter(few.names[i] for i in few.of(t)) for t in TEXTS.values()] == want


def test_empty_table_and_no_training(spark):
    assert op.report(make_docs(spark, [])).count() == 0
    assert [tuple(r) for r in op.report(make_docs(spark, [(1, "abc", None)])).select("lang_pred", "score").collect()] == [("und", 0.0)]


def test_held_out_accuracy(spark):
    from conftest import SF_SMALL
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    held = op.report(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out")
    right, total = held.filter("lang = lang_pred").count(), held.count()
    assert total > 100 and right >= 0.98 * total


def test_keep_identified(spark):
    given = make_docs(spark, rows())
    kept = op.keep_identified(given, op.training_rows(given))
    assert kept.columns == given.columns
    ids = [r.doc_id for r in kept.collect()]
    assert not {100, 101, 102} & set(ids) and ids.count(7) == 3 and len(ids) == len(rows()) - 3
    only = op.keep_identified(given, op.training_rows(given), accepted=["fr"])
    assert {r.lang for r in only.collect()} <= {"fr", None}
