from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest
from llm_util import generator, make_docs, sentence
from tokenizers import Tokenizer

from finsight.llm import mixture_packing as op


def simulated(sizes, shares, window, grain):
    """The stream of (queue, token) of a literal deficit round-robin with very small quanta."""
    left, deficit, out, held = list(sizes), [Fraction(0)] * len(sizes), [], [[] for _ in sizes]
    quantum = Fraction(1, 64)
    while any(left):
        for q in range(len(sizes)):
            deficit[q] += quantum * shares[q]
        for q in range(len(sizes)):
            if deficit[q] >= 1 and left[q]:
                deficit[q] -= 1
                n = min(grain, left[q])
                held[q] += [(q, sizes[q] - left[q] + k) for k in range(n)]
                left[q] -= n
                if sum(-(-len(h) // grain) for h in held) == window // grain or not any(left):
                    out += [t for h in held for t in h]
                    held = [[] for _ in sizes]
    return out


@pytest.mark.parametrize("window,grain,sizes,shares", [
    (32, 4, [300, 70, 9], [.5, .25, .25]), (16, 2, [40, 40], [.5, .5]), (64, 8, [1, 500], [.125, .875]), (8, 8, [100], [1]),
    (32, 8, [64, 32, 32], [.5, .25, .25]), (64, 4, [400, 400, 333, 7], [.0625, .5, .375, .0625])])
def test_positions_match_a_simulated_round_robin(window, grain, sizes, shares):
    schedule = op.Schedule(np.asarray(sizes), np.asarray(shares), window, grain)
    expected = {token: k for k, token in enumerate(simulated(sizes, [Fraction(x) for x in shares], window, grain))}
    rng = np.random.default_rng(0)
    seen = set()
    for q, n in enumerate(sizes):  # documents of random sizes in a row
        cuts = np.unique(np.concatenate([[0, n], rng.integers(0, n, 5)]))
        start, size = cuts[:-1], np.diff(cuts)
        doc, first, length, sequence, offset = schedule.pieces(start, size, np.full(len(start), q))
        for d, a, m, s, o in zip(doc, first, length, sequence, offset, strict=True):
            for k in range(m):
                at = int(schedule.sequence_start(np.asarray(s))) + o + k
                assert at == expected[q, int(start[d] + a + k)]
                seen.add(at)
    assert seen == set(range(sum(sizes)))


def test_queues_keep_to_their_shares_after_every_window():
    rng = np.random.default_rng(1)
    totals = rng.integers(1, 200_000, 300)
    schedule = op.Schedule(totals, totals / totals.sum(), 2048, 64)
    windows = np.arange(schedule.size // 2048 - 10)
    given = schedule.given(windows)
    assert (given.sum(axis=1) == 32 * windows).all() and (np.diff(given, axis=0) >= 0).all()
    assert np.abs(given - 32 * windows[:, None] * schedule.rates).max() < 2


def corpus(rng):
    docs = [(i, sentence(rng, rng.randint(1, 300)), "en", "hot" if i % 3 == 0 else f"s{i % 7}") for i in range(400)]
    return docs + [(1000, None, "en", "s1"), (1001, "", "en", None), (None, "a b", None, None), (None, "a b", None, None),
                   (1002, sentence(rng, 9000), "en", "rare"), (1003, "x<|endoftext|>y é 　z" * 50, "en", "s2"), (1003, docs[5][1], "en", "s2")]


@pytest.fixture(scope="module")
def packed(spark):
    docs = corpus(generator())
    return docs, op.pack(make_docs(spark, docs).repartition(5)).collect()


def test_every_id_lies_in_one_piece(packed):
    docs, rows = packed
    tokenizer = Tokenizer.from_file(op.TOKENIZER)
    expected = defaultdict(int)
    for d in docs:
        ids = [*tokenizer.encode(d[1] or "", add_special_tokens=False).ids, 1]
        expected[d[0], np.asarray(ids, "<u4").tobytes()] += 1
    whole = defaultdict(list)
    for r in rows:
        assert len(r.ids) == 4 * r.length > 0
        whole[r.doc_id].append(r)
    found = defaultdict(int)
    for doc, pieces in whole.items():
        if sum(1 for d in docs if d[0] == doc) == 1:
            pieces.sort(key=lambda r: r.start)
            assert [r.start for r in pieces] == list(np.cumsum([0, *(r.length for r in pieces)])[:-1])
            assert sum(r.length for r in pieces) == pieces[0].doc_tokens
            found[doc, b"".join(r.ids for r in pieces)] += 1
        else:
            assert sum(r.length for r in pieces) == sum(len(k[1]) // 4 * n for k, n in expected.items() if k[0] == doc)
    assert all(expected[k] == n for k, n in found.items())


def test_sequences_are_gapless_full_and_mixed(packed):
    docs, rows = packed
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append(r)
    assert sorted(bins) == list(range(len(bins)))
    shares = defaultdict(int)
    for k, pieces in bins.items():
        pieces.sort(key=lambda r: r.offset)
        assert [r.offset for r in pieces] == list(np.cumsum([0, *(r.length for r in pieces)])[:-1])
        size = sum(r.length for r in pieces)
        assert size == pieces[0].sequence_tokens and size <= 2048 and size & (size - 1) == 0
        for r in pieces:
            shares[r.source] += r.length
    assert sum(1 for p in bins.values() if p[0].sequence_tokens < 2048) <= 11
    total = sum(shares.values())
    full = [p for _, p in sorted(bins.items()) if p[0].sequence_tokens == 2048]
    for pieces in full[:-1]:  # the last window may hold the ends of the queues
        held = defaultdict(int)
        for r in pieces:
            held[r.source] += r.length
        for source, n in shares.items():
            assert abs(held[source] - 2048 * n / total) < 2 * op.GRAIN


def test_targets_are_met_until_a_queue_is_empty(spark):
    rng = generator()
    docs = [(i, sentence(rng, 60), "en", "a" if i % 4 else "b") for i in range(300)]
    rows = op.pack(make_docs(spark, docs), targets={"a": 0.25, "b": 0.75}).collect()
    first = defaultdict(int)
    for r in rows:
        if r.sequence_id < 4:
            first[r.source] += r.length
    assert abs(first["b"] / 8192 - 0.75) < 0.02
    assert len({r.doc_id for r in rows}) == 300  # nothing is dropped
    only = op.pack(make_docs(spark, docs), targets={"b": 1.0}).collect()
    assert len({r.doc_id for r in only}) == 300


def test_many_small_sources_share_queues(spark, monkeypatch):
    monkeypatch.setattr(op, "OWN", 8)
    monkeypatch.setattr(op, "BROADCAST_ROWS", 0)
    docs = [(i, f"word{i} and more", "en", f"s{i}") for i in range(500)]
    rows = op.pack(make_docs(spark, docs), window=256, grain=16).collect()
    spans = sorted((r.sequence_id, r.offset, r.length) for r in rows)
    assert all(b[1] == (a[1] + a[2] if a[0] == b[0] else 0) for a, b in zip(spans, spans[1:], strict=False))
    assert len({r.doc_id for r in rows}) == 500


def test_empty_table(spark):
    assert op.report(make_docs(spark, []).limit(0)).collect() == []


def test_report_columns(spark):
    import zlib
    docs = make_docs(spark, [(1, "one two three", "en", "a"), (2, None, "en", "b")])
    ids = {r.doc_id: r.ids for r in op.pack(docs).collect()}
    for r in op.report(docs).collect():
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id])
    assert op.report(docs).columns[:7] == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
