import hashlib
from collections import Counter

import pytest
import sentencepiece
from llm_util import generator, make_docs, sentence
from tokenizers import Tokenizer

from finsight.llm import subwords
from finsight.llm import token_alignment as op


def decoder():
    """The bytes behind the characters of a byte-level vocabulary."""
    keep = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    table, extra = {}, 256
    for b in range(256):
        if b in keep:
            table[chr(b)] = b
        else:
            table[chr(extra)] = b
            extra += 1
    return table


def brute(texts):
    """Per text: None or (ids a, ids b, groups); token by token, without chunks."""
    a_side = Tokenizer.from_file(op.TOKENIZER_A)
    a_side.encode_special_tokens = True
    b_side = sentencepiece.SentencePieceProcessor(model_file=op.TOKENIZER_B)
    table, out = decoder(), []
    for text in texts:
        if not text:
            out.append(None)
            continue
        a = [(i, bytes(table[c] for c in a_side.id_to_token(i))) for i in a_side.encode(" " + text, add_special_tokens=False).ids]
        b = [(i, bytes([int(b_side.id_to_piece(i)[3:5], 16)]) if b_side.is_byte(i) else b_side.id_to_piece(i).replace("▁", " ").encode())
             for i in b_side.encode(text)]
        if any(b"".join(p for _, p in side) != b" " + text.encode() for side in (a, b)):
            out.append(None)
            continue
        groups, i, j, pa, pb = [], 0, 0, 0, 0
        while i < len(a):
            ga, gb = [a[i][0]], [b[j][0]]
            pa, pb = pa + len(a[i][1]), pb + len(b[j][1])
            i, j = i + 1, j + 1
            while pa != pb:
                if pa < pb:
                    ga.append(a[i][0])
                    pa += len(a[i][1])
                    i += 1
                else:
                    gb.append(b[j][0])
                    pb += len(b[j][1])
                    j += 1
            groups.append((ga, gb))
        out.append((len(a), len(b), groups))
    return out


def expected(texts):
    found = brute(texts)
    count = Counter((g[0][-1], g[1][-1]) for f in found if f for g in f[2])
    best = {}
    for (_, b), n in count.items():
        best[b] = max(best.get(b, 0), n)
    rows = []
    for f in found:
        if f is None:
            rows.append((0, 0, 0, 0, 0, 0, ""))
            continue
        links = [(g[0][-1], g[1][-1]) for g in f[2]]
        said = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in f[2])
        rows.append((f[0], f[1], len(links), len(links), sum(count[k] == best[k[1]] for k in links), sum(count[k] for k in links),
                     hashlib.sha256(said.encode()).hexdigest()))
    return rows


HOSTILE = [None, "", " ", "   ", "x", "▁literal", "a ▁b", "<|endoftext|> and <s> </s> <unk> <0x41>", "a  b\t\nc  ", "  lead", "\x00\x01",
           "é ﬁ ① 　wide​zeró combining", "\r\n\r\n", "😀 mixed 日本語テキスト", "naïve coöperation's 'tis", " x \u0085y", "no-space" * 4000]


def texts():
    rng = generator()
    made = [sentence(rng, rng.randint(1, 80)) for _ in range(60)]
    odd = ["".join(rng.choice(list("ab'sX1 .  \n\té́Σ　<|>") + ["the ", "  "]) for _ in range(rng.randint(1, 40))) for _ in range(120)]
    return [*HOSTILE, *made, *made[:5], *odd, "word " * 20_000]


@pytest.mark.parametrize("frequent", [op.FREQUENT, 64, 1])
def test_matches_brute_force(spark, monkeypatch, frequent):
    monkeypatch.setattr(op, "FREQUENT", frequent)
    monkeypatch.setattr(op, "SLICE_BYTES", 3000)
    monkeypatch.setattr(op, "HELD_PAIRS", 100)
    given = texts()
    rows = op.report(make_docs(spark, list(enumerate(given))).repartition(4)).collect()
    assert len(rows) == len(given)
    want = expected(given)
    for r in rows:
        assert tuple(r)[1:] == want[r.doc_id], given[r.doc_id]


def test_ranks_give_the_ids_of_the_file():
    data = open(op.TOKENIZER_A, "rb").read()
    whole = Tokenizer.from_buffer(data)
    whole.encode_special_tokens = True
    marks = [f"a{c}1{c} {c}{c}\n{c}x" for c in map(chr, range(0x3000)) if c.isprintable() or c.isspace()]
    given = [" " + t for t in [t or "" for t in texts()] + marks]
    assert subwords.byte_level_encode(data)(given) == [whole.encode(t).ids for t in given]
    other = data.replace(b'"use_regex":true', b'"use_regex": false', 1) if b'"use_regex":true' in data else data
    if other != data:  # other settings take the file's own way
        assert subwords.byte_level_encode(other)(["a b"]) == [Tokenizer.from_buffer(other).encode("a b").ids]


def test_words_of_the_piece_model_give_the_ids_of_whole_texts():
    data = open(op.TOKENIZER_B, "rb").read()
    rng = generator()
    odd = ["".join(rng.choice(list("ab  \n\t　é.") + ["   ", "the", "x y"]) for _ in range(rng.randint(1, 14))) for _ in range(3000)]
    given = [t for t in texts() + odd if t and "▁" not in t]
    model, encoder = sentencepiece.SentencePieceProcessor(model_proto=data), subwords.piece_encoder(data, held=10)
    for _ in range(2):
        flat, offsets = encoder.ids(given)
        assert [flat[a:b].tolist() for a, b in zip(offsets, offsets[1:], strict=False)] == model.encode(given)


def test_words_give_the_ids_of_whole_texts():
    rng = generator()
    odd = ["".join(rng.choice(list("aXéÉÿÀßñ×÷»''.,#<|>09 \n　́·ªµªİKÅ") + ["'s", "<|endoftext|>", "<|STARTOFTEXT|>", "H̱", "'LL"])
                   for _ in range(rng.randint(1, 16))) for _ in range(4000)]
    given = [t or "" for t in texts()] + odd + ["".join(map(chr, range(0x20, 0x180))), " ".join(map(chr, range(0x20, 0x180)))]
    words = Tokenizer.from_file("/opt/tokenizers/word_bpe_49k.json")
    encoder = subwords.word_encoder(open("/opt/tokenizers/word_bpe_49k.json", "rb").read())
    flat, offsets = encoder.ids([t.encode() for t in given])
    for t, a, b in zip(given, offsets, offsets[1:], strict=False):
        assert flat[a:b].tolist() == words.encode(t, add_special_tokens=False).ids, t


def test_groups_are_text(spark):
    row = op.align(make_docs(spark, [(1, "unbelievable tokenization")])).first()
    (_, _, groups), = brute(["unbelievable tokenization"])
    assert row.groups == ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
    assert row.n_groups == len(groups) and sum(row.times) == row.n_links


def test_empty_and_null(spark):
    assert op.report(make_docs(spark, []).limit(0)).collect() == []
    rows = op.report(make_docs(spark, [(None, None), (None, None), (3, "")])).collect()
    assert len(rows) == 3
    assert all(tuple(r)[1:] == (0, 0, 0, 0, 0, 0, "") for r in rows)
