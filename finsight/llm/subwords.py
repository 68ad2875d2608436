"""Subword ids of whole texts by public tokenizers, whose files are parameters: the driver reads them and ships their bytes."""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Callable, Sequence
from itertools import chain
from typing import Any

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from tokenizers import Tokenizer

from finsight.llm.common import ship_by_value

HELD_CHUNKS, LONG_CHUNK = 1_500_000, 64
#: Fixed value: how a byte-level BPE file with ``use_regex`` cuts texts.
BYTE_LEVEL_UNITS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def packed(ids: Sequence[int]) -> bytes:
    """Ids as 32-bit integers."""
    return array("i", ids).tobytes()


def listed(ids: Sequence[Sequence[int]]) -> tuple[np.ndarray, np.ndarray]:
    """All ids in a row, and the n + 1 offsets of the lists in them."""
    return np.frombuffer(b"".join(map(packed, ids)), np.int32), np.cumsum([0, *map(len, ids)])


class WordEncoder:
    """Ids of texts by a tokenizer that never looks across the places where ``cut`` cuts them.

    The ids of a text are those of its words in a row; ``encode`` maps a list of words (all strings or all bytes) to their ids as ``packed``
    gives them. At most ``held`` words are kept between calls, none longer than ``LONG_CHUNK``."""

    def __init__(self, cut: Callable[[Any], list], encode: Callable[[list], list[bytes]], held: int = HELD_CHUNKS):
        self.cut, self.encode, self.most, self.held = cut, encode, held, {}

    def ids(self, texts: list) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in a row, and the n + 1 offsets of the texts in them."""
        words = [self.cut(t) for t in texts]
        kind = pa.large_binary() if texts and isinstance(texts[0], bytes) else pa.large_string()
        coded = pa.array(list(chain.from_iterable(words)), kind).dictionary_encode()
        distinct, code = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        if len(self.held) > self.most:
            self.held.clear()
        new = [c for c in distinct if c not in self.held]
        fresh = dict(zip(new, self.encode(new), strict=True))
        parts = [fresh[c] if c in fresh else self.held[c] for c in distinct]
        self.held |= {c: ids for c, ids in fresh.items() if len(c) <= LONG_CHUNK}
        size = np.asarray([len(p) // 4 for p in parts], np.int64)
        each = size[code]
        ends = np.concatenate([[0], np.cumsum(each)]).astype(np.int64)
        at = np.repeat((np.cumsum(size) - size)[code] - ends[:-1], each) + np.arange(ends[-1])
        return np.frombuffer(b"".join(parts), np.int32)[at], ends[np.cumsum([0, *map(len, words)])]


def byte_table(tokenizer: Tokenizer) -> list[bytes]:
    """Bytes of each id of a byte-level vocabulary, whose characters each stand for one byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]  # stand for themselves
    other = [b for b in range(256) if b not in set(plain)]
    byte_of = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}
    return [bytes(byte_of.get(c, 0) for c in tokenizer.id_to_token(i) or "")
            for i in range(tokenizer.get_vocab_size(with_added_tokens=True))]


def byte_level_encode(data: bytes) -> Callable[[list[str]], list[list[int]]]:
    """Ids of texts by a byte-level BPE file in JSON; strings of special tokens in texts are plain text.

    Where the file has the usual settings and its merges make the ids in order, the same vocabulary as ranks gives the same ids faster."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    tokenizer, settings = Tokenizer.from_buffer(data), json.loads(data)
    tokenizer.encode_special_tokens = True
    cutter, model, table = settings.get("pre_tokenizer") or {}, settings["model"], byte_table(tokenizer)
    merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model.get("merges") or ()]
    usual = not settings.get("normalizer") and not model.get("dropout") and not model.get("ignore_merges") \
        and (cutter.get("type"), cutter.get("use_regex"), cutter.get("add_prefix_space")) == ("ByteLevel", True, False) \
        and [model["vocab"].get(m) for m in merged] == list(range(256, 256 + len(merged)))
    if not usual:
        return lambda texts: [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    ranks = {table[i]: i for i in range(256 + len(merged))}
    by_rank = tiktoken.Encoding("ranks", pat_str=BYTE_LEVEL_UNITS, mergeable_ranks=ranks, special_tokens={})
    return lambda texts: [by_rank.encode_ordinary(t) for t in texts]


_SPACE = re.compile("(?<=[^ ]) (?=.)", re.DOTALL)


def by_spaces(text: str) -> list[str]:
    """The text cut at the first space of each run of spaces, but not at its very end."""
    return text.split(" ") if "  " not in text and text[:1] != " " and text[-1:] != " " else _SPACE.split(text)


def piece_encoder(data: bytes, held: int = 400_000) -> WordEncoder:
    """A sentencepiece model that puts a space in front of what it encodes.

    If no piece holds a space behind anything else, no merge crosses the place before a run of spaces, and texts are cut there."""
    model = sentencepiece.SentencePieceProcessor(model_proto=data)
    crossing = any("▁" in model.id_to_piece(i).lstrip("▁") for i in range(model.get_piece_size()))
    return WordEncoder((lambda text: [text]) if crossing else by_spaces,
                       lambda words: list(map(packed, model.encode(words, num_threads=1))), held)


#: The settings under which a run of these characters is one unit of a word-end BPE file (see ``word_encoder``).
_FOLDING = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
_UNITS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_LETTERS, _SIGNS = "A-Za-zÀ-ÖØ-öø-ÿ", r"!-&(-/:-@\[-`{-~"
_PLAIN, _RUNS = re.compile(f"[{_LETTERS}{_SIGNS}]+"), re.compile(f"[{_LETTERS}]+|[{_SIGNS}]+")


def word_encoder(data: bytes) -> WordEncoder:
    """A BPE file that lower-cases words and marks their ends; texts are UTF-8 bytes.

    Under the settings above, a word of Latin letters and ASCII signs (no digit, no apostrophe) falls into units at each change between
    letters and signs, so its runs go to the BPE model directly and are kept; all other words, and files with other settings,
    take the whole way. "<|" may begin a special token, so words with it do too."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tokenizer = Tokenizer.from_buffer(data)
    settings = json.loads(data)
    cutter = (settings.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
    direct = settings.get("normalizer") == _FOLDING and cutter[0].get("pattern") == {"Regex": _UNITS} \
        and [c.get("type") for c in cutter] == ["Split", "ByteLevel"] and not settings["model"].get("dropout") \
        and all(t["content"].startswith("<|") for t in settings.get("added_tokens") or ())
    byte_level = {ord(c): "".join(chr(b) if b >= 0xA1 and b != 0xAD else chr(0x100 + 33 + b - 0x7F) if b < 0xA1 else chr(0x143)
                                  for b in c.encode()) for c in map(chr, range(0xC0, 0x100))}
    runs: dict[str, bytes] = {}

    model = tokenizer.model

    def ids_of(run: str) -> bytes:
        runs[run] = got = packed([t.id for t in model.tokenize(run if run.isascii() else run.translate(byte_level))])
        return got

    def encode(chunks: list[bytes]) -> list[bytes]:
        if len(runs) > HELD_CHUNKS:
            runs.clear()
        out, other, known = [], [], runs.get
        for chunk in chunks:
            word = chunk.decode()
            if not direct or "<|" in word or not _PLAIN.fullmatch(word):
                other.append((len(out), word))
                out.append(b"")
            elif word.isalpha():
                out.append(known(run := word.lower()) or ids_of(run))
            else:
                out.append(b"".join([known(run) or ids_of(run) for run in _RUNS.findall(word.lower())]))
        for at in range(0, len(other), 4096):
            part = other[at:at + 4096]
            for (k, _), got in zip(part, tokenizer.encode_batch_fast([w for _, w in part], add_special_tokens=False), strict=True):
                out[k] = packed(got.ids)
        return out

    return WordEncoder(bytes.split, encode)


ship_by_value(__name__)
