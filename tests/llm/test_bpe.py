"""BPE by speculation: the library's ids and texts, and plain merging over vocabularies made at random."""

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from airlens.llm import bpe
from airlens.llm.queries import op11_bpe_round_trip, table, tokenizer
from tests.conftest import SF_SMALL
from tests.llm.conftest import prose

WORD, BYTE = "word_bpe_49k.json", "byte_bpe_50k.json"


def library(name):
    from tokenizers import Tokenizer
    return Tokenizer.from_file(tokenizer(name))


def naive(vocab, merges, word, suffix):
    """BPE by its definition: join the leftmost pair of the lowest rank until none is left."""
    rank = {tuple(m): k for k, m in enumerate(merges)}
    shown = {b: c for c, b in bpe.byte_letters().items()}
    parts = [shown[b] for b in word]
    parts[-1] += suffix
    while True:
        best = min(((rank[p], i) for i, p in enumerate(zip(parts, parts[1:])) if p in rank), default=None)
        if best is None:
            return [vocab[p] for p in parts]
        i = best[1]
        parts[i:i + 2] = [parts[i] + parts[i + 1]]


def made(rnd, n, suffix, letters="abc", ordered=True):
    """A vocabulary of the 256 letters and n merges of parts made before (or, not ordered, of any)."""
    known = [c for c in letters] + ([c + suffix for c in letters] if suffix else [])
    merges = []
    while len(merges) < n:
        a, b = rnd.choice(known), rnd.choice(known)
        if (suffix and a.endswith(suffix)) or [a, b] in merges or (ordered and a + b in known):
            continue
        merges.append([a, b])
        known.append(a + b)
    if not ordered:
        rnd.shuffle(merges)
    names = dict.fromkeys([*bpe.byte_letters(), *[c + suffix for c in bpe.byte_letters()], *[a + b for a, b in merges]])
    return {t: i for i, t in enumerate(names)}, merges


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(0, 40), st.sampled_from(["", "</w>"]), st.booleans())
def test_equals_plain_merging(seed, n, suffix, ordered):
    rnd = random.Random(seed)
    vocab, merges = made(rnd, n, suffix, ordered=ordered)
    v = bpe.Vocabulary(vocab, merges, suffix)
    words = [bytes(rnd.choice(b"abc") for _ in range(rnd.choice([1, 2, 3, 5, 9, 20, 90]))) for _ in range(40)] + [b"a" * 70, b"ab" * 50]
    ids, counts = v.encode_words(words)
    ends = np.append(0, np.cumsum(counts))
    assert [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:])] == [naive(vocab, merges, w, suffix) for w in words]


def test_only_failing_words_are_merged(monkeypatch):
    # "abc" is no token: the longest match takes ab, while the merge of bc comes first
    merges = [["b", "c"], ["a", "b"], ["bc", "a"], ["ab", "ab"], ["a", "c</w>"], ["c", "ab"]]
    names = [*bpe.byte_letters(), *[c + "</w>" for c in bpe.byte_letters()], *[a + b for a, b in merges]]
    vocab = {t: i for i, t in enumerate(names)}
    v = bpe.Vocabulary(vocab, merges, "</w>")
    assert v.proven
    rnd = random.Random(3)
    words = [bytes(rnd.choice(b"abc") for _ in range(8)) for _ in range(300)]
    bounds = np.arange(0, 8 * 300 + 1, 8)
    symbols = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
    symbols[7::8] += 256
    tokens, counts = v.speculate(symbols, bounds)
    ends = np.append(0, np.cumsum(counts))
    wrong = {k for k, w in enumerate(words) if tokens[ends[k]:ends[k + 1]].tolist() != naive(vocab, merges, w, "</w>")}
    assert wrong and set(v.failing(tokens, counts).tolist()) == wrong
    merged, exact = [], v.merged
    monkeypatch.setattr(v, "merged", lambda s: merged.append(1) or exact(s))
    v.encode_words(words)
    assert len(merged) == len(wrong)


def test_unordered_merges_are_not_proven():
    vocab, merges = made(random.Random(1), 20, "")
    assert bpe.Vocabulary(vocab, merges).proven
    assert not bpe.Vocabulary(vocab, merges[::-1]).proven


ODD = ["", "a" * 5000, "ab" * 3000, "'s it's we'LL I'd <|endoftext|>a<|startoftext|>b <|endoftext", "é é İ ß ſ ŉ　全角 漢字かな 😀‍😀",
       "​﻿ a b\x1c\x85c\0d", "１２ ½ ⅷ 12345 a1b2", "e<|endoftext|>́", "ΑΣ Σ ς", " \t\n\x0b\x0c\r ", "日本語" * 3000]


@pytest.mark.parametrize("name", [WORD, BYTE])
def test_equals_library(name):
    rnd = random.Random(11)
    texts = ODD + [prose(rnd, 30) for _ in range(10)]
    texts += ["".join(chr(rnd.choice([rnd.randint(0, 0x17f), rnd.randint(0x180, 0xd7ff), rnd.randint(0x10000, 0x1ffff)])) for _ in range(200))
              for _ in range(40)]
    texts += [" ".join("".join(rnd.choice("etaoinsrhldcumw-.,'") for _ in range(rnd.randint(1, 25))) for _ in range(50)) for _ in range(20)]
    ids, bounds = bpe.open_bpe(tokenizer(name)).encode(texts)
    t = library(name)
    want = [t.encode(x, add_special_tokens=False).ids for x in texts]
    assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])] == want
    assert bpe.open_bpe(tokenizer(name)).decode(ids, bounds).to_pylist() == [t.decode(w, skip_special_tokens=False) for w in want]


def test_forgets_words(monkeypatch):
    monkeypatch.setattr(bpe, "LIMIT", 5)
    coder, t = bpe.Bpe(tokenizer(WORD)), library(WORD)
    for text in ("one two three four five six seven", "one eight nine", "<|endoftext|> one"):
        ids, _ = coder.encode([text])
        assert ids.tolist() == t.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("name", ["piece_bpe_32k.model"])
def test_other_files_are_refused(name):
    with pytest.raises(ValueError):
        bpe.Bpe(tokenizer(name))


def test_unknown_ids_are_left_out():
    coder = bpe.open_bpe(tokenizer(WORD))
    ids, bounds = coder.encode(["hello world"])
    some = np.concatenate([[10**6], ids.astype(np.int64), [-5]])
    assert coder.decode(some, np.array([0, len(some), len(some)])).to_pylist() == ["hello</w> world</w>", ""]


def test_rows(spark, docs, rows, no_docs):
    path, t = tokenizer(WORD), library(WORD)
    got = bpe.decode_ids(bpe.encode_texts(docs, path), path).collect()
    want = []
    for i, text in rows:
        ids = t.encode(text or "", add_special_tokens=False).ids
        want.append((i, ids, t.decode(ids, skip_special_tokens=False)))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert bpe.decode_ids(bpe.encode_texts(no_docs, path), path).count() == 0


def test_null_ids_decode_to_nothing(spark):
    coded = spark.createDataFrame([(1, None), (2, []), (3, [320, None])], "k long, ids array<int>")
    t = library(WORD)
    got = dict((r.k, r.decoded) for r in bpe.decode_ids(coded, tokenizer(WORD)).collect())
    assert got == {1: "", 2: "", 3: t.decode([320], skip_special_tokens=False)}


def test_query_digests(spark):
    t = library(WORD)
    got = {r.doc_id: r for r in op11_bpe_round_trip(spark, SF_SMALL).collect()}
    said = table(spark, SF_SMALL, "documents").select("doc_id", "text").collect()
    assert len(got) == len(said)
    for r in said:
        ids = t.encode(r.text or "", add_special_tokens=False).ids
        shown = t.decode(ids, skip_special_tokens=False)
        assert tuple(got[r.doc_id])[1:] == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                                            hashlib.sha256(shown.encode()).hexdigest())
