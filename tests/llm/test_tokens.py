"""Token files, token counts and packing against the tokenizers library itself."""

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from airlens.llm import packing, subwords, token_counts, token_files
from airlens.llm.queries import tokenizer
from airlens.llm.subwords import Subwords

WORD, BYTE = tokenizer("word_bpe_49k.json"), tokenizer("byte_bpe_50k.json")


def ids_of(path, texts, end=None):
    t = Tokenizer.from_file(path)
    return [t.encode(x or "", add_special_tokens=False).ids + ([end] if end is not None else []) for x in texts]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_words_encode_like_whole_texts(path, rows):
    rnd = random.Random(3)
    texts = [t or "" for _, t in rows] + ["".join(rnd.choice("ab É'1.\n \t<|é \x1f\0\x85") for _ in range(rnd.randint(0, 30)))
                                          for _ in range(1500)]
    sub = Subwords(path, limit=50)      # the tables are emptied now and then
    assert sub.kind in ("word", "byte")
    for at in range(0, len(texts), 100):
        some = texts[at:at + 100]
        ids, counts = sub.encode(some)
        ends = np.cumsum(counts)
        assert [ids[e - n:e].tolist() for e, n in zip(ends, counts)] == ids_of(path, some)
        assert sub.count(some).tolist() == counts.tolist()


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_many_words_at_once(path, rows):
    words = list({w for _, t in rows for w in (t or "").split()}) + ["a'b", "<|endoftext|>x", "é", "12ab", "x" * 300, "...", "e\u0301"]
    sub = Subwords(path)
    ids, counts = sub.encode_words(words)
    ends = np.cumsum(counts)
    assert [ids[e - n:e].tolist() for e, n in zip(ends, counts)] == ids_of(path, words)
    assert sub.encode_words([])[1].tolist() == []


def test_plain_words_are_told_apart_in_one_go(monkeypatch):
    """Words of a chunk get no regular expression each."""
    words = ["plain", "né", "a-b", "odd\u4e00", "x<|endoftext|>y", "<|endoftext|><|endoftext|>", "last."]
    sub = Subwords(WORD)
    sub._special = ["<|endoftext|>"]
    assert sub._plain_lines("\n".join([*words, ""]), len(words)).tolist() == [True, True, True, False, False, False, True]
    monkeypatch.setattr(subwords, "_PLAIN", None)       # the test of a single text
    ids, counts = sub.encode_words(["plain", "words", "a-b", "12"])
    assert ids.tolist() == [i for x in ids_of(WORD, ["plain", "words", "a-b", "12"]) for i in x] and len(counts) == 4


def test_token_files(spark, docs, rows, tmp_path):
    out = str(tmp_path / "files")
    token_files.write_tokens(docs, out, WORD, end_id=1)
    got = token_files.read_documents(spark, out, ids=True).collect()
    want = sorted(((d is not None, d or 0), x) for (d, _), x in zip(rows, ids_of(WORD, [t for _, t in rows], 1)))
    got.sort(key=lambda r: r.start)
    assert [(r.doc_id is not None, r.doc_id or 0) for r in got] == [k for k, _ in want]
    assert sorted(((r.doc_id is not None, r.doc_id or 0), r.ids) for r in got) == want
    assert [r.start for r in got] == np.cumsum([0] + [r.n_tokens for r in got])[:-1].tolist()
    assert all(r.ids_crc32 == crc(r.ids) and r.n_tokens == len(r.ids) for r in got)


def test_token_files_of_no_documents(spark, no_docs, tmp_path):
    out = str(tmp_path / "files")
    token_files.write_tokens(no_docs, out, WORD, end_id=1)
    assert token_files.read_documents(spark, out).count() == 0


@pytest.mark.parametrize("counts", [[0, 5], [1, 1, 1], list(range(300)), [2 ** k for k in range(40)]])
def test_code_lengths(counts):
    n = np.array(counts)
    lengths = token_files.code_lengths(n, 9)
    assert (lengths[n > 0] > 0).all() and (lengths[n == 0] == 0).all() and lengths.max() <= 9
    assert sum(2.0 ** -int(x) for x in lengths if x) <= 1
    # at least as short as codes of one length for all
    assert (n * lengths).sum() <= n.sum() * max(1, int((n > 0).sum() - 1).bit_length())


def test_unlimited_lengths_are_huffman():
    import heapq
    n = np.random.default_rng(4).integers(1, 1000, 200)
    heap, cost = n.tolist(), 0
    heapq.heapify(heap)
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        cost += both
        heapq.heappush(heap, both)
    assert (n * token_files.code_lengths(n, 30)).sum() == cost


@pytest.mark.parametrize("n", [0, 1, 127, 128, 129, 5000])
def test_block_round_trip(n):
    r = np.random.default_rng(n)
    ids = np.minimum(r.zipf(1.4, n), 999).astype(np.uint16)
    lengths = token_files.code_lengths(np.bincount(ids, minlength=1000) + 1)
    docs = np.array([(7, 1, n)], token_files._DOC).tobytes()
    blob = token_files.encode_block(ids, docs, token_files.canonical_codes(lengths), lengths)
    got, found = token_files.decode_block(blob, *token_files.decode_table(lengths))
    assert (got == ids).all() and found["doc"].tolist() == [7]


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_chunks_splice_to_the_whole(path):
    rnd = random.Random(6)
    short, spans = token_counts._open(path)
    texts = ["x" * 3000, "ab " * 2000, " " * 3000, "é<|endoftext|>" * 300, "a\n" * 2000, "b  \n c" * 700,
             "".join(rnd.choice("ab 1.\n'é") for _ in range(5000)), "a" * 1500 + " b c d e f " + "q" * 2500]
    for text in texts:
        for chunk, overlap in ((300, 16), (700, 64)):
            assert token_counts.count_in_chunks(text, spans, chunk, overlap) == len(ids_of(path, [text])[0])


def test_disagreeing_chunks_widen_until_they_agree():
    """An encoder that depends on its first characters: only whole texts count right."""
    calls = []

    def spans(text):
        calls.append(len(text))
        size = 2 if text.startswith("a") else 3
        at = np.arange(0, len(text), size)
        return at * 0 + size, at, np.minimum(at + size, len(text))

    text = "a" + "b c " * 200
    assert token_counts.count_in_chunks(text, spans, 100, 10) == -(-len(text) // 2)
    assert max(calls) == len(text)


def test_token_counts(docs, rows):
    got = sorted((tuple(r) for r in token_counts.token_counts(docs, WORD, limit=100, huge=2000).collect()), key=str)
    want = [(d, len((t or "").encode()), len(x), len(x) > 100) for (d, t), x in zip(rows, ids_of(WORD, [t for _, t in rows]))]
    assert got == sorted(want, key=str)


def test_sentencepiece_counts(docs, rows):
    import sentencepiece
    model = tokenizer("piece_bpe_32k.model")
    p = sentencepiece.SentencePieceProcessor(model_file=model)
    got = sorted((str(r.doc_id), r.n_tokens) for r in token_counts.token_counts(docs, model).collect())
    assert got == sorted((str(d), len(p.encode(t or ""))) for d, t in rows)


def test_no_token_counts(no_docs):
    assert token_counts.token_counts(no_docs, WORD).count() == 0


def test_packing(docs, rows):
    size = 64
    got = packing.pack_documents(docs, BYTE, end_id=2, size=size).collect()
    pieces = []
    for (d, _), ids in zip(rows, ids_of(BYTE, [t for _, t in rows], 2)):
        head = len(ids) % size or size
        cuts = [0, *range(head, len(ids) + 1, size)]
        pieces += [(d, k, a, b - a, crc(ids[a:b])) for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:]))]
    assert sorted((tuple(r)[:5] for r in got), key=str) == sorted(pieces, key=str)
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    assert len(sequences) <= 1.1 * -(-sum(p[3] for p in pieces) // size) + 1


def test_packing_nothing(no_docs):
    assert packing.pack_documents(no_docs, BYTE, end_id=2).count() == 0


def test_best_fit_takes_the_tightest_bin_and_closes_the_fullest():
    b = packing.BestFit(10, open_bins=2)
    assert [b.place(n) for n in (6, 7)] == [(0, 0), (1, 0)]
    assert b.place(3) == (1, 7)                 # exactly full: closes
    assert b.place(5) == (2, 0)
    assert b.place(9) == (3, 0)                 # two are open: the fullest, bin 0, closes
    assert b.place(4) == (2, 5)
