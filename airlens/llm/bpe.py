"""BPE encoding by speculation, and decoding, for byte-level vocabularies with or without a word end.

A sequence of tokens is the BPE encoding of a word exactly if each of its tokens
is the encoding of its own letters and no merge would ever have joined two
neighbours across their border. So a word is encoded in three steps:

1. *Speculate*: from its start on, always take the longest token that fits. Only
   tokens that encode to themselves are offered. All positions of all distinct
   words of a batch walk down one prefix tree together.
2. *Verify*: all distinct pairs of neighbours are tested at once (``compatible``).
   Undoing the merges of both tokens from the last one back gives every pair of
   pieces that stood at the border at the same time; the pair fails if a merge of
   such a piece pair comes before the merge that consumes one of the pieces.
3. Words with a failing pair, and only they, are merged exactly, the lowest rank
   first and of equal ranks the leftmost.

The test needs merges whose parts are letters or made by earlier merges, and one
merge for each token. For other vocabularies every word is merged exactly.

Texts are cut into pieces as the tokenizer file says: for the ``word`` pipeline of
``subwords``, texts of Latin letters, digits and marks by one expression, all others
word by word, through the library's normalizer and pre-tokenizer. Strings of special tokens
in a text become their ids, as the library does by default.

A null text is empty: no ids, and decodes to an empty text. Repeated rows come back once each, a
null id stays null, other columns are ignored. Texts are handled in runs of 512 KB and known words are
forgotten beyond ``LIMIT`` words or 32 MB, so memory is bounded by the longest text.
"""

from __future__ import annotations

import heapq
import json
import re
from array import array
from functools import cached_property
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airlens.llm.shared import columns, document_runs, map_arrow
from airlens.llm.subwords import pipeline_kind

NEVER = np.int64(1) << 60
LIMIT, LIMIT_BYTES = 400_000, 32 << 20
LONG_WORD = 64          # symbols from which a word is walked by itself

_LETTERS = "A-Za-zÀ-ÖØ-öø-įı-ſ"           # Latin letters that NFC leaves alone and that lower-case one to one
_MARKS = "!-&(-/:-@\\[-`{-~"                # ASCII marks without the apostrophe
_PLAIN = re.compile(f"[{_LETTERS}{_MARKS}0-9\\t-\\r ]*")
_PLAIN_PIECE = re.compile(f"[{_LETTERS}]+|[0-9]|[{_MARKS}]+")


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = sorted(set(range(256)) - set(shown))
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def slices(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of each slice, one slice after another."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)


class Vocabulary:
    """Merges and prefix tree over symbols: a byte, or 256 + byte for the last byte of a word with a word end."""

    def __init__(self, vocab: dict[str, int], merges: list, suffix: str = ""):
        letters = byte_letters()
        self.last = 256 if suffix else 0
        self.size = max(vocab.values()) + 1
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        self.base = np.full(512, -1, np.int64)
        for letter, byte in letters.items():
            self.base[byte] = vocab[letter]
            self.base[256 + byte] = vocab[letter + suffix]
        left, right, new = (np.array([vocab[f(a, b)] for a, b in pairs], np.int64)
                            for f in (lambda a, b: a, lambda a, b: b, lambda a, b: a + b))
        key = left * self.size + right
        order = np.argsort(key, kind="stable")
        self.keys, self.ranks, self.new = np.append(key[order], NEVER), np.append(order, NEVER), new
        self.born = np.full(self.size, -1, np.int64)
        self.left, self.right = np.zeros((2, self.size), np.int64)
        self.born[new], self.left[new], self.right[new] = np.arange(len(new)), left, right
        made = np.full(self.size, NEVER)
        made[self.base[self.base >= 0]] = -1
        made[new] = np.arange(len(new))
        number = np.arange(len(new))
        self.proven = bool(len(np.unique(new)) == len(new) and len(np.unique(key)) == len(key)
                           and not np.isin(new, self.base).any() and (made[left] < number).all() and (made[right] < number).all())
        if self.proven:
            self._plant(left, right, new)

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the merge of a and b, NEVER if there is none."""
        key = a * self.size + b
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.ranks[at], NEVER)

    def compatible(self, a: np.ndarray, b: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
        """Whether no merge (with a rank under ``before``) crosses the border between the tokens a and b."""
        ok = np.ones(len(a), bool)
        p, q, at = a.copy(), b.copy(), np.arange(len(a))
        p_end = np.full(len(a), NEVER) if before is None else before.copy()
        q_end = p_end.copy()
        while len(at):
            r = self.rank(p, q)
            # of equal ranks the leftmost merge comes first: it takes p from the right, but not q from the left
            clash = (r < p_end) & (r <= q_end)
            ok[at[clash]] = False
            p_born, q_born = self.born[p], self.born[q]
            go = np.flatnonzero(~clash & ((p_born >= 0) | (q_born >= 0)))
            p, q, p_end, q_end, p_born, q_born, at = (x[go] for x in (p, q, p_end, q_end, p_born, q_born, at))
            undo_q = q_born >= p_born
            p_end, q_end = np.where(undo_q, p_end, p_born), np.where(undo_q, q_born, q_end)
            p, q = np.where(undo_q, p, self.right[p]), np.where(undo_q, self.left[q], q)
        return ok

    def _plant(self, left: np.ndarray, right: np.ndarray, new: np.ndarray) -> None:
        """The prefix tree of the tokens that encode to themselves, as sorted (node, symbol) keys."""
        depth = np.zeros(self.size, np.int64)
        for k in range(len(new)):
            depth[new[k]] = 1 + max(depth[left[k]], depth[right[k]])
        whole = np.zeros(self.size, bool)
        whole[self.base] = True
        for level in range(1, int(depth.max(initial=0)) + 1):
            k = np.flatnonzero(depth[new] == level)
            k = k[whole[left[k]] & whole[right[k]]]
            whole[new[k[self.compatible(left[k], right[k], k)]]] = True
        spelled = {int(i): (s,) for s, i in enumerate(self.base) if s < 256 + self.last}
        for a, b, c in zip(left.tolist(), right.tolist(), new.tolist()):
            spelled[c] = spelled[a] + spelled[b]
        child, token = {}, [-1]
        for i, symbols in spelled.items():
            if whole[i]:
                node = 0
                for s in symbols:
                    node = child.setdefault(node << 9 | s, len(token))
                    if node == len(token):
                        token.append(-1)
                token[node] = i
        keys = np.fromiter(child, np.int64, len(child))
        order = np.argsort(keys)
        self.edges = np.append(keys[order], NEVER)
        self.child = np.append(np.fromiter(child.values(), np.int64, len(child))[order], 0)
        self.token = np.array(token, np.int64)

    def longest(self, symbols: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The longest token from each symbol on, and its length; it stops at the end of the symbol's word."""
        token, size = self.base[symbols], np.ones(len(symbols), np.int64)
        at, node, k = np.arange(len(symbols)), np.zeros(len(symbols), np.int64), 0
        while len(at):
            key = node << 9 | symbols[at + k]
            place = np.searchsorted(self.edges, key)
            go = self.edges[place] == key
            at, node = at[go], self.child[place[go]]
            k += 1
            found = self.token[node]
            some = found >= 0
            token[at[some]], size[at[some]] = found[some], k
            go = at + k < ends[at]
            at, node = at[go], node[go]
        return token, size

    def speculate(self, symbols: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(tokens of greedy longest match, one word after another; number of tokens of each word)."""
        sizes = np.diff(bounds)
        token, size = self.longest(symbols, np.repeat(bounds[1:], sizes))
        words, found = [], []
        for w in np.flatnonzero(sizes > LONG_WORD).tolist():
            steps, at, end, path = size[bounds[w]:bounds[w + 1]].tolist(), 0, int(sizes[w]), []
            while at < end:
                path.append(at)
                at += steps[at]
            found.append(token[bounds[w] + np.array(path)])
            words.append(np.full(len(path), w))
        word = np.flatnonzero((sizes > 0) & (sizes <= LONG_WORD))
        at = bounds[word]
        while len(at):
            words.append(word)
            found.append(token[at])
            at = at + size[at]
            go = at < bounds[word + 1]
            at, word = at[go], word[go]
        if not words:
            return np.empty(0, np.int64), np.zeros(len(sizes), np.int64)
        words = np.concatenate(words)
        return np.concatenate(found)[np.argsort(words, kind="stable")], np.bincount(words, minlength=len(sizes))

    def failing(self, tokens: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The words that have a pair of neighbours that BPE would not have left side by side."""
        word = np.repeat(np.arange(len(counts)), counts)
        inner = np.flatnonzero(word[1:] == word[:-1])
        pairs, of = np.unique(tokens[inner] * self.size + tokens[inner + 1], return_inverse=True)
        ok = self.compatible(pairs // self.size, pairs % self.size)
        return np.unique(word[inner[~ok[of]]])

    def merged(self, symbols: np.ndarray) -> list[int]:
        """Exact BPE of one word: the lowest rank first, of equal ranks the leftmost."""
        ids = self.base[symbols].tolist()
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        known = self._known

        def rank_of(a: int, b: int) -> int | None:
            return known.get(a * self.size + b)

        heap = [(r, i, ids[i], ids[i + 1]) for i in range(len(ids) - 1) if (r := rank_of(ids[i], ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= len(ids) or ids[j] != b:
                continue          # a part has been merged since
            ids[i], ids[j], after[i] = int(self.new[r]), -1, after[j]
            if after[j] < len(ids):
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < len(ids) and (r := rank_of(ids[x], ids[y])) is not None:
                    heapq.heappush(heap, (r, x, ids[x], ids[y]))
        return [i for i in ids if i >= 0]

    @cached_property
    def _known(self) -> dict[int, int]:
        return dict(zip(self.keys[:-1].tolist(), self.ranks[:-1].tolist()))

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, one after another; number of ids of each word)."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        bounds = np.append(0, np.cumsum(sizes))
        symbols = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        symbols[bounds[1:][sizes > 0] - 1] += self.last
        if self.proven:
            tokens, counts = self.speculate(symbols, bounds)
            wrong = self.failing(tokens, counts)
        else:
            tokens, counts, wrong = np.empty(0, np.int64), np.zeros(len(words), np.int64), np.arange(len(words))
        if not len(wrong):
            return tokens, counts
        exact = [self.merged(symbols[bounds[w]:bounds[w + 1]]) for w in wrong.tolist()]
        right = np.ones(len(words), bool)
        right[wrong] = False
        kept = tokens[np.repeat(right, counts)]
        counts[wrong] = [len(x) for x in exact]
        out = np.empty(int(counts.sum()), np.int64)
        mine = np.repeat(right, counts)
        out[mine], out[~mine] = kept, np.array([i for x in exact for i in x], np.int64)
        return out, counts


class Bpe:
    """Encoder and decoder of a tokenizer file with a byte-level BPE model."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as fh:
            spec = json.load(fh)
        model = spec["model"]
        levels = [p["type"] for p in (spec.get("pre_tokenizer") or {}).get("pretokenizers", [spec.get("pre_tokenizer") or {}]) if p]
        if model.get("type") != "BPE" or model.get("dropout") or model.get("continuing_subword_prefix") or levels[-1:] != ["ByteLevel"] \
                or model.get("ignore_merges"):
            raise ValueError(f"{path}: not a byte-level BPE tokenizer")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in spec.get("added_tokens", [])):
            raise ValueError(f"{path}: added tokens that take white space or match normalized text")
        self.words = pipeline_kind(spec) == "word"
        self.vocabulary = Vocabulary(model["vocab"], model["merges"], model.get("end_of_word_suffix") or "")
        library = Tokenizer.from_file(path)
        self._normalizer, self._pre_tokenizer = library.normalizer, library.pre_tokenizer
        self._letters = {ord(c): chr(b) for c, b in byte_letters().items()}
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        # the longest of the strings that begin at one place
        self._special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self._shown(model["vocab"], spec.get("decoder") or {})
        self._forget()

    def _shown(self, vocab: dict[str, int], decoder: dict) -> None:
        """What each id decodes to: its string and a space, or with a byte-level decoder its bytes."""
        if decoder and decoder.get("type") != "ByteLevel":
            raise ValueError("only byte-level decoders, or none")
        self.spaced = not decoder
        shown = {i: t.encode() + b" " if self.spaced else t.translate(self._letters).encode("latin-1") for t, i in vocab.items()}
        shown |= {i: t.encode() + (b" " if self.spaced else b"") for t, i in self.special.items()}
        self._size = np.zeros(max(shown) + 1, np.int64)
        for i, t in shown.items():
            self._size[i] = len(t)
        self._start = np.append(0, np.cumsum(self._size)[:-1])
        self._bytes = np.frombuffer(b"".join(shown.get(i, b"") for i in range(len(self._size))), np.uint8)

    def _forget(self) -> None:
        self._known: dict = {i: k for k, i in enumerate(self.special.values())}
        self._ids, self._bounds, self._held = array("I", self.special.values()), array("q", range(len(self.special) + 1)), 0

    def _split(self, text: str) -> list:
        """Keys of a text: a piece (str), a word still to be normalized (bytes), or the id of a special token."""
        keys = []
        for k, part in enumerate(self._special.split(text) if self._special else [text]):
            if k % 2:
                keys.append(self.special[part])
            elif self.words and _PLAIN.fullmatch(part):
                keys += _PLAIN_PIECE.findall(part.lower())
            elif part:
                # no token crosses ASCII white space in the word pipeline; other pipelines get the whole text
                keys += part.encode().split() if self.words else [part.encode()]
        return keys

    def _pieces(self, key: str | bytes) -> list[bytes]:
        if isinstance(key, str):
            return [key.encode()]
        text = key.decode()
        text = self._normalizer.normalize_str(text) if self._normalizer is not None else text
        return [p.translate(self._letters).encode("latin-1") for p, _ in self._pre_tokenizer.pre_tokenize_str(text)]

    def _learn(self, keys: list) -> None:
        cut = [self._pieces(k) for k in keys]
        words = list(dict.fromkeys(p for pieces in cut for p in pieces))
        ids, counts = self.vocabulary.encode_words(words)
        at = {w: i for i, w in enumerate(words)}
        starts = np.append(0, np.cumsum(counts))
        used = np.fromiter((at[p] for pieces in cut for p in pieces), np.int64)
        self._ids.frombytes(ids[slices(starts[used], counts[used])].astype(np.uint32).tobytes())
        per_key = np.add.reduceat(np.append(counts[used], 0), np.append(0, np.cumsum([len(c) for c in cut]))[:-1]) if len(used) else []
        end = self._bounds[-1]
        for key, pieces, n in zip(keys, cut, per_key):
            end += int(n) if pieces else 0
            self._known[key] = len(self._bounds) - 1
            self._bounds.append(end)
            self._held += len(key)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, one after another; bounds of each text's ids)."""
        if len(self._known) > LIMIT or self._held > LIMIT_BYTES:
            self._forget()
        keys, ends = [], np.zeros(len(texts) + 1, np.int64)
        for i, text in enumerate(texts):
            keys += self._split(text)
            ends[i + 1] = len(keys)
        place = np.fromiter(map(self._known.get, keys, repeat(-1)), np.int64, len(keys))
        if len(unknown := np.flatnonzero(place < 0)):
            self._learn(list(dict.fromkeys(keys[k] for k in unknown.tolist())))
            place[unknown] = [self._known[keys[k]] for k in unknown.tolist()]
        bounds = np.frombuffer(self._bounds, np.int64)     # a view: gone before the store grows again
        sizes = np.diff(bounds)[place] if len(place) else place
        found = np.frombuffer(self._ids, np.uint32)[slices(bounds[place], sizes)] if len(place) else np.empty(0, np.uint32)
        return found, np.append(0, np.cumsum(sizes))[ends]

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> pa.Array:
        """Text of each slice of ids; unknown ids are left out."""
        ids = ids.astype(np.int64)
        safe = np.where((ids >= 0) & (ids < len(self._size)), ids, 0)
        sizes = np.where(safe == ids, self._size[safe], 0)
        shown = self._bytes[slices(self._start[safe], sizes)]
        off = np.append(0, np.cumsum(sizes))[bounds]
        if not self.spaced:
            return pa.array([shown[a:b].tobytes().decode(errors="replace") for a, b in zip(off[:-1], off[1:])], pa.string())
        some = off[1:] > off[:-1]                     # without the space after the last token
        keep = np.ones(len(shown), bool)
        keep[off[1:][some] - 1] = False
        off = off - np.append(0, np.cumsum(some))
        return pa.StringArray.from_buffers(len(off) - 1, pa.py_buffer(off.astype(np.int32)), pa.py_buffer(shown[keep]))


_open: dict[str, Bpe] = {}


def open_bpe(path: str) -> Bpe:
    """One encoder per worker process and file, so words stay known from batch to batch."""
    if path not in _open:
        _open[path] = Bpe(path)
    return _open[path]


def _encode(path: str):
    def run(batches):
        bpe = open_bpe(path)
        for batch in batches:
            size = batch.column(2).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for i, j in document_runs(np.append(0, np.cumsum(size))):
                ids, bounds = bpe.encode([t or "" for t in batch.column(1).slice(i, j - i).to_pylist()])
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_pydict({"doc": batch.column(0).slice(i, j - i), "ids": lists})
    return run


def _decode(path: str, at: int):
    def run(batches):
        bpe = open_bpe(path)
        for batch in batches:
            lists = batch.column(at)
            sizes = np.array(lists.value_lengths().fill_null(0), np.int64)
            for i, j in document_runs(np.append(0, np.cumsum(4 * sizes))):
                ids = lists.slice(i, j - i).flatten().fill_null(-1).to_numpy(zero_copy_only=False)
                text = bpe.decode(ids, np.append(0, np.cumsum(sizes[i:j])))
                yield pa.RecordBatch.from_arrays([*[c.slice(i, j - i) for c in batch.columns], text], [*batch.schema.names, "decoded"])
    return run


def encode_texts(docs: DataFrame, tokenizer: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: ``id``, ids (array of int), as the library gives them without special tokens around the text."""
    kind = docs.schema[id].dataType.simpleString()
    rows = columns(docs, id, text).select(F.col(f"`{id}`").alias("doc"), F.col(f"`{text}`").alias("text"),
                                          F.octet_length(F.col(f"`{text}`")).alias("size"))
    return map_arrow(rows, _encode(tokenizer), f"doc {kind}, ids array<int>").withColumnRenamed("doc", id)


def decode_ids(coded: DataFrame, tokenizer: str, ids: str = "ids") -> DataFrame:
    """``coded`` with the column decoded: the text of the ids, special tokens shown, null or unknown ids left out."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in coded.schema.fields) + ", decoded string"
    return map_arrow(coded, _decode(tokenizer, coded.columns.index(ids)), schema)
