"""Subword ids of many texts with the tokenizers library, each distinct word encoded once per worker.

For two known pipelines the ids of a text are the ids of its words one after
another, because no token crosses the cut between them:

* ``word``: NFC, white space to one space, lower case, then a split that drops
  white space. A cut at any ASCII white space is safe.
* ``byte``: byte-level pieces, where a piece may take one leading space. A cut
  before a space or line feed is safe when the character before it is no white space.

In texts of Latin letters, digits, ASCII marks and single spaces or line feeds, words are
cut further, into the pieces of the pipeline's own split. Pieces and words are
looked up in a table that the worker fills by need; other pipelines encode whole
texts. The table is emptied beyond ``LIMIT`` entries, so memory is bounded.
"""

from __future__ import annotations

import json
import re
from array import array

import numpy as np

LIMIT = 500_000

# The parts of a tokenizer file for which the cuts above are proven.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_LETTERS = "A-Za-zÀ-ÖØ-öø-įı-ſ"
_MARKS = "!-&(-/:-@\\[-`{-~"   # ASCII punctuation without the apostrophe of contractions
_PLAIN = re.compile(f"[{_LETTERS}{_MARKS}0-9 \n]*")
_OTHERS = re.compile(f"[^{_LETTERS}{_MARKS}0-9 \n]+")
_PIECES = {"word": re.compile(f"[{_LETTERS}]+|[0-9]|[{_MARKS}]+"),
           "byte": re.compile(f" ?[{_LETTERS}]+| ?[0-9]+| ?[{_MARKS}]+|\n")}
_LINES = re.compile(_PIECES["word"].pattern + "|\n")
_BREAK = 1 << 60      # the place of a line feed between words: no ids
_ODD_SPACE = re.compile("[\\s\u180e\u200b\ufeff][ \n]")
_SAFE_CUT = re.compile("(?<=[^\\s\u180e\u200b\ufeff])(?=[ \n])")


def pipeline_kind(spec: dict) -> str:
    """``word``, ``byte`` or ``other``, from the parsed tokenizer file."""
    pre, norm = spec.get("pre_tokenizer") or {}, spec.get("normalizer") or {}
    if spec["model"].get("type") != "BPE" or spec["model"].get("dropout") or spec.get("truncation"):
        return "other"
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] or re.search(r"\s", t["content"])
           for t in spec.get("added_tokens", [])):
        return "other"
    if not norm and pre.get("type") == "ByteLevel" and pre["use_regex"] and not pre["add_prefix_space"]:
        return "byte"
    parts = pre.get("pretokenizers", [])
    if ([n["type"] for n in norm.get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]
            and norm["normalizers"][1]["pattern"] == {"Regex": "\\s+"}
            and [p["type"] for p in parts] == ["Split", "ByteLevel"]
            and parts[0]["pattern"] == {"Regex": WORD_PATTERN} and parts[0]["invert"]
            and not parts[1]["add_prefix_space"] and not parts[1]["use_regex"]):
        return "word"
    return "other"


def _byte_letters() -> dict[int, str]:
    """The printable letter of each byte in byte-level vocabularies: itself if printable, else 256 and up."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class _Places(dict):
    """Where the ids of a piece (str) or a word (bytes) are kept: start * 2**20 + number."""

    def __init__(self, add):
        super().__init__()
        self.add = add

    def __missing__(self, key):
        place = self[key] = self.add(key)
        return place


class Subwords:
    """Encodes batches of texts; ``vocab`` is one more than the largest id."""

    def __init__(self, path: str, limit: int = LIMIT):
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as fh:
            spec = json.load(fh)
        self.kind = pipeline_kind(spec)
        self.tokenizer = Tokenizer.from_file(path)
        self._tokenize = self.tokenizer.model.tokenize
        self.vocab = max(self.tokenizer.get_vocab(with_added_tokens=True).values()) + 1
        self.limit = limit
        self._letters = _byte_letters()
        self._special = [t["content"] for t in spec.get("added_tokens", [])]
        self._clear()

    def _clear(self) -> None:
        self._places, self._flat, self._long = _Places(self._add), array("I"), False

    def _whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _add(self, key: str | bytes) -> int:
        if isinstance(key, bytes):
            ids = self._whole(key.decode())
        else:
            shown = key if key.isascii() and key.isalpha() else key.encode().decode("latin-1").translate(self._letters)
            ids = [t.id for t in self._tokenize(shown)]
        start = len(self._flat)
        self._flat.extend(ids)
        self._long |= len(ids) >= 1 << 20
        return start << 20 | len(ids)

    def _keys(self, text: str) -> list:
        plain = _PLAIN.fullmatch(text) is not None and not any(t in text for t in self._special)
        if self.kind == "word":
            return _PIECES["word"].findall(text.lower()) if plain else text.encode().split()
        if "\0" in text or _ODD_SPACE.search(text):
            return [u.encode() for u in _SAFE_CUT.split(text) if u]
        if plain and not text.endswith(" "):
            return _PIECES["byte"].findall(text)
        return [u for u in text.encode().replace(b" ", b"\0 ").replace(b"\n", b"\0\n").split(b"\0") if u]

    def _look_up(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if len(self._places) > self.limit:
            self._clear()
        keys, bounds = [], np.zeros(len(texts) + 1, np.int64)
        for i, text in enumerate(texts):
            keys += self._keys(text)
            bounds[i + 1] = len(keys)
        return np.fromiter(map(self._places.__getitem__, keys), np.int64, len(keys)), bounds

    def _long_words(self) -> bool:
        """Whether a single word has more ids than a place can tell; then texts are encoded whole."""
        if self._long:
            self._clear()
            return True
        return False

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, one after another; number of ids of each text)."""
        if self.kind == "other":
            return self._plain(texts)
        place, bounds = self._look_up(texts)
        if self._long_words():
            return self._plain(texts)
        length = place & 0xFFFFF
        ends = np.concatenate([[0], np.cumsum(length)])
        at = np.repeat((place >> 20) - ends[:-1], length) + np.arange(ends[-1])
        # a copy, so that the store may grow again
        return np.frombuffer(self._flat, np.uint32)[at] if len(at) else np.empty(0, np.uint32), ends[bounds[1:]] - ends[bounds[:-1]]

    def _plain_lines(self, lines: str, n: int) -> np.ndarray:
        """Which of ``n`` lines hold neither other characters than the known ones nor a special string."""
        odd = [m.start() for m in _OTHERS.finditer(lines)]
        for t in self._special:
            at = lines.find(t)
            while at >= 0:
                odd.append(at)
                at = lines.find(t, at + 1)
        plain = np.ones(n, bool)
        if odd:
            ends = np.flatnonzero(np.frombuffer(lines.encode("utf-32-le"), np.uint32) == 10)
            plain[np.searchsorted(ends, odd)] = False
        return plain

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """``encode`` for very many short texts without white space: the plain ones are cut in one go."""
        if self.kind != "word":
            return self.encode(words)
        lines = "\n".join([*words, ""])
        plain = self._plain_lines(lines, len(words))
        lengths = np.zeros(len(words), np.int64)
        other = np.empty(0, np.uint32)
        if not plain.all():
            other, lengths[~plain] = self.encode([w for w, p in zip(words, plain) if not p])
            lines = "\n".join([w for w, p in zip(words, plain) if p] + [""])
        if len(self._places) > self.limit:
            self._clear()
        self._places["\n"] = _BREAK
        keys = _LINES.findall(lines.lower())
        place = np.fromiter(map(self._places.__getitem__, keys), np.int64, len(keys))
        size = place & 0xFFFFF
        ends = np.concatenate([[0], np.cumsum(size)])
        lengths[plain] = np.diff(ends[np.concatenate([[0], np.flatnonzero(place == _BREAK)])])
        at = np.repeat((place >> 20) - ends[:-1], size) + np.arange(ends[-1])
        out = np.empty(int(lengths.sum()), np.uint32)
        of_plain = np.repeat(plain, lengths)
        out[of_plain] = np.frombuffer(self._flat, np.uint32)[at] if len(at) else 0
        out[~of_plain] = other
        return out, lengths

    def _plain(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [self._whole(t) for t in texts]
        return np.array([i for x in found for i in x], np.uint32), np.array([len(x) for x in found], np.int64)

    def count(self, texts: list[str]) -> np.ndarray:
        """Number of ids of each text."""
        if self.kind == "other":
            return self._plain(texts)[1]
        place, bounds = self._look_up(texts)
        if self._long_words():
            return self._plain(texts)[1]
        ends = np.concatenate([[0], np.cumsum(place & 0xFFFFF)])
        return ends[bounds[1:]] - ends[bounds[:-1]]


_open: dict[str, Subwords] = {}


def open_subwords(path: str) -> Subwords:
    """One encoder per worker process and file, so words stay known from batch to batch."""
    if path not in _open:
        _open[path] = Subwords(path)
    return _open[path]
