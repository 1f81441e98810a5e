"""Token counts of whole texts; huge documents are encoded in overlapping chunks and resynchronised.

A text of at most ``huge`` characters is counted directly. A longer one is cut
into chunks that overlap. Neighbouring chunks are encoded with character
offsets, and the counts are spliced at a *stable* cut of the overlap: a place no
token crosses and on whose sides tokens do not depend on each other (an ASCII
white space after a character that is none, see ``subwords``), where both
chunks also gave the same tokens between two such cuts. Where the overlap has no such pair of
cuts or the chunks disagree, the left chunk is extended by a doubled overlap
until they agree or it has swallowed the right one; so the count is always
that of the whole text, while the encoder never sees more than it needs.

A null text is empty: no bytes, no tokens. Repeated rows are counted each for
itself; a null id stays null; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airlens.llm.shared import columns, document_runs, map_arrow
from airlens.llm.subwords import open_subwords

HUGE = 1 << 15      # characters from which a text is encoded in chunks
CHUNK = 1 << 14     # characters of a chunk
OVERLAP = 1 << 8    # characters that neighbouring chunks share at first
TEXT_RUN = 1 << 19

# a cut stands before the space; the character before it is white space under no definition
_CUT = re.compile("(?<=[^\\s\u180e\u200b\ufeff])(?=[ \n][^\\s\u180e\u200b\ufeff])")

Spans = tuple[np.ndarray, np.ndarray, np.ndarray]   # ids, first and last character of each token


def stable_cuts(text: str, low: int, high: int) -> list[int]:
    """Places strictly inside text[low:high] where a cut changes no token."""
    return [m.start() for m in _CUT.finditer(text, low + 1, high - 1)]


def _between(spans: Spans, low: int, high: int) -> tuple[list, list]:
    ids, first, _ = spans
    a, b = np.searchsorted(first, [low, high])
    return ids[a:b].tolist(), first[a:b].tolist()


def agreed_cut(text: str, left: Spans, right: Spans, low: int, high: int) -> int | None:
    """A stable cut of the overlap up to which the left chunk counts, or None if the chunks do not align."""
    cuts = stable_cuts(text, low, high)
    if len(cuts) < 2:
        return None
    middle = len(cuts) // 2
    first, last = cuts[middle - 1], cuts[-1]
    one, two = _between(left, first, last), _between(right, first, last)
    return first if one[0] and one == two else None


def count_in_chunks(text: str, spans_of: Callable[[str], Spans], chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """Number of tokens of ``text``; ``spans_of`` encodes one string with ascending character offsets."""
    def encoded(a: int, b: int) -> Spans:
        ids, first, last = spans_of(text[a:b])
        return ids, first + a, last + a

    total, at, end = 0, 0, min(len(text), chunk + overlap)
    counted = 0                               # tokens before this place are counted
    left = encoded(at, end)
    while end < len(text):
        width, begin = overlap, end - overlap   # the right chunk begins inside the left one
        stop = min(len(text), begin + chunk + overlap)
        right = encoded(begin, stop)
        cut = agreed_cut(text, left, right, begin, end)
        while cut is None and end < stop:
            width *= 2
            end = min(stop, begin + width)
            left = encoded(counted, end)
            cut = agreed_cut(text, left, right, begin, end) if end < stop else None
        if cut is None:                       # the left chunk has swallowed the right one
            continue
        a, b = np.searchsorted(left[1], [counted, cut])
        total += int(b - a)
        counted, left, end = cut, right, stop
    return total + int(len(left[1]) - np.searchsorted(left[1], counted))


def _open(path: str):
    """(count of a list of short texts, spans of one string or None if the pipeline has no stable cuts)."""
    if path.endswith(".model"):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: np.array([len(x) for x in model.encode(texts, num_threads=1)], np.int64), None
    sub = open_subwords(path)

    def spans(text: str) -> Spans:
        e = sub.tokenizer.encode(text, add_special_tokens=False)
        offsets = np.array(e.offsets, np.int64).reshape(-1, 2)
        # a character of several tokens gives all of them its place; running maxima keep the order ascending
        return np.array(e.ids, np.int64), np.maximum.accumulate(offsets[:, 0]), offsets[:, 1]

    return sub.count, spans if sub.kind != "other" else None


def _count(path: str, limit: int, huge: int):
    def run(batches):
        short, spans = _open(path)
        for batch in batches:
            size = batch.column(2).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            found = []
            for i, j in document_runs(np.concatenate([[0], np.cumsum(size)]), TEXT_RUN):
                texts = [t or "" for t in batch.column(1).slice(i, j - i).to_pylist()]
                if spans is None or max(map(len, texts)) <= huge:
                    found.append(short(texts))
                    continue
                some = np.zeros(len(texts), np.int64)
                long = np.array([len(t) > huge for t in texts])
                some[~long] = short([t for t, big in zip(texts, long) if not big])
                some[long] = [count_in_chunks(t, spans) for t, big in zip(texts, long) if big]
                found.append(some)
            n = np.concatenate(found) if found else np.empty(0, np.int64)
            yield pa.RecordBatch.from_pydict({"doc": batch.column(0), "n_bytes": size, "n_tokens": n,
                                              "over_limit": pa.array(n > limit)})
    return run


def token_counts(docs: DataFrame, tokenizer: str, id: str = "doc_id", text: str = "text", limit: int = 2048,
                 huge: int = HUGE) -> DataFrame:
    """Per document: ``id``, n_bytes (UTF-8), n_tokens, over_limit (more than ``limit`` tokens)."""
    kind = docs.schema[id].dataType.simpleString()
    one = columns(docs, id, text).select(F.col(f"`{id}`").alias("doc"), F.col(f"`{text}`").alias("text"),
                                         F.octet_length(F.col(f"`{text}`")).alias("size"))
    return one.transform(map_arrow, _count(tokenizer, limit, huge),
                          f"doc {kind}, n_bytes long, n_tokens long, over_limit boolean").withColumnRenamed("doc", id)
