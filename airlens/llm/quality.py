"""Quality classifier: histogram gradient-boosted trees over statistics of a document's bytes and words.

The statistics see the text alone; ids, labels, language and source are never
inputs. Trees are grown on a sample of at most ``SAMPLE`` labelled training
rows, the ones whose id hashes lowest, so the sample is the same whatever the
layout and bounded whatever the input. The trees become flat arrays; scoring
walks all trees of a batch of documents at once.

A null text is empty, and an empty text has statistics of its own (all zero),
so it gets a score too. A label counts as 1 if at least half of the labels of
its id are; null labels are left out. Of several training texts with one id, one is used.
Without any training label every score is 0.5. Repeated rows each get a row.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airlens.llm.shared import columns, crc_mod, document_runs, map_arrow, text_buffers
from airlens.llm.words import gram_hashes, word_hashes

SAMPLE = 20_000   # most labelled rows that the trees are grown on
BINS = 64
TREES = 80
DEPTH = 5
RATE = 0.15
LEAST = 10        # rows a leaf holds at least
RIDGE = 1.0

_CLASSES = ("lower", "upper", "digit", "space", "newline", "stop", "comma", "bang", "symbol", "bar", "quote", "angle",
            "dash", "colon", "other", "accent", "tail", "control")
STATISTICS = tuple(f"share_{c}" for c in _CLASSES) + (
    "log_bytes", "log_words", "mean_word", "same_word", "distinct_words", "distinct_pairs", "distinct_fives",
    "words_per_line", "words_per_stop", "upper_of_letters", "symbols_per_word", "distinct_lines", "longest_repeat")


def _byte_classes() -> np.ndarray:
    kind = np.full(256, _CLASSES.index("other"), np.uint8)
    for name, chars in (("space", " \t"), ("newline", "\n\r\v\f"), ("stop", ".?"), ("comma", ",;"), ("bang", "!"),
                        ("symbol", "#$%&*@^~+="), ("bar", "|"), ("quote", "'\"`"), ("angle", "<>{}[]()\\/"),
                        ("dash", "-_"), ("colon", ":"),
                        ("lower", "abcdefghijklmnopqrstuvwxyz"), ("upper", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
                        ("digit", "0123456789")):
        kind[[ord(c) for c in chars]] = _CLASSES.index(name)
    kind[128:192], kind[192:] = _CLASSES.index("tail"), _CLASSES.index("accent")
    kind[[b for b in range(32) if b not in (9, 10, 11, 12, 13)]] = _CLASSES.index("control")
    return kind


_KIND = _byte_classes()


def _distinct(x: np.ndarray) -> float:
    return len(np.unique(x)) / len(x) if len(x) else 1.0


def statistics(column: pa.Array) -> np.ndarray:
    """A row of STATISTICS per text."""
    raw, off = text_buffers(column)
    out = np.zeros((len(column), len(STATISTICS)))
    width = len(_CLASSES)
    col = {name: i for i, name in enumerate(STATISTICS)}
    for i, j in document_runs(off):
        piece, own = raw[off[i]:off[j]], off[i:j + 1] - off[i]
        size = np.diff(own)
        doc = np.repeat(np.arange(j - i) * width, size)
        counts = np.bincount(doc + _KIND[piece], minlength=(j - i) * width).reshape(j - i, width)
        h, starts = word_hashes(piece, own)
        bounds = np.searchsorted(starts, own)
        words = np.diff(bounds)
        part = out[i:j]
        part[:, :width] = counts / np.maximum(size, 1)[:, None]
        at = {c: counts[:, k] for k, c in enumerate(_CLASSES)}
        part[:, col["log_bytes"]] = np.log1p(size)
        part[:, col["log_words"]] = np.log1p(words)
        part[:, col["mean_word"]] = (size - at["space"] - at["newline"]) / np.maximum(words, 1)
        part[:, col["words_per_line"]] = words / (at["newline"] + 1)
        part[:, col["words_per_stop"]] = words / (at["stop"] + 1)
        part[:, col["upper_of_letters"]] = at["upper"] / np.maximum(at["upper"] + at["lower"], 1)
        part[:, col["symbols_per_word"]] = (at["symbol"] + at["bang"] + at["bar"]) / np.maximum(words, 1)
        pairs, fives = gram_hashes(h, 2), gram_hashes(h, 5)
        lines = np.concatenate([[0], np.cumsum(piece == 10)])
        for k, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])):
            n = b - a
            if not n:
                continue
            own_words = h[a:b]
            same = own_words[1:] == own_words[:-1]
            part[k, col["same_word"]] = same.mean() if n > 1 else 0.0
            _, times = np.unique(own_words, return_counts=True)
            part[k, col["distinct_words"]] = len(times) / n
            part[k, col["longest_repeat"]] = times.max() / n
            part[k, col["distinct_pairs"]] = _distinct(pairs[a:max(a, b - 1)])
            part[k, col["distinct_fives"]] = _distinct(fives[a:max(a, b - 4)])
            line_of = lines[starts[a:b]]
            first = np.flatnonzero(np.append(True, line_of[1:] != line_of[:-1]))
            with np.errstate(over="ignore"):
                part[k, col["distinct_lines"]] = _distinct(np.add.reduceat(own_words, first))
    return out


@dataclass
class Trees:
    """All trees in arrays: node ``k`` sends a row left if x[feature] <= cut; a leaf leads to itself."""
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        if not len(self.roots):
            return np.full(len(x), 1 / (1 + np.exp(-self.base)))
        rows = np.arange(len(x))[:, None]
        node = np.broadcast_to(self.roots, (len(x), len(self.roots)))
        for _ in range(DEPTH):
            node = np.where(x[rows, self.feature[node]] <= self.cut[node], self.left[node], self.right[node])
        return 1 / (1 + np.exp(-(self.base + self.value[node].sum(axis=1))))


def fit_trees(x: np.ndarray, y: np.ndarray) -> Trees:
    """Boosted trees for the logistic loss, split on histograms of gradients per statistic and bin."""
    none = np.zeros(0)
    if not len(y) or y.min() == y.max():
        share = y.mean() if len(y) else 0.5
        base = float(np.log((share * len(y) + 0.5) / ((1 - share) * len(y) + 0.5)))
        return Trees(none, none, none, none, none, np.zeros(0, np.int64), base)
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)], axis=1)
    n, width = x.shape
    base = float(np.log(y.mean() / (1 - y.mean())))
    margin = np.full(n, base)
    feature, cut, left, right, value, roots = [], [], [], [], [], []
    slots = binned + np.arange(width) * BINS

    def new_node() -> int:
        k = len(feature)
        for array, v in ((feature, 0), (cut, np.inf), (left, k), (right, k), (value, 0.0)):
            array.append(v)
        return k

    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = y - p, p * (1 - p)
        roots.append(new_node())
        level = [(roots[-1], np.arange(n))]
        for depth in range(DEPTH + 1):
            following = []
            for node, rows in level:
                g, h = grad[rows].sum(), hess[rows].sum()
                value[node] = RATE * g / (h + RIDGE)
                best = None
                if depth < DEPTH and len(rows) >= 2 * LEAST:
                    at = slots[rows].ravel()
                    def hist(w):
                        return np.bincount(at, w, minlength=width * BINS).reshape(width, BINS).cumsum(1)[:, :-1]
                    gl, hl = hist(np.repeat(grad[rows], width)), hist(np.repeat(hess[rows], width))
                    nl = hist(None)
                    gain = gl ** 2 / (hl + RIDGE) + (g - gl) ** 2 / (h - hl + RIDGE) - g ** 2 / (h + RIDGE)
                    gain[(nl < LEAST) | (len(rows) - nl < LEAST)] = -1
                    best = np.unravel_index(np.argmax(gain), gain.shape)
                    if gain[best] <= 1e-6:
                        best = None
                if best is None:
                    margin[rows] += value[node]
                    continue
                f, b = int(best[0]), int(best[1])
                feature[node], cut[node] = f, float(edges[f][b])
                goes = binned[rows, f] <= b
                left[node], right[node] = new_node(), new_node()
                value[node] = 0.0
                following += [(left[node], rows[goes]), (right[node], rows[~goes])]
            level = following
    return Trees(np.array(feature), np.array(cut), np.array(left), np.array(right), np.array(value),
                 np.array(roots), base)


def fit_quality(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "quality",
                fold: tuple[int, int] = (3, 1), sample: int = SAMPLE) -> Trees:
    """Trees from at most ``sample`` labelled rows outside the fold (crc32(id) mod fold[0] = fold[1])."""
    known = (columns(labels, id, label).select(F.col(f"`{id}`").cast("long").alias("doc"), F.col(f"`{label}`").alias("y"))
             .where("doc is not null and y is not null").where(crc_mod(F.col("doc"), fold[0]) != fold[1])
             .groupBy("doc").agg((F.avg("y") >= 0.5).cast("int").alias("y")))
    texts = columns(docs, id, text).select(F.col(f"`{id}`").cast("long").alias("doc"), F.col(f"`{text}`").alias("text"))
    # ids of both tables first, so the sample holds rows that have a text; at most ``sample`` rows are broadcast
    chosen = known.join(texts.select("doc").distinct(), "doc", "left_semi") \
        .orderBy(F.xxhash64("doc"), "doc").limit(sample)
    chosen = docs.sparkSession.createDataFrame(chosen.toArrow())

    def rows(batches):
        for batch in batches:
            x = statistics(batch.column(2))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(list(x), pa.list_(pa.float64()))], ["doc", "y", "x"])

    found = (texts.join(F.broadcast(chosen), "doc").select("doc", "y", "text")
             .transform(map_arrow, rows, "doc long, y int, x array<double>")
             .groupBy("doc").agg(F.min("y").alias("y"), F.min("x").alias("x")).toArrow().sort_by("doc"))
    x = found.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, len(STATISTICS))
    return fit_trees(x, found.column("y").to_numpy().astype(float))


def score_quality(docs: DataFrame, trees: Trees, id: str = "doc_id", text: str = "text",
                  fold: tuple[int, int] = (3, 1)) -> DataFrame:
    """Per document: ``id``, held_out, score, predicted (1 if score >= 0.5)."""
    shared = docs.sparkSession.sparkContext.broadcast(trees)
    one = columns(docs, id, text).select(
        F.col(f"`{id}`").alias("doc"), F.coalesce(crc_mod(F.col(f"`{id}`"), fold[0]) == fold[1], F.lit(False)).alias("held"),
        F.col(f"`{text}`").alias("text"))

    def rows(batches):
        for batch in batches:
            score = shared.value.score(statistics(batch.column(2)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
                ["doc", "held_out", "score", "predicted"])

    kind = docs.schema[id].dataType.simpleString()
    return one.transform(map_arrow, rows, f"doc {kind}, held_out boolean, score double, predicted int").withColumnRenamed("doc", id)


def keep_good(docs: DataFrame, trees: Trees, text: str = "text") -> DataFrame:
    """The rows whose text is predicted good, with all their columns."""
    shared, at = docs.sparkSession.sparkContext.broadcast(trees), docs.columns.index(text)

    def rows(batches):
        for batch in batches:
            yield batch.filter(pa.array(shared.value.score(statistics(batch.column(at))) >= 0.5))

    return docs.transform(map_arrow, rows, docs.schema)
