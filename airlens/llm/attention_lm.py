"""Language-model scores of whole texts: a causal self-attention model in numpy on subword ids.

Words are runs of bytes other than ASCII white space with A-Z lower-cased; a
text's subword ids are those of its words in order, then one end. The model gives

    p(next | before) = p(class | before) p(next | class, last)

with a class score that adds the last id's row of a table to what one head of causal self-attention reads
from the last ``2 * STRIDE`` ids at most, and ids within a class by their counts after the last id. The ``RANKS`` most
frequent ids have rows and columns of their own in the tables, the others share one. Classes are the most
frequent ids, alone, clusters of ids with similar successors, and the others. Tables are smoothed counts of all
training text; embeddings are their leading components. Attention weights are trained by Adam on all windows of every chunk of training
text, a third of them in each of three rounds, and averaged over the chunks by their true number of windows; so counts, classes and weights draw on the whole
corpus, and what is gathered follows its size (bounded in width by the vocabulary).

Windows overlap by half: the later half of each is scored, so every id is scored once, with ``STRIDE`` to
``2 * STRIDE - 1`` ids before it where the text has them. A mask hides later ids and other documents.

The base score takes each word (and one end) with (c + 1) / (N + V + 1) from word counts over all training texts; counts
meet the chunks' distinct words through a shuffle by word hash. Rows whose crc32(id) mod ``fold[0]`` is
``fold[1]`` are held out of all training. Null texts are empty: one end. Null ids are not held out. Repeated
rows count and are scored each. Without training rows counts are zero and the model is uniform. Other columns
are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airlens.llm.shared import columns, crc_mod, map_arrow, staged
from airlens.llm.subwords import open_subwords
from airlens.llm.words import U64, word_hashes

CHUNK = 4 << 20     # bytes of text in a chunk
WIDTH = 16          # of embeddings and the attention head
ALONE = 96          # most frequent ids, each a class
CLUSTERS = 31       # classes of the other ranked ids; one more holds the rest
STRIDE = 16         # ids scored by a window of twice as many
STEPS, BATCH = 16, 64   # least steps of Adam in each chunk and round (windows of short chunks come again), windows in each
ROUNDS = 3
RANKS = 2048        # most frequent ids with counts of their own
SMOOTH, WITHIN = 4.0, 4.0   # weight of the overall shares in a row of classes, and of ids within a class
BLOCKS = 48         # stretches of rows that the counts are summed in
RATE = 0.01

_CHUNKS = "chunk long, docs binary, words binary, train binary, index binary, sub binary, lengths binary"
_DOC = np.dtype([("doc", "<i8"), ("known", "?"), ("held", "?"), ("n", "<i8")])


def _z(x: np.ndarray) -> bytes:
    raw = x.tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unz(blob: bytes, kind) -> np.ndarray:
    return np.frombuffer(pa.decompress(blob[8:], int.from_bytes(blob[:8], "little"), codec="zstd", asbytes=True), kind)


def _split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(words of all texts, number of each): runs of bytes other than ASCII white space, A-Z lower-cased."""
    found = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    n, words = pc.list_value_length(found).to_numpy(zero_copy_only=False).astype(np.int64), found.flatten()
    filled = pc.binary_length(words).to_numpy(zero_copy_only=False) > 0
    if not filled.all():        # white space at either end leaves empty words
        n = np.bincount(np.repeat(np.arange(len(n)), n)[filled], minlength=len(n))
        words = words.filter(pa.array(filled))
    return words, n


def _chunks(path: str):
    """Texts as chunks: documents, distinct words (hash, training count, subword ids) and the words' places."""
    def run(batches):
        sub, base = open_subwords(path), TaskContext.get().partitionId() << 24
        made, size, docs, words = 0, 0, [], []

        def row():
            all_docs, coded = np.concatenate(docs), pa.concat_arrays(words).dictionary_encode()
            names, index = coded.dictionary, coded.indices.to_numpy()
            if len(names):
                joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(names)], pa.int32()), names), "\n")[0]
                h = word_hashes(np.frombuffer(joined.as_buffer(), np.uint8), np.empty(0, np.int64))[0]
            else:
                h = np.empty(0, U64)
            order = np.argsort(h, kind="stable")
            place = np.empty(len(h), np.uint32)
            place[order] = np.arange(len(h), dtype=np.uint32)
            all_index = place[index]
            of_train = np.repeat(~all_docs["held"], all_docs["n"])
            train = np.bincount(all_index[of_train], minlength=len(h)).astype("<u4")
            flat, lengths = sub.encode_words(names.take(pa.array(order)).to_pylist()) if len(names) else (
                np.empty(0, np.uint32), np.empty(0, np.int64))
            return pa.RecordBatch.from_pydict({
                "chunk": [base + made], "docs": [_z(all_docs)], "words": [h[order].tobytes()],
                "train": [_z(train)], "index": [_z(all_index)], "sub": [_z(flat.astype("<u4"))],
                "lengths": [_z(lengths.astype("<u4"))]},
                pa.schema([("chunk", pa.int64())] + [(c, pa.binary()) for c in
                          ("docs", "words", "train", "index", "sub", "lengths")]))

        for batch in batches:
            text = batch.column(2).fill_null("")
            ends, at = np.cumsum(pc.binary_length(text).to_numpy(zero_copy_only=False), dtype=np.int64), 0
            while at < len(text):
                start = size - (int(ends[at - 1]) if at else 0)
                stop = min(int(np.searchsorted(ends, CHUNK - start)) + 1, len(text))     # the first that fills the chunk
                found, n = _split(text[at:stop])
                some = np.empty(stop - at, _DOC)
                doc, is_held = (c[at:stop] for c in batch.columns[:2])
                some["doc"], some["known"] = doc.fill_null(0), doc.is_valid()
                some["held"], some["n"] = is_held, n
                words.append(found)
                docs.append(some)
                size, at = start + int(ends[stop - 1]), stop
                if size >= CHUNK:
                    yield row()
                    made += 1
                    size, docs, words = 0, [], []
        if docs:
            yield row()
    return run


def _word_parts(buckets: int):
    """A chunk's distinct words dealt by hash: (bucket, chunk, hashes, training counts)."""
    def run(batches):
        for batch in batches:
            for chunk, words, train in zip(*(c.to_pylist() for c in batch.columns)):
                h, n = np.frombuffer(words, "<u8"), _unz(train, "<u4")
                edge = np.append(np.searchsorted(h, np.array([(b << 64) // buckets for b in range(buckets)], object)
                                                 .astype(U64)), len(h))
                rows = [(b, chunk, h[a:z].tobytes(), _z(n[a:z])) for b, (a, z) in enumerate(zip(edge[:-1], edge[1:])) if z > a]
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(list(c), t) for c, t in zip(zip(*rows), (pa.int32(), pa.int64(), pa.binary(), pa.binary()))],
                        ["bucket", "chunk", "words", "train"])
    return run


_COUNTS = "chunk long, bucket int, counts binary, n long, v long"


def _sum_words(table: pa.Table) -> pa.Table:
    """Total training counts of a bucket's words, in the order of each chunk; and the bucket's N and V."""
    chunks = table.column("chunk").to_pylist()
    words = [np.frombuffer(x, "<u8") for x in table.column("words").to_pylist()]
    train = [_unz(x, "<u4") for x in table.column("train").to_pylist()]
    h, n = np.concatenate(words), np.concatenate(train)
    unique, inverse = np.unique(h, return_inverse=True)
    total = np.bincount(inverse, n, minlength=len(unique)).astype(np.int64)
    mine, bounds = total[inverse], np.cumsum([0] + [len(w) for w in words])
    bucket = table.column("bucket")[0].as_py()
    return pa.table({
        "chunk": pa.array(chunks + [None], pa.int64()), "bucket": pa.array([bucket] * (len(chunks) + 1), pa.int32()),
        "counts": pa.array([_z(mine[a:b]) for a, b in zip(bounds[:-1], bounds[1:])] + [None], pa.binary()),
        "n": pa.array([None] * len(chunks) + [int(total.sum())], pa.int64()),
        "v": pa.array([None] * len(chunks) + [int((total > 0).sum())], pa.int64())})


def _sequence(index: np.ndarray, sub: np.ndarray, lengths: np.ndarray, words: np.ndarray, end: int):
    """(ids before, ids to predict, document number of each) of documents with so many words."""
    # an end, as one more word, after each document's words
    index, lengths, sub = np.insert(index, np.cumsum(words), len(lengths)), np.append(lengths, 1), np.append(sub, end).astype(np.int32)
    of = lengths.take(index).astype(np.int64)
    ends = np.cumsum(of)
    n = int(ends[-1]) if len(ends) else 0
    small = np.int32 if max(n, len(sub)) < 1 << 31 else np.int64
    at = np.repeat(((np.cumsum(lengths, dtype=np.int64) - lengths).take(index) - (ends - of)).astype(small), of)
    at += np.arange(n, dtype=small)
    target = sub.take(at)
    before = np.empty(n, np.int32)
    before[1:] = target[:-1]        # a document's first id follows an end: that of the document before
    if n:
        before[0] = end
    size = np.diff(ends[np.cumsum(words + 1) - 1], prepend=0)
    return before, target, np.repeat(np.arange(len(words), dtype=np.int32), size)


def _training_part(docs: np.ndarray, index: np.ndarray):
    keep = np.repeat(~docs["held"], docs["n"])
    return index[keep], docs["n"][~docs["held"]]


def _read_chunk(row) -> tuple:
    docs, index, sub, lengths = row
    return _unz(docs, _DOC), _unz(index, "<u4"), _unz(sub, "<u4"), _unz(lengths, "<u4")


def _followers(rank_of, n_ids: int):
    """Counts of (rank of an id, rank of the next) of the training texts of a task, in stretches of rows."""
    def run(batches):
        total, n = None, RANKS + 1
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                docs, index, sub, lengths = _read_chunk(row)
                part, words = _training_part(docs, index)
                before, target, _ = _sequence(part, sub, lengths, words, n_ids - 1)
                found = np.bincount(rank_of.value[before].astype(np.int64) * n + rank_of.value[target], minlength=n * n).astype(np.uint32)
                total = found if total is None else total + found
        if total is not None:
            for b, part in enumerate(np.array_split(total.reshape(n, n), BLOCKS)):
                if part.any():
                    yield pa.RecordBatch.from_pydict({"block": pa.array([b], pa.int32()), "counts": [_z(part)]})
    return run


def _sum_blocks(table: pa.Table) -> pa.Table:
    total = sum(_unz(x, "<u4").astype(np.int64) for x in table.column("counts").to_pylist())
    return pa.table({"block": pa.array([table.column("block")[0].as_py()], pa.int32()),
                     "counts": pa.array([_z(np.minimum(total, (1 << 32) - 1).astype("<u4"))], pa.binary())})


def _follower_table(chunks: DataFrame, rank_of: np.ndarray) -> np.ndarray:
    """The counts of the whole corpus: RANKS + 1 rows and columns, whatever its size."""
    shared = chunks.sparkSession.sparkContext.broadcast(rank_of)
    rows = (chunks.select("docs", "index", "sub", "lengths").transform(map_arrow, _followers(shared, len(rank_of)), "block int, counts binary", 1)
            .groupBy("block").applyInArrow(_sum_blocks, "block int, counts binary").toArrow())
    blocks = np.array_split(np.zeros((RANKS + 1, RANKS + 1), np.uint32), BLOCKS)
    for b, x in zip(rows.column("block").to_pylist(), rows.column("counts").to_pylist()):
        blocks[b] = _unz(x, "<u4").reshape(blocks[b].shape)
    return np.concatenate(blocks).astype(np.float64)


def _id_counts(n_ids: int):
    def run(batches):
        total = np.zeros(n_ids, np.int64)
        for batch in batches:
            for docs, train, sub, lengths in zip(*(c.to_pylist() for c in batch.columns)):
                weight = np.repeat(_unz(train, "<u4"), _unz(lengths, "<u4"))
                total += np.bincount(_unz(sub, "<u4"), weight, minlength=n_ids).astype(np.int64)
                total[-1] += int((~_unz(docs, _DOC)["held"]).sum())
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"id": used.astype(np.int64), "n": total[used]})
    return run


def _profiles(table: np.ndarray) -> np.ndarray:
    """Square roots of each row's shares of following classes, less their mean."""
    n = table.sum(1, keepdims=True)
    x = np.sqrt((table + 1e-3) / (n + 1e-3 * table.shape[1])).astype(np.float32)
    weight = n / max(1.0, n.sum())
    return x - (x * weight).sum(0)


def _ranks(counts: np.ndarray) -> np.ndarray:
    """Each id's place by frequency; RANKS for the others."""
    out = np.full(len(counts), RANKS, np.int32)
    top = np.argsort(-counts, kind="stable")[:RANKS]
    out[top] = np.arange(len(top))
    return out


def _classes(table: np.ndarray) -> np.ndarray:
    """Class of each rank: the first ALONE by themselves, others by similar followers, the last for the rest."""
    out = np.arange(RANKS + 1)
    x = _profiles(table @ np.eye(ALONE + 1)[np.minimum(out, ALONE)])[ALONE:RANKS]
    weight = np.sqrt(table.sum(1)[ALONE:RANKS] + 1e-6)
    # centres begin at the most frequent of the others; weighted k-means, a few rounds
    centre = x[:CLUSTERS].copy()
    for _ in range(8):
        nearest = np.argmax(x @ centre.T - 0.5 * (centre ** 2).sum(1), axis=1)
        for k in range(CLUSTERS):
            own = nearest == k
            if own.any():
                centre[k] = (x[own] * weight[own, None]).sum(0) / weight[own].sum()
    out[ALONE:RANKS] = ALONE + nearest
    out[RANKS] = ALONE + CLUSTERS
    return out


def _tables(counts: np.ndarray, rank_of: np.ndarray, table: np.ndarray) -> dict[str, np.ndarray]:
    """Everything but the trained weights, from counts; the weights at random from a fixed seed."""
    class_of, n_classes = _classes(table), ALONE + CLUSTERS + 1
    member = np.eye(n_classes)[class_of]
    n_next = table.sum(0) + 0.5
    n_class = n_next @ member
    by_class = table @ member
    rows = (by_class + SMOOTH * n_class / n_class.sum()) / (by_class.sum(1, keepdims=True) + SMOOTH)
    within = (table + WITHIN * n_next / n_class[class_of]) / (by_class[:, class_of] + WITHIN)
    rest = np.where(rank_of == RANKS, counts + 0.5, 0.0)
    x = _profiles(by_class)
    n = table.sum(1)
    _, vectors = np.linalg.eigh((x * np.sqrt(n + 1)[:, None]).T @ (x * np.sqrt(n + 1)[:, None]))
    embedding = x @ vectors[:, ::-1][:, :WIDTH]
    spread = np.sqrt(((embedding ** 2) * n[:, None]).sum(0) / max(1.0, n.sum()))
    embedding = np.clip(embedding / np.maximum(spread, 0.05 * spread.max(initial=0) + 1e-6), -4, 4)
    r = np.random.default_rng(7)
    small = lambda *shape: (r.standard_normal(shape) * 0.1).astype(np.float32)
    return {"rank_of": rank_of, "class_of": class_of, "rows": np.log(np.maximum(rows, 1e-30)).astype(np.float32),
            "within": np.log(within).astype(np.float32), "embedding": embedding.astype(np.float32),
            "rest": np.log(np.where(rest > 0, rest / max(rest.sum(), 0.5), 1.0)).astype(np.float32),
            "query": small(WIDTH, WIDTH), "key": small(WIDTH, WIDTH),
            "value": small(WIDTH, WIDTH) + np.eye(WIDTH, dtype=np.float32),
            "out": small(WIDTH, n_classes) * 0.1, "bias": np.zeros(n_classes, np.float32),
            "near": np.zeros(2 * STRIDE, np.float32)}


TRAINED = ("query", "key", "value", "out", "bias", "near")
_FAR = np.arange(STRIDE)[:, None] + STRIDE - np.arange(2 * STRIDE)[None, :]   # how far a key is behind a query


_HIDDEN = np.float32(-1e9)
_ONES = np.ones(max(BATCH, ALONE + CLUSTERS + 1), np.float32)
_BEHIND = np.where(_FAR >= 0, _FAR, -1).reshape(-1, 1) == np.arange(2 * STRIDE)    # sums scores by distance
_BEHIND = _BEHIND.astype(np.float32)


def _reach(m: dict) -> np.ndarray:
    """What distance adds to a score; later ids are hidden."""
    return np.where(_FAR >= 0, m["near"][np.maximum(_FAR, 0)], _HIDDEN).astype(np.float32)


def _views(m: dict, flat: np.ndarray) -> dict[str, np.ndarray]:
    """The trained weights as parts of one vector."""
    ends = np.cumsum([m[k].size for k in TRAINED])
    return {k: x.reshape(m[k].shape) for k, x in zip(TRAINED, np.split(flat, ends[:-1]))}


def _with_one(x: np.ndarray) -> np.ndarray:
    """Another column of ones: sums over rows then hold the sum of their weights too."""
    return np.concatenate([x, np.ones((len(x), 1), x.dtype)], axis=1)


def _shares(query: np.ndarray, key: np.ndarray, reach: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Attention, before division by its sums, of the later half of each window to all earlier ids of the same document."""
    score = query @ key.transpose(0, 2, 1)
    score += reach
    other = doc[:, 0] != doc[:, -1]           # only windows over a document's edge need the document mask
    if other.any():
        score[other] = np.where(doc[other][:, STRIDE:, None] == doc[other][:, None, :], score[other], _HIDDEN)
    np.minimum(score, 60, out=score)          # no overflow
    return np.exp(score, out=score)


def _logits(rows: np.ndarray, last: np.ndarray, read: np.ndarray, to_class: np.ndarray, room: np.ndarray) -> np.ndarray:
    """Class scores after the last ids, in the same memory at each call."""
    out, more = room[:, :len(last)]
    rows.take(last, 0, out=out, mode="clip")
    out += np.matmul(read, to_class, out=more)
    return out


def _n_windows(target: np.ndarray) -> int:
    return max(0, len(target) // STRIDE - 1)


def _windows(n_windows: int, turn: int) -> np.ndarray:
    """The windows of a round, mixed; the ROUNDS rounds cover all. Short chunks take theirs up to four times a round."""
    mixed = np.argsort(np.arange(n_windows) * 0.6180339887 % 1.0, kind="stable")
    share = -(-n_windows // ROUNDS)
    use = max(share, min(n_windows * 4, STEPS * BATCH))
    return mixed[(turn * share + np.arange(use)) % n_windows]


def _train(m: dict, before: np.ndarray, target: np.ndarray, doc: np.ndarray, turn: int = 0) -> tuple[dict, float]:
    """Adam over a round's windows of one chunk; returns the weights and the number of windows taken.

    Queries meet keys as e (query key') e' and values meet classes as (p e) (value out), so that a step multiplies
    the windows' embeddings by one small matrix each; the gradients of the factors follow from those of the products.
    """
    n_windows = _n_windows(target)
    if not n_windows:
        return {k: m[k] for k in TRAINED}, 0.0
    before, kind = m["rank_of"].take(before), m["class_of"].take(m["rank_of"].take(target))
    at = _windows(n_windows, turn) * STRIDE
    use = len(at)
    # all weights in one vector, and views of it by name
    weights = np.concatenate([m[k].ravel() for k in TRAINED])
    grad, first, second = np.empty_like(weights), np.zeros_like(weights), np.zeros_like(weights)
    w, d = _views(m, weights), _views(m, grad)
    embedding, scale = _with_one(m["embedding"]), np.float32(WIDTH ** -0.5)
    to_class = np.empty((WIDTH + 1, len(m["bias"])), np.float32)
    room = np.empty((2, BATCH * STRIDE, len(m["bias"])), np.float32)
    for step in range(-(-use // BATCH)):
        place = at[step * BATCH:(step + 1) * BATCH, None] + np.arange(2 * STRIDE)
        ids, owner, want = before[place], doc[place], kind[place[:, STRIDE:]].ravel()
        n, shape = len(want), (len(place), STRIDE, WIDTH)
        e = embedding.take(ids, 0)
        plain, late = e[:, :, :WIDTH], e[:, STRIDE:, :WIDTH].reshape(-1, WIDTH)
        p = _shares((late @ (w["query"] @ w["key"].T * scale)).reshape(shape), plain, _reach(w), owner)
        read = (p @ e).reshape(n, WIDTH + 1)
        total = read[:, WIDTH:].copy()
        read /= total
        p /= total.reshape(-1, STRIDE, 1)
        to_class[:WIDTH], to_class[WIDTH] = w["value"] @ w["out"], w["bias"]
        share = _logits(m["rows"], ids[:, STRIDE:].ravel(), read, to_class, room)
        with np.errstate(over="ignore"):
            np.exp(share, out=share)
        total = share @ _ONES[:share.shape[1]]
        if not 0 < total.min() <= total.max() < np.inf:
            share = _logits(m["rows"], ids[:, STRIDE:].ravel(), read, to_class, room)
            share -= share.max(1, keepdims=True)
            np.exp(share, out=share)
            total = share.sum(1)
        share[np.arange(n), want] -= total
        part = (1 / (total * np.float32(n)))[:, None]    # share * part is the gradient of the logits
        part_read = read * part
        # in stretches that stay in the cache
        of_class = sum(share[i:i + 256].T @ part_read[i:i + 256] for i in range(0, n, 256))
        d["out"][:], d["bias"][:] = (of_class[:, :WIDTH] @ w["value"]).T, of_class[:, WIDTH]
        d["value"][:] = (w["out"] @ of_class[:, :WIDTH]).T
        of_read = share @ to_class[:WIDTH].T
        of_read *= part
        of_score = of_read.reshape(shape) @ plain.transpose(0, 2, 1)
        of_score -= np.einsum("ij,ij->i", of_read, read[:, :WIDTH]).reshape(-1, STRIDE, 1)
        of_score *= p
        of_mix = late.T @ (of_score @ plain).reshape(-1, WIDTH) * scale
        d["query"][:], d["key"][:] = of_mix @ w["key"], of_mix.T @ w["query"]
        d["near"][:] = (_ONES[:len(place)] @ of_score.reshape(len(place), -1)) @ _BEHIND
        first += 0.1 * (grad - first)
        second += 0.01 * (grad * grad - second)
        t = step + 1
        weights -= RATE * (first / (1 - 0.9 ** t)) / (np.sqrt(second / (1 - 0.99 ** t)) + 1e-8)
    return w, float(use)


def _train_chunks(shared, n_ids: int, turn: int):
    def run(batches):
        total, weight = None, 0.0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                docs, index, sub, lengths = _read_chunk(row)
                part, words = _training_part(docs, index)
                before, target, doc = _sequence(part, sub, lengths, words, n_ids - 1)
                got, _ = _train(shared.value, before, target, doc, turn)
                w = float(_n_windows(target))
                flat = np.concatenate([got[k].ravel() for k in TRAINED]).astype(np.float64) * w
                total, weight = flat if total is None else total + flat, weight + w
        if weight:
            yield pa.RecordBatch.from_pydict({"part": pa.array(range(len(total)), pa.int32()), "x": total,
                                              "w": np.full(len(total), weight)})
    return run


def fit_model(chunks: DataFrame, n_ids: int) -> dict[str, np.ndarray]:
    """The model from all training texts of the chunks; ``n_ids`` counts the end, which is the last id."""
    spark = chunks.sparkSession
    rows = (chunks.select("docs", "train", "sub", "lengths").transform(map_arrow, _id_counts(n_ids), "id long, n long", 1)
            .groupBy("id").agg(F.sum("n").alias("n")).toArrow())
    counts = np.zeros(n_ids, np.int64)
    counts[rows.column("id").to_numpy()] = rows.column("n").to_numpy()
    rank_of = _ranks(counts)
    m = _tables(counts, rank_of, _follower_table(chunks, rank_of))
    for turn in range(ROUNDS):
        shared = spark.sparkContext.broadcast(m)
        # a few thousand weights, summed over tasks
        got = (chunks.select("docs", "index", "sub", "lengths").transform(map_arrow, _train_chunks(shared, n_ids, turn), "part int, x double, w double", 1)
               .groupBy("part").agg((F.sum("x") / F.sum("w")).alias("x")).toArrow().sort_by("part"))
        if got.num_rows:
            flat, at = got.column("x").to_numpy().astype(np.float32), 0
            for name in TRAINED:
                m[name] = flat[at:at + m[name].size].reshape(m[name].shape)
                at += m[name].size
        shared.unpersist()
    return m


def log10_probabilities(m: dict, before: np.ndarray, target: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """log10 p of every id of a sequence of documents; each is in the later half of exactly one window."""
    n = len(target)
    last, following = m["rank_of"].take(before), m["rank_of"].take(target)
    blocks = -(-n // STRIDE)
    room = blocks * STRIDE - n
    ids = np.concatenate([np.zeros(STRIDE, np.int32), last, np.zeros(room, np.int32)]).reshape(-1, STRIDE)
    own = np.concatenate([np.full(STRIDE, -1, np.int32), doc, np.full(room, -2, np.int32)]).reshape(-1, STRIDE)
    kind = np.concatenate([m["class_of"].take(following).astype(np.int32), np.zeros(room, np.int32)]).reshape(-1, STRIDE)
    out = np.empty((blocks, STRIDE), np.float32)
    # what an id contributes as query and (by the class scores of its value) to what is read, and its row of classes
    embedding, rows, reach = _with_one(m["embedding"]), m["rows"], _reach(m)
    query = m["embedding"] @ (m["query"] @ m["key"].T * np.float32(WIDTH ** -0.5))
    to_class = np.concatenate([m["value"] @ m["out"], m["bias"][None]])
    room = np.empty((2, BATCH * STRIDE, rows.shape[1]), np.float32)
    for a in range(0, blocks, BATCH):
        z = min(a + BATCH, blocks)
        now = ids[a + 1:z + 1].ravel()
        e = embedding.take(ids[a:z + 1], 0)
        window = np.lib.stride_tricks.as_strided(e, (z - a, 2 * STRIDE, WIDTH + 1), e.strides)   # each block and the next
        p = _shares(query.take(now, 0).reshape(-1, STRIDE, WIDTH), window[:, :, :WIDTH], reach,
                    np.concatenate([own[a:z], own[a + 1:z + 1]], axis=1))
        read = (p @ window).reshape(-1, WIDTH + 1)
        read /= read[:, WIDTH:].copy()
        logits = _logits(rows, now, read, to_class, room)
        picked = logits[np.arange(len(logits)), kind[a:z].ravel()]
        np.exp(logits, out=logits)            # rows are log shares and the rest is small
        out[a:z] = (picked - np.log(logits @ _ONES[:logits.shape[1]])).reshape(-1, STRIDE)
    found = out.ravel()[:n] + m["within"].ravel().take(last.astype(np.int64) * (RANKS + 1) + following)
    rare = np.flatnonzero(following == RANKS)
    found[rare] += m["rest"].take(target[rare])
    return found.astype(np.float64) / np.log(10)


def _score(shared, n_ids: int):
    def run(batches):
        m, n_train, v_train, n_docs = shared.value
        v_all = n_train + v_train + 1
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                docs, index, sub, lengths = _read_chunk(row[:4])
                counts = np.concatenate([np.zeros(0, np.int64)] + [_unz(x["counts"], "<i8") for x in
                                                                   sorted(row[4] or (), key=lambda x: x["bucket"])])
                bounds = np.concatenate([[0], np.cumsum(docs["n"])])

                def per_doc(x):
                    return np.diff(np.concatenate([[0.0], np.cumsum(x)])[bounds])

                base = per_doc(np.log10((counts + 1) / v_all)[index]) + np.log10((n_docs + 1) / v_all)
                known = per_doc((counts > 0).astype(np.int64)[index]).round().astype(np.int64) + int(n_docs > 0)
                before, target, doc = _sequence(index, sub, lengths, docs["n"], n_ids - 1)
                score = np.bincount(doc, log10_probabilities(m, before, target, doc), minlength=len(docs))
                yield pa.RecordBatch.from_pydict({
                    "doc": pa.array(docs["doc"].astype(np.int64), mask=~docs["known"]), "held_out": pa.array(docs["held"]),
                    "n_tokens": docs["n"] + 1, "n_known": known, "train_tokens": np.full(len(docs), n_train, np.int64),
                    "base_score": base, "score": score})
    return run


def score_texts(docs: DataFrame, tokenizer: str, id: str = "doc_id", text: str = "text",
                fold: tuple[int, int] = (7, 2)) -> DataFrame:
    """Per document: ``id``, held_out, n_tokens, n_known, train_tokens, base_score, score (log10)."""
    spark = docs.sparkSession
    one = columns(docs, id, text).select(
        F.col(f"`{id}`").cast("long").alias("doc"),
        F.coalesce(crc_mod(F.col(f"`{id}`"), fold[0]) == fold[1], F.lit(False)).alias("held"), F.col(f"`{text}`").alias("text"))
    chunks = staged(one.transform(map_arrow, _chunks(tokenizer), _CHUNKS), "chunks", "none")
    n_ids = open_subwords(tokenizer).vocab + 1
    buckets = max(16, int(spark.conf.get("spark.sql.shuffle.partitions")))
    counts = staged(chunks.select("chunk", "words", "train").transform(map_arrow, 
        _word_parts(buckets), "bucket int, chunk long, words binary, train binary", 1)
        .groupBy("bucket").applyInArrow(_sum_words, _COUNTS), "word-counts")
    n_docs = (one.where(~F.col("held")).count())
    total = counts.where("chunk is null").agg(F.sum("n"), F.sum("v")).first()
    n_train, v_train = (total[0] or 0) + n_docs, (total[1] or 0) + int(n_docs > 0)
    shared = spark.sparkContext.broadcast((fit_model(chunks, n_ids), n_train, v_train, n_docs))
    of = counts.where("chunk is not null").groupBy("chunk").agg(F.collect_list(F.struct("bucket", "counts")).alias("found"))
    return (chunks.select("chunk", "docs", "index", "sub", "lengths").join(of, "chunk", "left")
            .select("docs", "index", "sub", "lengths", "found")
            .transform(map_arrow, _score(shared, n_ids), "doc long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                                               "base_score double, score double", 1).withColumnRenamed("doc", id))
