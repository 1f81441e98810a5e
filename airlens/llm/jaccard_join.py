"""N-gram Jaccard join by grouped prefixes: classes of documents whose shingle sets overlap enough.

Every document becomes the set of its distinct five-word shingles (64-bit
hashes). Two documents link when ``100 * |intersection| >= threshold * |union|``.

1. Shingle frequencies over all documents give one total order: shingles of
   fewer than ``HEAVY`` documents first, by hash, then the frequent ones, rarest
   first. The order only steers the work; any order gives the same links.
2. Linked sets share a shingle among their first ``n - ceil(t n) + 1``. Documents
   with the same prefix and size form one group, and an inverted list (a *run*)
   holds the groups of a prefix shingle with the shingle's place in their prefix;
   groups without a partner of fitting size in the run, or with too little left from that
   place on for any partner, go, and equal runs count once.
3. Pairs are tested in three rounds: every set of a run against one hub of it;
   then all pairs of a short run and a few more hubs of a long one; then all
   pairs. What a round links shares a label, and later rounds only test pairs of
   different labels. So a large family of copies costs about one test a
   member instead of all pairs, and no link between different classes is lost.
   All pairs are pairs of *groups* first: they must fit in size and place (what is
   left of both sets from their first common shingle on holds all they share),
   each counts once however many runs it is in, and only then members are expanded.
   A test of two sets first compares parity
   bitmaps, which bound the symmetric difference from below; for the pairs that
   may still link, the sets are made again from the texts and intersected.
4. Components of the links are the classes.

Nulls: a null text is empty. An empty set links with nothing, not even another
empty one. Repeated rows each get a row. A null id stays null and is never a
class id unless its class holds no other id. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airlens.llm.components import components
from airlens.llm.shared import columns, map_arrow, small_batches, staged
from airlens.llm.words import U64, mix, shingle_sets

HEAVY = 32          # a shingle of so many documents is ordered last; runs longer than this get hub rounds
HEAVY_KEPT = 1 << 18  # at most so many frequent shingles are broadcast (12 bytes each)
HUBS = 8            # hubs of a long run in the second round, before all its remaining pairs are tested
PART = 256          # of the sets of a run in the last round; each pair of parts is a join key of its own
MEMBERS = 1024      # records of documents in one row
FLUSH = 1 << 20     # shingles gathered in a task before they are sent on
BITMAP = 8          # 64-bit words of a set's short bitmap
FILTER_BITS = 1 << 25  # bits of the filter that picks the texts whose sets are needed again

_BLOB = "bucket int, tokens binary, counts binary, groups binary, sizes binary, extra binary, maps binary"


def _pack(values: np.ndarray, planes: int) -> bytes:
    """Sorted integers as compressed byte planes of their differences."""
    step = np.diff(values, prepend=U64(0)).astype("<u8")
    flat = np.ascontiguousarray(step.view(np.uint8).reshape(-1, 8)[:, :planes].T).tobytes()
    return len(values).to_bytes(8, "little") + pa.compress(flat, codec="zstd", asbytes=True)


def _unpack(blob: bytes, planes: int) -> np.ndarray:
    n = int.from_bytes(blob[:8], "little")
    flat = np.frombuffer(pa.decompress(blob[8:], n * planes, codec="zstd", asbytes=True), np.uint8)
    step = np.zeros((n, 8), np.uint8)
    step[:, :planes] = flat.reshape(planes, n).T
    return np.cumsum(step.reshape(-1).view("<u8"), dtype=U64)


def _by_bucket(tokens: np.ndarray, bits: int, buckets: int) -> np.ndarray:
    """Bounds of each bucket's stretch in sorted tokens of so many bits."""
    edges = np.array([(b << bits) // buckets for b in range(buckets)] , dtype=object)
    return np.append(np.searchsorted(tokens, edges.astype(U64)), len(tokens))


def _blob_batch(rows: list[dict]) -> pa.RecordBatch:
    schema = pa.schema([("bucket", pa.int32())] + [(c, pa.binary()) for c in
                                                   ("tokens", "counts", "groups", "sizes", "extra", "maps")])
    return pa.RecordBatch.from_pylist(rows, schema)


def _count_shingles(buckets: int):
    """Per task: how many of its documents hold each shingle (first 40 bits), in buckets of the hash range."""
    def sent(parts):
        u, c = np.unique(np.concatenate(parts) >> U64(24), return_counts=True)
        at = _by_bucket(u, 40, buckets)
        for b in range(buckets):
            if at[b + 1] > at[b]:
                yield _blob_batch([{"bucket": b, "tokens": _pack(u[at[b]:at[b + 1]], 5),
                                    "counts": pa.compress(c[at[b]:at[b + 1]].astype("<u4").tobytes(),
                                                          codec="zstd", asbytes=True)}])

    def run(batches):
        parts, n = [], 0
        for batch in batches:
            for s in shingle_sets(batch.column(0)):
                parts.append(s)
                n += len(s)
                if n >= FLUSH:
                    yield from sent(parts)
                    parts, n = [], 0
        if n:
            yield from sent(parts)
    return run


def _sum_by_token(table: pa.Table, heavy: int) -> pa.Table:
    tokens, counts = [], []
    for t, c in zip(table.column("tokens").to_pylist(), table.column("counts").to_pylist()):
        tokens.append(_unpack(t, 5))
        counts.append(np.frombuffer(pa.decompress(c, 4 * len(tokens[-1]), codec="zstd", asbytes=True), "<u4"))
    t, c = np.concatenate(tokens), np.concatenate(counts).astype(np.int64)
    order = np.argsort(t, kind="stable")
    t, c = t[order], c[order]
    first = np.flatnonzero(np.append(True, t[1:] != t[:-1]))
    total = np.add.reduceat(c, first)
    keep = total >= heavy
    return pa.table({"token": t[first][keep].astype(np.int64), "df": total[keep]})


def heavy_shingles(docs: DataFrame, text: str, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles (40 bits, sorted) of at least HEAVY documents, and their counts.

    At most HEAVY_KEPT come back, so the driver and the broadcast hold a few MB
    whatever the input; a shingle left out is merely ordered by its hash.
    """
    blobs = columns(docs, text).transform(map_arrow, _count_shingles(buckets), _BLOB).select("bucket", "tokens", "counts")
    heavy = HEAVY
    top = (blobs.groupBy("bucket").applyInArrow(lambda t: _sum_by_token(t, heavy), "token long, df long")
           .orderBy(F.desc("df"), "token").limit(HEAVY_KEPT).toArrow())
    token = top.column("token").to_numpy().astype(U64)
    order = np.argsort(token)
    return token[order], top.column("df").to_numpy()[order]


def _prefix(s: np.ndarray, threshold: int, heavy, df, cells) -> np.ndarray:
    """The first n - ceil(t n) + 1 shingles of a sorted set in the common order."""
    n = len(s)
    length = n + (-threshold * n // 100) + 1
    short = s >> U64(24)
    maybe = np.flatnonzero(cells[(short >> U64(18)).astype(np.int64)])
    if not len(maybe):
        return s[:length]
    at = np.minimum(np.searchsorted(heavy, short[maybe]), len(heavy) - 1)
    hit = heavy[at] == short[maybe]
    maybe, at = maybe[hit], at[hit]
    light = np.ones(n, bool)
    light[maybe] = False
    first = s[light][:length]
    if len(first) < length:
        last = s[maybe][np.lexsort((s[maybe], df[at]))]
        first = np.concatenate([first, last[:length - len(first)]])
    return first


def _parity(s: np.ndarray, bits: int) -> bytes:
    """Bit k: whether an odd number of elements ends in k. Two maps differ in at most |A xor B| bits."""
    odd = np.bincount((s & U64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def _wide(s: np.ndarray) -> bytes:
    """A parity map of about one bit an element, a power of two."""
    return _parity(s, max(256, 1 << int(len(s)).bit_length()))


def _may_link(threshold: int):
    """Of candidate pairs (a, b, na, nb, xa, xb) those whose maps leave a link possible."""
    ones = np.array([bin(i).count("1") for i in range(256)], np.uint8)

    def folded(x: bytes, size: int) -> np.ndarray:
        return np.bitwise_xor.reduce(np.frombuffer(x, np.uint8).reshape(-1, size), axis=0)

    def run(batches):
        for batch in batches:
            keep = []
            for na, nb, xa, xb in zip(*(batch.column(k).to_pylist() for k in range(2, 6))):
                size = min(len(xa), len(xb))
                differ = int(ones[folded(xa, size) ^ folded(xb, size)].sum())
                keep.append(differ * (100 + threshold) <= (100 - threshold) * (na + nb))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


def _links(threshold: int):
    """Of pairs (a, b, sa, sb) with packed sets those that link."""
    def run(batches):
        for batch in batches:
            for one in small_batches([batch], 256):
                keep, last, sa = [], None, None
                for a, xa, xb in zip(*(one.column(k).to_pylist() for k in (0, 2, 3))):
                    if a != last:
                        last, sa = a, _unpack(xa, 6)
                    sb = _unpack(xb, 6)
                    both = len(np.intersect1d(sa, sb, assume_unique=True))
                    keep.append(100 * both >= threshold * (len(sa) + len(sb) - both))
                yield one.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


def _set_id(s: np.ndarray, salt: int) -> int:
    with np.errstate(over="ignore"):
        return int(mix(mix(s ^ U64(salt)).sum(dtype=U64) + U64(len(s))).astype(np.int64))


_MEMBER = np.dtype([("group", "<i8"), ("node", "<i8"), ("check", "<i8"), ("n", "<i8"),
                    ("doc", "<i8"), ("known", "?"), ("tie", "<i8"), ("bits", "V%d" % (8 * BITMAP)), ("wide", "<i8")])


def _prefix_lists(buckets: int, threshold: int, shared):
    """Per task: prefix shingles with their groups, in buckets, and a record of every document, in no bucket."""
    def sent(tokens, groups, members, maps):
        for at in range(0, len(members), MEMBERS):
            rows = np.array(members[at:at + MEMBERS], _MEMBER)
            yield _blob_batch([{"extra": pa.compress(rows.tobytes(), codec="zstd", asbytes=True),
                                "counts": len(rows).to_bytes(8, "little"), "maps": b"".join(maps[at:at + MEMBERS])}])
        if tokens:
            sizes = np.fromiter((g[1] for g in groups.values()), np.int64, len(groups))
            names = np.fromiter(groups.keys(), np.int64, len(groups))
            index = np.repeat(np.arange(len(tokens)), [len(t) for t in tokens]).astype("<u4")
            place = np.concatenate([np.arange(len(t)) for t in tokens])
            t = np.concatenate(tokens) >> U64(16)
            order = np.argsort(t, kind="stable")
            t, index, place = t[order], index[order], place[order].astype("<u4")
            at = _by_bucket(t, 48, buckets)
            for b in range(buckets):
                if at[b + 1] > at[b]:
                    used, local = np.unique(index[at[b]:at[b + 1]], return_inverse=True)
                    yield _blob_batch([{"bucket": b, "tokens": _pack(t[at[b]:at[b + 1]], 6),
                                        "sizes": sizes[used].astype("<i8").tobytes(),
                                        "groups": names[used].astype("<i8").tobytes() + local.astype("<u4").tobytes(),
                                        "maps": pa.compress(place[at[b]:at[b + 1]].tobytes(), codec="zstd", asbytes=True)}])

    def run(batches):
        heavy, df = shared.value
        cells = np.zeros(1 << 22, bool)
        cells[(heavy >> U64(18)).astype(np.int64)] = True
        tokens, groups, members, maps, n = [], {}, [], [], 0
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for doc, tie, s in zip(ids, batch.column(2).to_pylist(), shingle_sets(batch.column(1))):
                group = 0
                if len(s):
                    first = _prefix(s, threshold, heavy, df, cells)
                    group = _set_id(first, 0x51ED27 + len(s))
                    if group not in groups:
                        groups[group] = (first, len(s))
                        tokens.append(first)
                        n += len(first)
                maps.append(_wide(s))
                members.append((group, _set_id(s, 1), _set_id(s, 2), len(s), doc or 0, doc is not None, tie,
                                _parity(s, 64 * BITMAP), len(maps[-1])))
                if n >= FLUSH or len(members) >= FLUSH // 64:
                    yield from sent(tokens, groups, members, maps)
                    tokens, groups, members, maps, n = [], {}, [], [], 0
        if members:
            yield from sent(tokens, groups, members, maps)
    return run


_RECORDS = "doc long, tie long, n long, node long, check long, grp long, bits array<long>, wide binary"


def _records(batches):
    """The records of documents, a row each."""
    for batch in small_batches(batches, 1):
        m = np.frombuffer(pa.decompress(batch.column(0)[0].as_py(), int.from_bytes(batch.column(1)[0].as_py(), "little")
                                        * _MEMBER.itemsize, codec="zstd", asbytes=True), _MEMBER)
        wide, at = batch.column(2)[0].as_py(), np.concatenate([[0], np.cumsum(m["wide"])]).tolist()
        bits = np.frombuffer(m["bits"].tobytes(), "<i8")
        yield pa.RecordBatch.from_arrays([
            pa.array(m["doc"].astype(np.int64), mask=~m["known"]), pa.array(m["tie"].astype(np.int64)), pa.array(m["n"].astype(np.int64)),
            pa.array(m["node"].astype(np.int64)), pa.array(m["check"].astype(np.int64)), pa.array(m["group"].astype(np.int64)),
            pa.ListArray.from_arrays(np.arange(0, BITMAP * len(m) + 1, BITMAP, dtype=np.int32), pa.array(bits)),
            pa.array([wide[i:j] for i, j in zip(at[:-1], at[1:])], pa.binary())],
            ["doc", "tie", "n", "node", "check", "grp", "bits", "wide"])


def _runs(table: pa.Table, threshold: int) -> pa.Table:
    """Of one bucket: distinct runs of two or more groups with a partner of fitting size.

    ``place`` is where the run's shingle stands in the group's prefix, the first of them where equal runs are one.
    """
    token, group, size, place = [], [], [], []
    for t, g, z, p in zip(*(table.column(k).to_pylist() for k in ("tokens", "groups", "sizes", "maps"))):
        k = len(z) // 8
        token.append(_unpack(t, 6))
        local = np.frombuffer(g, "<u4", offset=8 * k)
        group.append(np.frombuffer(g, "<i8", k)[local])
        size.append(np.frombuffer(z, "<i8")[local])
        place.append(np.frombuffer(pa.decompress(p, 4 * len(local), codec="zstd", asbytes=True), "<u4").astype(np.int64))
    run = grp = first_place = np.empty(0, np.int64)
    if token:
        t, g, z, p = map(np.concatenate, (token, group, size, place))
        order = np.argsort(t, kind="stable")
        t, g, z, p = t[order], g[order], z[order], p[order]
        again = np.append(False, t[1:] == t[:-1])
        keep = again | np.append(again[1:], False)
        t, g, z, p = t[keep], g[keep], z[keep], p[keep]
        order = np.lexsort((g, z, t))
        t, g, z, p = t[order], g[order], z[order], p[order]
        keep = np.append(True, (t[1:] != t[:-1]) | (g[1:] != g[:-1]))[:len(t)]
        t, g, z, p = t[keep], g[keep], z[keep], p[keep]
        if len(t):
            # what is left from here on must reach the overlap with the smallest set that may fit
            first = np.flatnonzero(np.append(True, t[1:] != t[:-1]))
            smallest = np.repeat(z[first], np.diff(np.append(first, len(t))))
            keep = (100 + threshold) * (z - p) >= threshold * (z + np.maximum(smallest, -(-threshold * z // 100)))
            t, g, z, p = t[keep], g[keep], z[keep], p[keep]
        near = (t[1:] == t[:-1]) & (100 * z[:-1] >= threshold * z[1:])  # neighbours by size
        keep = (np.append(False, near) | np.append(near, False))[:len(t)]
        t, g, p = t[keep], g[keep], p[keep]
        if len(t):
            first = np.flatnonzero(np.append(True, t[1:] != t[:-1]))
            with np.errstate(over="ignore"):
                name = mix(np.add.reduceat(mix(g.astype(U64)), first))
            name = np.repeat(name, np.diff(np.append(first, len(t))))
            order = np.lexsort((p, g, name))
            name, g, p = name[order], g[order], p[order]
            once = np.append(True, (name[1:] != name[:-1]) | (g[1:] != g[:-1]))
            run, grp, first_place = name[once].astype(np.int64), g[once], p[once].astype(np.int64)
    return pa.table({"run": run, "grp": grp, "place": first_place})


def _all_pairs(rows: DataFrame) -> DataFrame:
    """Each pair of rows (run, k: rows of the run, a, n, la, xa) of a run once, the second as b, m, lb, xb.

    A run's rows are dealt to parts of about PART, and each pair of parts meets under a key of its own.
    """
    rows = rows.withColumn("parts", F.ceil(F.col("k") / PART)).withColumn("part", F.expr("pmod(xxhash64(a, 17), parts)"))
    left = rows.select("run", F.col("part").alias("p"), F.expr("explode(sequence(part, parts - 1))").alias("q"), "a", "n", "la", "xa")
    right = rows.select("run", F.expr("explode(sequence(0, part))").alias("p"), F.col("part").alias("q"),
                        F.col("a").alias("b"), F.col("n").alias("m"), F.col("la").alias("lb"), F.col("xa").alias("xb"))
    return left.join(right, ["run", "p", "q"]).where("p < q or a < b")


def _expanded(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """Pairs of groups (a, b; a group's own pairs where a = b) as pairs of their sets with different labels.

    ``members`` has grp, parts, part, node, n, label, bits; a large group lies in parts, each with a join key of its own.
    """
    parts = members.select("grp", "parts").distinct()
    for side in ("a", "b"):
        other = "b" if side == "a" else "a"
        keep = [other] if side == "a" else [c for c in pairs.columns if c not in ("a", "b")] + [other]
        own = members.select("grp", "part", *[F.col(c).alias(f"{c}_{side}") for c in ("node", "n", "label", "bits")])
        pairs = (pairs.join(parts, pairs[side] == parts["grp"]).drop("grp").withColumn("part", F.expr("explode(sequence(0, parts - 1))"))
                 .withColumnRenamed(side, "grp").join(own, ["grp", "part"])
                 .select(F.col("grp").alias(side), *keep, *[f"{c}_{side}" for c in ("node", "n", "label", "bits")]))
    return pairs.where("label_a <> label_b and (a <> b or node_a < node_b)")


def _sets_of(shared):
    """(node, packed set) of the documents whose id passes the filter."""
    def run(batches):
        bits = shared.value
        for batch in batches:
            slot = _slots(batch.column(0))
            hit = pa.array((bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1)
            for some in small_batches([batch.filter(hit)], 256):
                node, packed = [], []
                for s in shingle_sets(some.column(1)):
                    node.append(_set_id(s, 1))
                    packed.append(_pack(s >> U64(16), 6))
                yield pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(packed, pa.binary())], ["node", "s"])
    return run


def _slots(ids: pa.Array) -> np.ndarray:
    return ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) & (FILTER_BITS - 1)


def _id_filter(ids: DataFrame) -> np.ndarray:
    """Bits of the ids modulo FILTER_BITS: bounded, whatever their number; the exact join follows."""
    words = (ids.select((F.coalesce("doc", F.lit(0)).bitwiseAND(FILTER_BITS - 1)).alias("slot"))   # null as in _slots
             .groupBy((F.shiftright("slot", 5)).alias("w"))
             .agg(F.expr("bit_or(shiftleft(1L, cast(slot & 31 as int)))").alias("v")).toArrow())
    out = np.zeros(FILTER_BITS // 32, np.uint32)
    out[words.column("w").to_numpy()] = words.column("v").to_numpy().astype(np.uint32)
    return out.view(np.uint8)


def jaccard_classes(docs: DataFrame, id: str = "doc_id", text: str = "text", threshold: int = 75) -> DataFrame:
    """One row per document: ``id``, n_shingles, component_id (least id reachable by links).

    ``threshold`` is the least Jaccard similarity of a link in per cent. The id is a long.
    """
    return _classes(docs, id, text, threshold).select(
        F.col("doc").alias(id), F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc")).alias("component_id"))


def later_copies(docs: DataFrame, id: str = "doc_id", text: str = "text", threshold: int = 75) -> DataFrame:
    """(doc, tie) of the documents of a class but its first by id (null last), then ``tie``, the xxhash64 of the text."""
    rows = staged(_classes(docs, id, text, threshold).where("n > 0").select(
        F.struct(F.col("doc").isNull().alias("unknown"), "doc", "tie").alias("own"), "label"), "classes")
    first = rows.groupBy("label").agg(F.min("own").alias("first"))
    return rows.join(first, "label").where("own > first").select("own.doc", "own.tie").distinct()


def _classes(docs: DataFrame, id: str, text: str, threshold: int) -> DataFrame:
    """One row per document: doc, tie, n, label (of its class), component_id."""
    spark = docs.sparkSession
    docs = columns(docs, id, text).select(F.col(f"`{id}`").cast("long").alias("doc"), F.col(f"`{text}`").alias("text"),
                                          F.xxhash64(F.col(f"`{text}`")).alias("tie"))
    buckets = max(16, 2 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    shared = spark.sparkContext.broadcast(heavy_shingles(docs, "text", buckets))
    # records pass by the buckets: a group with a third of all documents would be one task's
    lists = staged(docs.transform(map_arrow, _prefix_lists(buckets, threshold, shared), _BLOB), "prefixes")
    members = lists.where("bucket is null").select("extra", "counts", "maps").transform(map_arrow, _records, _RECORDS)
    runs = staged(lists.where("bucket is not null").select("bucket", "tokens", "groups", "sizes", "maps").groupBy("bucket")
                  .applyInArrow(lambda t: _runs(t, threshold), "run long, grp long, place long"), "runs")
    distinct = (members.where("n > 0").groupBy("node")
                .agg(F.min("doc").alias("doc"), F.min("check").alias("low"), F.max("check").alias("high"),
                     F.min(F.struct("n", "grp", "bits", "wide")).alias("own")))
    distinct = staged(distinct.select("node", "doc", F.expr(
        "if(low = high, own.n, raise_error('two shingle sets share a 64-bit name: change the salt of _set_id'))")
        .alias("n"), "own.grp", "own.bits", "own.wide"), "nodes")

    runs = runs.groupBy("run", "grp").agg(F.min("place").alias("place"))
    sets = distinct.select("grp", "node", "n")
    within = distinct.groupBy("grp").agg(F.count("*").alias("k")).where("k > 1").select(
        F.col("grp").alias("run"), "grp", F.lit(0).cast("long").alias("place"))
    live = staged(runs.union(within).groupBy("run", "grp").agg(F.min("place").alias("place")).join(sets, "grp")
                  .select("run", "grp", "place", "node", "n"), "lists")

    # sizes, and what is left from the common shingle on: all they can share if it is their first
    def fits(place: str, place_too: str) -> str:
        return (f"100 * least(n, m) >= {threshold} * greatest(n, m) and "
                f"{100 + threshold} * least(n - {place}, m - {place_too}) >= {threshold} * (n + m)")

    labels, tested, shingles = None, None, None

    def labelled(rows: DataFrame) -> DataFrame:
        if labels is None:
            return rows.withColumn("label", F.col("node"))
        return rows.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))

    def fetched(pairs: DataFrame) -> DataFrame:
        """The sets of all nodes of the pairs; those not yet at hand are made from the texts."""
        need = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
        if shingles is not None:
            need = need.join(shingles.select("node"), "node", "left_anti")
        need = staged(distinct.join(need, "node", "left_semi").select("node", "doc"), "needed")
        if shingles is not None and need.isEmpty():
            return shingles
        picked = spark.sparkContext.broadcast(_id_filter(need))
        made = (docs.transform(map_arrow, _sets_of(picked), "node long, s binary").join(need, "node", "left_semi")
                .dropDuplicates(["node"]))
        made = staged(made, "sets", "none")
        return made if shingles is None else shingles.union(made)

    def tried(pairs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
        """(the pairs intersected now, those of them that link); pairs that the maps rule out may come again."""
        nonlocal shingles
        new = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        if tested is not None:
            new = new.join(tested, ["a", "b"], "left_anti")
        of = distinct.select("node", "n", "wide")
        maps = (new.join(of.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("wide").alias("xa")), "a")
                .join(of.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("wide").alias("xb")), "b")
                .select("a", "b", "na", "nb", "xa", "xb"))
        maybe = staged(maps.transform(map_arrow, _may_link(threshold), "a long, b long"), "maybe")
        if maybe.isEmpty():
            return maybe, None
        shingles = fetched(maybe)
        sa = shingles.select(F.col("node").alias("a"), F.col("s").alias("sa"))
        sb = shingles.select(F.col("node").alias("b"), F.col("s").alias("sb"))
        both = maybe.join(sa, "a").join(sb, "b").select("a", "b", "sa", "sb")
        return maybe, staged(both.transform(map_arrow, _links(threshold), "a long, b long"), "links")

    def relabelled(links: DataFrame) -> DataFrame:
        edges = links if labels is None else links.join(
            labels.select(F.col("node").alias("a"), F.col("label").alias("la")), "a", "left").join(
            labels.select(F.col("node").alias("b"), F.col("label").alias("lb")), "b", "left").select(
            F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b"))
        new = components(edges)
        if labels is None:
            return new
        on = new.select(F.col("node").alias("label"), F.col("label").alias("next"))
        old = labels.join(on, "label", "left").select("node", F.coalesce("next", "label").alias("label"))
        return staged(old.union(new.join(labels, "node", "left_anti")), "labels")

    for turn in range(3):
        rows = labelled(live)
        picks = [f"min_by(struct(node, label, n, place), xxhash64(node, {k}))" for k in ([0] if turn == 0 else range(1, HUBS + 1))]
        per_run = rows.groupBy("run").agg(
            F.count("*").alias("k"), F.min("label").alias("low"), F.max("label").alias("high"),
            F.expr(f"array_distinct(array({', '.join(picks)}))").alias("hubs")).where("low <> high").drop("low", "high")
        live = staged(rows.join(per_run, "run").select("run", "k", "grp", "place", "node", "n", "label", "hubs"), "lists")
        if live.isEmpty():
            break
        hubs = (live.where(f"k > {HEAVY}" if turn else "true").select("node", "n", "label", "place", F.explode("hubs").alias("hub"))
                .where("node <> hub.node and label <> hub.label")
                .withColumn("m", F.col("hub.n")).where(fits("place", "hub.place"))
                .select(F.col("node").alias("a"), F.col("hub.node").alias("b")))
        if turn:
            # all pairs left: of short runs now, of long ones in the last round; groups first
            whole = live if turn == 2 else live.where(f"k <= {HEAVY}")
            differ = " + ".join(f"bit_count({{0}}[{i}] ^ {{1}}[{i}])" for i in range(BITMAP))
            # |A xor B| is at most (1-t)/(1+t) of |A|+|B| for a link, and at least the bits that differ
            near = f"({differ}) * {100 + threshold} <= {100 - threshold} * ({{2}} + {{3}})"
            # the place in the prefix, and the map of a group's only set (most groups have one)
            groups = whole.join(distinct.select("node", "bits"), "node").groupBy("run", F.col("grp").alias("a")).agg(
                *[F.first(c).alias(c) for c in ("k", "n")], F.struct(F.min("label").alias("low"), F.max("label").alias("high")).alias("la"),
                F.struct(F.first("place").alias("place"), F.expr("if(min(node) = max(node), first(bits), null)").alias("bits")).alias("xa"))
            several = groups.where("la.low <> la.high").select("a", F.col("a").alias("b"))
            pairs = (_all_pairs(groups).where("la <> lb or la.low <> la.high").where(fits("xa.place", "xb.place"))
                     .where(f"coalesce({near.format('xa.bits', 'xb.bits', 'n', 'm')}, true)")
                     .select("a", "b").union(several).distinct())
            of = distinct.join(labelled(distinct.select("node")), "node")
            sizes = distinct.groupBy("grp").agg(F.ceil(F.count("*") / PART).alias("parts"))
            own = of.join(sizes, "grp").withColumn("part", F.expr("pmod(xxhash64(node, 19), parts)"))
            all_left = (_expanded(staged(pairs, "group-pairs"), own).where(near.format("bits_a", "bits_b", "n_a", "n_b"))
                        .select(F.col("node_a").alias("a"), F.col("node_b").alias("b")))
            hubs = all_left if turn == 2 else hubs.union(all_left)
        new, links = tried(hubs)
        tested = new if tested is None else tested.union(new)
        if links is not None and not links.isEmpty():
            labels = relabelled(links)
        live = live.where(f"k > {HEAVY}" if turn else "true").select("run", "grp", "place", "node", "n")

    named = members.select("doc", "tie", "n", "node")
    if labels is not None:
        # a hot node (many equal sets) is one row of the table of classes; its documents join it
        of = distinct.select("node", "doc").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        least = of.groupBy("label").agg(F.min("doc").alias("component_id"))
        of = of.join(least, "label").select("node", "label", "component_id")
    else:
        of = distinct.select("node", F.col("node").alias("label"), F.col("doc").alias("component_id"))
    return named.join(of, "node", "left").select("doc", "tie", "n", "label", "component_id")
