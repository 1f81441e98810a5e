"""I-Match document fingerprints, in DataFrame functions only.

Terms are words (runs of bytes other than ASCII white space, A-Z lower-cased).
The lexicon holds the terms whose share of documents lies in a band: neither
common nor rare. It cannot hold more than ``1 / LOW`` times the mean number of
distinct terms of a document, however many documents there are. There are ``SUBSETS``
families of randomised lexicons; a family's lexicons are nested, each keeping by its hash
every second term of the one before. In each family a text uses the sparsest
lexicon that still holds one of its terms, so texts of any length are judged on a few
terms: these are sorted and hashed, and the fingerprint lists the hashes. The
likeness of two fingerprints is the share of equal hashes.

A null text is empty. A text without lexicon terms gets the hash of the whole
text in place of the list, so it is like equal texts only. Repeated rows each get a
row; documents are in order of id (null first), then of their text, and the last one is followed
by the first. Other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airlens.llm.shared import ascii_lower, columns, staged

LOW, HIGH = 1 / 1000, 1 / 20   # band of document shares: idf from ln 20 to ln 1000
SUBSETS = 15                   # families of nested lexicons
BROADCAST_TERMS = 1 << 20      # larger lexicons, or texts at the bucket edges, are joined by shuffle
BROADCAST_BYTES = 32 << 20


def terms(text: Column) -> Column:
    """Distinct words, and the empty string, which every text has."""
    return F.array_union(F.array(F.lit("")), F.split(ascii_lower(text), "[\\x20\\x09-\\x0D]+"))


def lexicon(docs: DataFrame, text: str = "text", low: float = LOW, high: float = HIGH) -> DataFrame:
    """Terms of the band: a share of all documents from ``low`` to ``high``, two documents at least."""
    n = docs.count()
    return (docs.select(F.explode(terms(F.col(text))).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
            .where((F.col("term") != "") & (F.col("df") >= max(2, math.ceil(low * n))) & (F.col("df") <= max(2, high * n)))
            .select("term"))


def depths(term: Column) -> Column:
    """Per family the sparsest lexicon that holds the term (0 to 15: trailing zero bits of a hash), 4 bits each."""
    packed = F.lit(0).cast("long")
    for k in range(SUBSETS):
        h = F.xxhash64(term, F.lit(k)).bitwiseAND(F.lit((1 << 15) - 1))
        zeros = F.bit_count(F.bitwise_not(h).bitwiseAND(h - 1).bitwiseAND(F.lit((1 << 15) - 1)))
        packed = packed.bitwiseOR(F.shiftleft(zeros.cast("long"), 4 * k))
    return packed


def _depth(packed: Column, k: int) -> Column:
    return F.shiftright(packed, 4 * k).bitwiseAND(F.lit(15))


def deepest(packed: Column, use: Column) -> list[Column]:
    """Aggregates: per family the sparsest lexicon that holds any of a text's terms."""
    return [F.max(F.when(use, _depth(packed, k))) for k in range(SUBSETS)]


def fingerprint(ordered: Column, deepest_of: list[Column], text_hash: Column) -> Column:
    """The hash of each family as one string; ``ordered`` holds structs (term, packed depths), sorted."""
    def chosen(k: int):
        return lambda x: _depth(x["packed"], k) == deepest_of[k]

    parts = [F.lpad(F.hex(F.xxhash64(F.concat_ws(" ", F.transform(F.filter(ordered, chosen(k)), lambda x: x["term"])))),
                    16, "0") for k in range(SUBSETS)]
    return F.when(F.size(ordered) == 0, F.concat(F.lit("text:"), F.hex(text_hash))).otherwise(F.concat_ws(":", *parts))


def likeness(a: str, b: str) -> Column:
    """Share of equal hashes; a text without lexicon terms is like its equals only."""
    pairs = F.arrays_zip(F.split(a, ":").alias("x"), F.split(b, ":").alias("y"))
    equal = F.filter(pairs, lambda p: p["x"] == p["y"])
    special = F.col(a).startswith("text:") | F.col(b).startswith("text:")
    return F.when(F.col(a) == F.col(b), 1.0).when(special, 0.0).otherwise(F.size(equal) / F.lit(float(SUBSETS)))


def _range_bucket(value: Column, bounds: list[int]) -> Column:
    """How many bounds are below the value, found in two steps of about the square root of their number."""
    step = max(1, math.isqrt(len(bounds)))
    groups = [bounds[i:i + step] for i in range(0, len(bounds), step)]
    last = F.array(*[F.lit(g[-1]) for g in groups]) if groups else F.array().cast("array<long>")
    nested = F.array(*[F.array(*[F.lit(x) for x in g]) for g in groups]) if groups else None
    below = F.size(F.filter(last, lambda x: x < value))
    if nested is None:
        return F.lit(0)
    within = F.coalesce(F.size(F.filter(F.get(nested, below), lambda x: x < value)), F.lit(0))
    return F.when(value.isNull(), -1).when(below < len(groups), below * step + F.greatest(within, F.lit(0))) \
        .otherwise(len(bounds))


def with_next(docs: DataFrame, buckets: int) -> DataFrame:
    """docs (doc, text) with the following document's id, text and text hash, in order of id.

    Documents are dealt to ranges of ids, each sorted by itself; only the last row of a
    range looks up its successor, the first row of the next range.
    """
    spark = docs.sparkSession
    docs = docs.withColumn("tie", F.xxhash64("text"))
    cuts = docs.agg(F.percentile_approx("doc", [i / buckets for i in range(1, buckets)] or [0.5], 10_000)).first()[0] or []
    docs = docs.withColumn("bucket", _range_bucket(F.col("doc"), sorted(set(cuts))).cast("int"))
    # one row per range of ids
    firsts = [(r[0], r[1]) for r in docs.groupBy("bucket").agg(F.min("doc").alias("doc")).orderBy("bucket").collect()]
    order = Window.partitionBy("bucket").orderBy("doc", "tie", "text")
    out = (docs.withColumn("next_doc", F.lead("doc").over(order)).withColumn("next_tie", F.lead("tie").over(order))
           .withColumn("next_text", F.lead("text").over(order)).withColumn("is_last", F.lead(F.lit(False), 1, True).over(order)))
    if not firsts:
        return out.drop("is_last")
    after = {b: firsts[(i + 1) % len(firsts)] for i, (b, _) in enumerate(firsts)}
    edge = spark.createDataFrame([(b, a[0], a[1]) for b, a in after.items()], "at int, bucket int, doc long")
    known = [d for _, d in firsts if d is not None]
    near = docs.where(F.col("doc").isin(known) | (F.col("doc").isNull() if len(known) < len(firsts) else F.lit(False)))
    heads = (near.groupBy("bucket", "doc").agg(F.min(F.struct("tie", "text")).alias("own")))
    edge = staged(edge.alias("e").join(heads.alias("h"), (F.col("e.bucket") == F.col("h.bucket"))
                                       & F.col("e.doc").eqNullSafe(F.col("h.doc")))
                  .select("at", F.col("e.doc").alias("edge_doc"), F.col("own.tie").alias("edge_tie"),
                          F.col("own.text").alias("edge_text")), "edges")
    small = (edge.agg(F.sum(F.octet_length("edge_text"))).first()[0] or 0) <= BROADCAST_BYTES
    out = out.withColumn("at", F.when(F.col("is_last"), F.col("bucket")))
    out = out.join(F.broadcast(edge) if small else edge, "at", "left")
    for c in ("doc", "tie", "text"):
        out = out.withColumn(f"next_{c}", F.when(F.col("is_last"), F.col(f"edge_{c}")).otherwise(F.col(f"next_{c}"))) \
            .drop(f"edge_{c}")
    return out.drop("at", "is_last")


def fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: ``id``, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has its last half replaced by as much of the next document's start (see ``with_next``).
    """
    spark = docs.sparkSession
    one = columns(docs, id, text).select(F.col(f"`{id}`").cast("long").alias("doc"),
                                         F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    words = staged(lexicon(one).withColumn("packed", depths(F.col("term"))), "lexicon")
    n_words = words.count()
    words = words.union(spark.createDataFrame([("", None)], "term string, packed long"))
    if n_words <= BROADCAST_TERMS:
        words = F.broadcast(words)

    rows = with_next(one, int(spark.conf.get("spark.sql.shuffle.partitions")))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    rows = rows.withColumn("n_chars", F.char_length("text").cast("long")).withColumn("edited", F.concat(
        F.substring("text", F.lit(1), F.col("n_chars").cast("int") - half), F.substring("next_text", F.lit(1), half)))
    rows = rows.withColumn("row", F.monotonically_increasing_id()).withColumn("own", F.struct(
        "doc", "tie", "next_doc", "next_tie", "n_chars", F.sha2(F.encode("edited", "utf-8"), 256).alias("edited_sha256"),
        F.xxhash64("edited").alias("edited_tie")))
    versions = F.explode(F.array(F.struct(F.lit(True).alias("is_own"), F.col("text").alias("said")),
                                 F.struct(F.lit(False).alias("is_own"), F.col("edited").alias("said")))).alias("v")
    each = rows.select("bucket", "row", "own", versions)
    each = each.select("bucket", "row", F.when(F.col("v.is_own"), F.col("own")).alias("own"), F.col("v.is_own").alias("is_own"),
                       F.explode(terms(F.col("v.said"))).alias("term"))
    # rows of a bucket stay in its partition, so this grouping moves nothing
    in_own, in_edited = (F.col("term") != "") & F.col("is_own"), (F.col("term") != "") & ~F.col("is_own")
    entry = F.struct("term", "packed")
    kept = each.join(words, "term").groupBy("bucket", "row").agg(
        F.max(F.when((F.col("term") == "") & F.col("is_own"), F.col("own"))).alias("own"),
        F.collect_list(F.when(in_own, entry)).alias("terms"), F.collect_list(F.when(in_edited, entry)).alias("edited_terms"),
        *[m.alias(f"m{k}") for k, m in enumerate(deepest(F.col("packed"), in_own))],
        *[m.alias(f"e{k}") for k, m in enumerate(deepest(F.col("packed"), in_edited))])
    kept = kept.withColumn("terms", F.array_sort("terms")).withColumn("edited_terms", F.array_sort("edited_terms"))
    own, edited = [F.col(f"m{k}") for k in range(SUBSETS)], [F.col(f"e{k}") for k in range(SUBSETS)]
    found = staged(kept.select(
        "own.doc", "own.tie", "own.next_doc", "own.next_tie", "own.n_chars", "own.edited_sha256",
        fingerprint(F.col("terms"), own, F.col("own.tie")).alias("fingerprint"),
        fingerprint(F.col("edited_terms"), edited, F.col("own.edited_tie")).alias("edited_fingerprint")), "fingerprints")
    # equal ids with equal texts have equal fingerprints: one row of them is enough to look up
    following = found.groupBy("doc", "tie").agg(F.min("fingerprint").alias("next_fingerprint"))
    joined = found.alias("f").join(following.alias("g"), F.col("f.next_doc").eqNullSafe(F.col("g.doc"))
                                   & (F.col("f.next_tie") == F.col("g.tie")), "left")
    return joined.select(
        F.col("f.doc").alias(id), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness("fingerprint", "edited_fingerprint").alias("near_edited"),
        likeness("fingerprint", "next_fingerprint").alias("near_next"))
