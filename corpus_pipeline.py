"""The corpus pipeline: quality filter, near-duplicate removal, decontamination, packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame that is written and reread as the next one's ``docs``. All
but the last keep the columns of ``documents``; the last returns packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airlens.llm import jaccard_join, packing, quality, tiling
from airlens.llm.queries import table, tokenizer
from airlens.llm.shared import staged


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality.keep_good(docs, quality.fit_quality(docs, table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of similar documents the one with the least id stays, once; of equal ids, the least text hash.

    Rows are told apart by id and text. A document without an id stays only if its class has no id; texts
    without words stay, once for each id and text.
    """
    gone = jaccard_join.later_copies(docs)
    tie, key, unknown = "tie", "key", "unknown"
    while {tie, key, unknown} & set(docs.columns):
        tie, key, unknown = tie + "_", key + "_", unknown + "_"
    names = [key, unknown, tie]

    def named(rows: DataFrame, id, text_hash) -> DataFrame:
        return rows.withColumns({key: F.coalesce(id.cast("long"), F.lit(0)), unknown: id.isNull(), tie: text_hash})

    gone = named(gone.select("doc", F.col("tie").alias("hash")), F.col("doc"), F.col("hash")).select(*names)
    return named(docs, F.col("doc_id"), F.xxhash64("text")).dropDuplicates(names).join(gone, names, "left_anti") \
        .select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold most of a benchmark item, in any order, go."""
    return tiling.without_benchmark(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rest, as pieces of sequences of 1024 ids."""
    return packing.pack_documents(docs, tokenizer("byte_bpe_50k.json"), end_id=2, size=1024)


STAGES = [("quality classifier", keep_quality), ("n-gram Jaccard join", drop_near_copies),
          ("benchmark decontamination", drop_benchmark), ("best-fit packing", pack)]

# trees, shingle links, tiles and subword ids have no SQL form; tests/llm checks run() by brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = staged(docs, name.replace(" ", "-"))
    return docs
