"""The registered query of each operator, over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airlens.llm import attention_lm, bpe, chat_format, html_text, imatch, infill, jaccard_join, packing, quality, tiling, token_counts, token_files, whitening
from airlens.llm.shared import new_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str) -> str:
    """Place of a public tokenizer file, the same on every node."""
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = new_folder(spark, "token-files")
    token_files.write_tokens(table(spark, sf_dir, "documents"), out, tokenizer("word_bpe_49k.json"), end_id=1)
    return token_files.read_documents(spark, out)


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score_quality(docs, quality.fit_quality(docs, table(spark, sf_dir, "labels")))


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -1, whose texts hold the template's own control strings."""
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)],
                                  "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(extra)
    out = new_folder(spark, "conversations")
    chat_format.format_conversations(rows).write.parquet(out)
    return chat_format.read_digests(spark, out)


def op4_attention_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attention_lm.score_texts(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


def op5_benchmark_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiling.benchmark_matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"), limit=2048)


def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_classes(table(spark, sf_dir, "documents"))


def op8_imatch_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.fingerprints(table(spark, sf_dir, "documents"))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), end_id=2, size=1024)


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_pages(table(spark, sf_dir, "pages"))


def op11_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids of every text and of the text decoded from them."""
    path = tokenizer("word_bpe_49k.json")
    coded = bpe.decode_ids(bpe.encode_texts(table(spark, sf_dir, "documents"), path), path)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the transformed texts and of the texts rebuilt from them."""
    made = infill.fill_in_middle(table(spark, sf_dir, "documents"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(infill.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"), count=16)


QUERIES = {f.__name__: f for f in (
    op1_token_files, op2_quality_classifier, op3_chat_format, op4_attention_lm, op5_benchmark_tiling,
    op6_token_counts, op7_ngram_jaccard_join, op8_imatch_fingerprints, op9_best_fit_packing, op10_html_text,
    op11_bpe_round_trip, op12_fill_in_middle, op13_embedding_whitening)}

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_ESCAPED = r"regexp_replace({}, '([\[<])(\\*)(/?(?:INST\]|s>))', '\1\2\\\3', 'g')"

# DuckDB SQL of the operators that SQL can express, over whole tables
ORACLE: dict[str, str] = {
    "op3_chat_format": f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, t, r, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) v(t, r)
),
e AS (
  SELECT *, role = 'assistant' AS learned,
         length({_ESCAPED.format("replace(replace(role, chr(92), chr(92) || chr(92)), chr(10), chr(92) || 'n')")})
         + 1 + length({_ESCAPED.format("text")}) + CASE WHEN role = 'assistant' THEN 7 ELSE 13 END AS size
  FROM c
),
g AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS said,
         string_agg(CASE WHEN learned THEN text ELSE '' END, '' ORDER BY turn, role, text) AS loss, sum(size) AS size
  FROM e GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
       CAST(size AS BIGINT) AS formatted_chars, false AS rewrites_history
FROM g""",
    "op12_fill_in_middle": """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n,
         sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digest FROM documents
),
h AS (
  SELECT *, CAST('0x' || digest[1:8] AS BIGINT) % (n + 1) AS a, CAST('0x' || digest[9:16] AS BIGINT) % (n + 1) AS b,
         CAST('0x' || digest[17:24] AS BIGINT) % 100 AS h3, CAST('0x' || digest[25:32] AS BIGINT) % 100 AS h4 FROM d
),
c AS (
  SELECT *, CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 >= 90 THEN 'plain'
                 WHEN h4 < 20 THEN 'spm' ELSE 'psm' END AS form, least(a, b) AS low, greatest(a, b) AS high FROM h
),
p AS (
  SELECT *, substring(text, 1, low) AS prefix, substring(text, low + 1, high - low) AS middle, substring(text, high + 1) AS suffix FROM c
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN low END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN high - low END AS middle_chars,
       sha256(CASE form WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle ELSE text END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p""",
    "op7_ngram_jaccard_join": f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'),
                                    '[^\x20\x09-\x0D]+') AS words FROM documents
),
s AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN []
                      WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
                      ELSE list_distinct([array_to_string(words[i:i + 4], ' ') FOR i IN range(1, len(words) - 3)]) END AS own
  FROM w
),
n AS (SELECT doc_id, CAST(len(own) AS BIGINT) AS n FROM s),
u AS (SELECT doc_id, unnest(own) AS shingle FROM s),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k
  FROM u a JOIN u b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL
),
links AS (
  SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 75 * (x.n + y.n - k)
),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM n UNION SELECT r.doc_id, e.b FROM reach r JOIN edges e ON e.a = r.other
)
SELECT r.doc_id, n.n AS n_shingles, min(r.other) AS component_id
FROM reach r JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id, n.n""",
}
