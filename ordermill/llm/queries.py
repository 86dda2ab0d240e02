"""The registered queries of the subpackage: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.llm import exact_dedup, language, lattice, mixing, near_dedup, packing, prefix_trie, quality_rules, spelling, sql, substrings, token_counts, topk, toxicity
from ordermill.llm.grams import trained_on


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.remove_repeats(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select("doc_id", F.col("_n_words").alias("n_words"), F.col("_n_removed").alias("n_removed"), F.sha2("_kept", 256).alias("kept_sha256"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), 2048)


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(documents(spark, sf_dir))


def packed(docs: DataFrame) -> DataFrame:
    """The pieces of ``docs`` with the check sum of their ids, and their places."""
    pieces = packing.cut_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), 2, 1024)
    return packing.place(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), 1024)


def op4_lattice_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    return lattice.lattice_scores(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"), held)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit_toxicity(docs.filter(trained_on("doc_id")), labels.filter(trained_on("doc_id")))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", held_out(), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def held_out(modulus: int = 3, remainder: int = 1):
    """Whether the CRC of the id as text leaves ``remainder``."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus == remainder, F.lit(False)).alias("held_out")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, numbers, posterior = quality_rules.judged(documents(spark, sf_dir).select("doc_id", "text"))
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    found = found.select("doc_id", *[F.col(f"{numbers}.{c}") for c in base], F.col(posterior).alias("posterior"))
    return found.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= 0.5))


def base_failed():
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def op7_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    usable = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    scaled = F.transform("embedding", lambda x: F.floor(256 * x.cast("double")))
    vectors = vectors.filter(F.coalesce(usable, F.lit(False))).select(F.col("vec_id").alias("id"), scaled.alias("vector"))
    return topk.exact_top_k(vectors.filter("id % 50 = 0"), vectors, 5)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = language.fit_languages(docs.filter(trained_on("doc_id")))
    return language.identify(docs.select("doc_id", "text"), model).select("doc_id", held_out(), "lang_pred", "score")


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(documents(spark, sf_dir), size=4, percent=80)


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id").distinct()
    labelled = docs.select("doc_id", F.col("lang").alias("domain")).join(labels, "doc_id", "left_semi")
    mixture = mixing.fit_mixture(docs, labelled)
    rated = mixing.with_rate(mixture.table, mixture.steps, len(mixture.model.domains), "membership", "rate")
    rated = rated.withColumn("copies", mixing.copies(F.col("rate"), F.col("doc_id")))
    names = F.array(*[F.lit(d) for d in mixture.model.domains]).cast("array<string>")
    return rated.select("doc_id", "n_tokens", names.alias("domains"), "membership", "rate", "copies", F.lit(mixture.off).alias("off_target"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(documents(spark, sf_dir))


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, copies = exact_dedup.exact_duplicates(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select("doc_id", f"{copies}.*")


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_substring_dedup": op1_substring_dedup,
        "op2_token_counts": op2_token_counts,
        "op3_best_fit_packing": op3_best_fit_packing,
        "op4_lattice_scores": op4_lattice_scores,
        "op5_toxicity": op5_toxicity,
        "op6_quality_rules": op6_quality_rules,
        "op7_exact_top_k": op7_exact_top_k,
        "op8_language_id": op8_language_id,
        "op9_near_dedup": op9_near_dedup,
        "op10_mixing": op10_mixing,
        "op11_spelling_variants": op11_spelling_variants,
        "op12_exact_dedup": op12_exact_dedup,
        "op13_prefix_trie": op13_prefix_trie,
    }


def oracle_sql() -> dict[str, str]:
    """SQL for the queries that SQL can express."""
    return {
        "op7_exact_top_k": TOP_K,
        "op11_spelling_variants": sql.SPELLING_VARIANTS,
        "op12_exact_dedup": EXACT_DUPLICATES,
        "op13_prefix_trie": sql.PREFIX_TRIE,
    }


TOP_K = """
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
  WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM scored
)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM ranked WHERE place <= 5
"""

EXACT_DUPLICATES = """
WITH keyed AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id IS NOT DISTINCT FROM min(doc_id) OVER w AS kept, text_sha256
FROM keyed WINDOW w AS (PARTITION BY text_sha256)
"""
