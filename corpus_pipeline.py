"""A corpus pipeline of five stages, from raw documents to packed sequences.

Each stage takes (spark, docs, sf_dir), works on all documents its predecessor
kept, and returns the columns of ``documents``; the last returns packed pieces.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ordermill.llm import buffers, mixing, near_dedup, quality_rules, queries as operators, substrings
from ordermill.llm.quality_rules import fresh_name
from ordermill.llm.storage import stored


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that fail the base rule or are more likely bad than good."""
    found, numbers, posterior = quality_rules.judged(docs)
    words, repeated = F.col(f"{numbers}.n_words"), F.col(f"{numbers}.n_repeat_words")
    good = (words >= 10) & (100 * repeated <= 20 * words) & (F.col(posterior) >= 0.5)
    return found.filter(good).select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the smallest id of each group of near copies; rows without an id stay.

    Rows are judged by their text.  Of rows with the same id and words, the first
    in the order of their texts and then of all other columns stays.
    """
    digest, nth = fresh_name(docs, "digest"), fresh_name(docs, "nth")
    kept = near_dedup.judged(docs).filter("stays and doc_id is not null").select("doc_id", F.col("digest").alias(digest)).distinct()
    rows = near_dedup.with_digest(docs.filter("doc_id is not null"), digest).join(kept, ["doc_id", digest], "left_semi")
    given = [F.col(f"`{c}`") for c in docs.columns]
    order = Window.partitionBy("doc_id", digest).orderBy("text", *[F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")])
    one = rows.withColumn(nth, F.row_number().over(order)).filter(F.col(nth) == 1).select(*given)
    return one.unionByName(docs.filter("doc_id is null"))


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove passages that an earlier document has; drop documents of which nothing is left."""
    into = "_"
    while any(c.lower().startswith(into) for c in docs.columns):
        into += "_"
    words, removed, kept = (F.col(f"{into}{c}") for c in ("n_words", "n_removed", "kept"))
    # Executors still hold memory of the stages before, so texts are cut and windows folded in smaller pieces.
    found = substrings.remove_repeats(docs, into=into, fold=5 << 20, chunk=buffers.CHUNK // 2).filter((removed == 0) | (removed < words))
    text = F.when(removed > 0, kept).otherwise(F.col("text"))
    given = [F.col(f"`{c}`") for c in docs.columns]
    return found.withColumn("text", text).withColumn("n_chars", F.length("text").cast("long")).select(*given)


def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat documents so that the languages' shares of all tokens become flatter; the labelled rows teach the domains."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id").distinct()
    labelled = docs.select("doc_id", F.col("lang").alias("domain")).join(labels, "doc_id", "left_semi")
    return mixing.mixed_documents(docs, mixing.fit_mixture(docs, labelled))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack all documents into sequences of 1024 tokens."""
    return operators.packed(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", keep_good),
    ("near_dedup", drop_near_copies),
    ("substring_dedup", drop_repeated_passages),
    ("mixing", mix_domains),
    ("packing", pack),
]

#: Near-duplicate components, label models and tokenizers have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; each result is stored and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
