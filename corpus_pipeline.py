"""Corpus pipeline: five stages over documents, each written as Parquet and read again by the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import automaton, mixing, ngram_join, repetition, secret_scan
from millrace.llm.queries import table, word_tokenizer
from millrace.session import materialise

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the repetition rules keep; null and empty texts are rejected. Extra columns go."""
    return repetition.quality_rules(docs.select(*COLUMNS)).filter("kept").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of linked documents: the smallest doc_id, then the smallest hash of the text.

    Rows without doc_id come last in their group. Ids play no other part: rows with one id, or with none,
    that belong to different groups stay. Texts without words link to nothing; of those, rows alike in
    doc_id and text are one group. Of rows alike in doc_id and text the first by its other columns stays.
    """
    groups = ngram_join.ngram_join(docs, keyed=True)
    # plain keys for the join and the grouping: the texts are shuffled once
    keys, named = ["key", "nameless", "text_key"], [F.coalesce("doc_id", F.lit(0).cast("bigint")).alias("key"), F.col("doc_id").isNull().alias("nameless")]
    wordless = F.col("n_shingles") == 0
    own = groups.select(*named, "text_key", "class_id", F.when(wordless, F.struct("doc_id", "text_key")).alias("alone"))
    firsts = own.groupBy("class_id", "alone").agg(F.min(F.struct("nameless", "key", "text_key")).alias("first")).select("first.*")
    rest = [c for c in COLUMNS if c != "doc_id"]
    rows = docs.select(*named, F.xxhash64("text").alias("text_key"), *rest)
    kept = rows.join(firsts, keys, "left_semi").groupBy(*keys).agg(F.min(F.struct(*rest)).alias("row"))
    return kept.select(F.when(~F.col("nameless"), F.col("key")).alias("doc_id"), *[F.col(f"row.{c}").alias(c) for c in rest])


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, every secret replaced by a mark and n_chars counted anew; null texts stay null."""
    ratios = secret_scan.fit(secret_scan.labelled_samples(docs))
    found = secret_scan.secret_spans(docs.select(*COLUMNS), ratios)
    clean = found.withColumn("text", secret_scan.redacted(F.col("text"), F.col("spans")))
    return clean.withColumn("n_chars", F.when(F.size("spans") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, in the order of its slots: a row for each pass that takes words of one.

    A pass that takes a part of a document cuts it behind the last word taken and counts n_chars anew. Documents of
    which nothing is taken go, those without words among them. Rows alike are documents of their own.
    """
    taken = mixing.mixed_texts(docs.select(*COLUMNS))
    n_chars = F.when(F.col("cut"), F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return taken.withColumn("n_chars", n_chars).select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and a digest of what they decode to."""
    coded = automaton.encode_and_decode(docs.select(*COLUMNS), word_tokenizer())
    return coded.select("doc_id", "lang", "source", "n_chars", F.size("ids").cast("bigint").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality),
    ("near duplicates", near_duplicates),
    ("secret scans", secrets),
    ("mixture", mixture),
    ("tokens", tokens),
]

#: The fitted models, suffix arrays and tokens of the stages have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
