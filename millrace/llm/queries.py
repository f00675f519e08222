"""Registered queries of the subpackage: each operator over its whole table, and the SQL form where there is one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import automaton, decontaminate, fingerprints, html_layout, language, merkle, mixing, ngram_join, periodic_runs, repetition, secret_scan, sql_forms, token_files, toxicity
from millrace.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = dict(sql_forms.ORACLES)


def registered(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def word_tokenizer() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


@registered
def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_join(table(spark, sf_dir, "documents"))


@registered
def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "tokens")
    manifest = token_files.write_token_files(table(spark, sf_dir, "documents"), word_tokenizer(), folder)
    return token_files.read_token_files(manifest, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@registered
def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ratios = secret_scan.fit(secret_scan.labelled_samples(docs))
    found = secret_scan.secret_spans(docs, ratios)
    numbers = [secret_scan.counted(kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")]
    return found.select("doc_id", *numbers, F.sha2(secret_scan.written("base"), 256).alias("base_sha256"), secret_scan.written("spans").alias("spans"))


@registered
def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_layout.extract_text(table(spark, sf_dir, "pages").select("page_id", "html")).select("page_id", "text")


@registered
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.quality_rules(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "repeat_chars", "longest_repeat"
    )


@registered
def op6_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


@registered
def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edit_likeness(table(spark, sf_dir, "documents"))


@registered
def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = language.remainder("doc_id", 4) == 2
    learned = language.fit(docs.filter(~held_out))
    return language.identify(docs.select("doc_id", held_out.alias("held_out"), "text"), learned).drop("text")


@registered
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = language.remainder("doc_id", 3) == 1
    model = toxicity.fit(docs, labels.filter(~held_out))
    scored = toxicity.score(docs.select("doc_id", held_out.alias("held_out"), "text"), model).drop("text")
    return scored.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


@registered
def op10_tokenization_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = automaton.encode_and_decode(table(spark, sf_dir, "documents").select("doc_id", "text"), word_tokenizer())
    return coded.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(automaton.joined_ids(), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def planted_periods(docs: DataFrame) -> DataFrame:
    """doc_id and text; every tenth document by its crc32 repeats a stretch of its words up to its end."""
    digest = F.crc32(F.col("doc_id").cast("string"))
    chosen = docs.select("doc_id", "text", digest.alias("h")).withColumn("words", F.when(F.col("h") % 10 == 0, mixing.words_of()))
    n, g = F.size("words"), F.floor(F.col("h") / 10)
    first = F.expr("cast(h div 10 % size(words) as int)")
    placed = chosen.withColumn("a", F.when(n > 0, first)).withColumn("left", n - F.col("a"))
    period = placed.withColumn("p", F.when(F.col("left") > 0, 1 + F.floor(F.col("left") / (3 + g % 8))).cast("int"))
    stretch = F.slice("words", F.col("a") + 1, F.col("p"))
    again = F.slice(F.flatten(F.array_repeat(stretch, F.ceil(F.col("left") / F.col("p")).cast("int"))), F.lit(1), F.col("left"))
    changed = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), again), " ")
    return period.select("doc_id", F.when(F.col("p").isNotNull(), changed).otherwise(F.col("text")).alias("text"))


@registered
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(planted_periods(table(spark, sf_dir, "documents")))
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    named = found.select("doc_id", "runs", "collapsed", best.alias("best"))
    length = -F.col("best.less")
    return named.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), F.col("best.start").alias("start"), length.alias("length"), F.col("best.period").alias("period"),
        F.floor(length * 1000 / F.col("best.period")).alias("exponent_milli"), F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def merkle_proofs(docs: DataFrame) -> DataFrame:
    """Manifest of documents per source, with every proof checked against a leaf that is tampered with for half of them."""
    head = [merkle.written(F.col(c), c in ("source", "lang")) for c in ("doc_id", "source", "lang", "n_chars")]
    tampered = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    changed = merkle.leaf_of(*head, merkle.written(F.when(tampered, F.translate("text", "\n", "")).otherwise(F.col("text"))))
    held = merkle.manifest(docs, merkle.leaf_of(*head, merkle.written(F.col("text"))), "source", "doc_id", [changed.alias("changed")])
    proven = held.withColumn("folded_root", merkle.folded(F.col("changed"), F.col("steps")))
    return proven.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(merkle.siblings(F.col("steps")), 256).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")
    )


@registered
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_proofs(table(spark, sf_dir, "documents"))


@registered
def op13_benchmark_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = decontaminate.benchmark_hits(docs, table(spark, sf_dir, "benchmark")).select("doc_id", "n_words", "hits", "items")
    hit = F.aggregate("hits", F.lit(0).cast("bigint"), lambda n, span: n + span["last"] - span["first"])
    listed = F.sha2(F.array_join("items", ","), 256)
    return marked.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"), listed.alias("items_sha256"), (F.size("hits") > 0).alias("contaminated")
    )
