"""Queries of the operators over their whole tables, each a function of (spark, sf_dir)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stoplens.session import work_dir

from .cotraining import fit_quality, score_quality
from .lattice import sample_segmentations
from .merkle import FIELDS, fold, leaf_digest, merkle_manifest, proof_digest
from .mixing import mix_sources
from .packing import pack_documents
from .paragraphs import repeated_paragraphs
from .periodic import find_runs, planted_text, strongest
from .quality_rules import quality_rules
from .secret_scan import BASE_KINDS, of_kinds, scan_secrets, span_text
from .simhash import fingerprint_hex, simhash_groups
from .tables import small_batches, table
from .topk import top_k
from .toxicity import fit_toxicity, score_toxicity
from .warc import read_archives, write_archives

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            small_batches(spark)
            return build(spark, sf_dir)

        QUERIES[name] = run
        return build

    return register


@query("op6_quality_rules")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents")).drop("failed_rules")


@query("op5_simhash")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", fingerprint_hex(F.col("fp")).alias("fingerprint"), "component_id")


@query("op10_secret_scan")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = F.col("spans")
    counts = [F.size(of_kinds(spans, (k,))).cast("bigint").alias(f"n_{k}") for k in BASE_KINDS]
    return scan_secrets(table(spark, sf_dir, "documents")).select(
        "doc_id",
        *counts,
        F.sha2(span_text(of_kinds(spans, BASE_KINDS)).cast("binary"), 256).alias("base_sha256"),
        span_text(spans).alias("spans"),
    )


@query("op2_best_fit_packing")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), ids=False).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


@query("op4_warc")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "llm-warc")
    write_archives(table(spark, sf_dir, "pages"), path)
    page = lambda urn: F.regexp_extract(urn, r"<urn:page:(-?\d+)>", 1).try_cast("bigint")
    return read_archives(spark, path, payload=False).select(
        page("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        page("refers_to_id").alias("refers_to"),
    )


@query("op1_exact_top_k")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query("op8_toxicity")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"))
    return score_toxicity(docs, model)


@query("op3_substring_dedup")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_paragraphs(table(spark, sf_dir, "documents"))


@query("op7_quality_classifier")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, views = fit_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return score_quality(views, model)


@query("op9_sentencepiece")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sample_segmentations(table(spark, sf_dir, "documents"), decode=True)
    return found.select(
        "doc_id",
        "sample",
        F.size("ids").alias("n_ids"),
        F.xxhash64("ids").alias("ids_hash"),
        "log_prob",
        "perturbed",
        "log_inclusion",
        F.xxhash64("text").alias("decoded_hash"),
    )


@query("op12_merkle_manifest")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row is checked against its proof after its text has lost its line breaks, for ids with an even CRC."""
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    told = {name: F.col(name) for name in FIELDS}
    fields = list(told.values())
    told["text"] = F.when(even, F.translate("text", "\n", "")).otherwise(F.col("text"))
    claimed = {"claimed": leaf_digest(list(told.values()))}
    found = merkle_manifest(table(spark, sf_dir, "documents"), leaf_digest(fields), keep=claimed)
    found = found.withColumn("folded_root", fold(F.col("claimed"), F.col("path")))
    return found.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        proof_digest(F.col("path")).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


@query("op13_source_mix")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents")).drop("source")


@query("op11_periodic_runs")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = find_runs(docs.withColumn("text", planted_text(F.col("doc_id"), F.col("text"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = found.withColumn("best", strongest(F.col("runs")))
    return best.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
