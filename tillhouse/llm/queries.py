"""The operators on the sample tables, with production parameters, and the digests that describe their results."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

import public_tokenizers
import tillhouse
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tillhouse.functions.materialize import scratch_path, stored
from tillhouse.llm import (
    chat_format,
    decontaminate,
    filter_audit,
    lm_scoring,
    packing,
    phrases,
    quality_classifier,
    quality_rules,
    secret_scan,
    sharding,
    simhash,
    site_tree,
    warc,
)
from tillhouse.llm.common import held_out, table

TOKENIZER = "byte_bpe_50k.json"


def reach_package(spark: SparkSession) -> None:
    """Let Python workers of this machine find the package where it isn't installed."""
    root = str(Path(tillhouse.__file__).resolve().parent.parent)
    own = spark.sparkContext.environment
    if root not in own.get("PYTHONPATH", "").split(":"):
        own["PYTHONPATH"] = ":".join(filter(None, [root, own.get("PYTHONPATH")]))


def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return quality_rules.apply_rules(docs).select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op2_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    first = F.col("id") == 0
    marked = spark.range(2).select(
        F.lit(-1).cast(rows.schema["conv_id"].dataType).alias("conv_id"),
        F.col("id").cast(rows.schema["turn"].dataType).alias("turn"),
        F.when(first, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    template = chat_format.Template()
    formatted = chat_format.format_conversations(rows.unionByName(marked), template)
    turns = template.read_turns(F.col("formatted"))
    read = formatted.select(
        F.col("conversation").alias("conv_id"),
        turns.alias("turns"),
        template.read_learned(F.col("segments")).alias("learned"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "valid",
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2(F.col("learned").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
        "valid",
    )


def op3_sharding(spark: SparkSession, folder: str) -> DataFrame:
    assigned = sharding.assign_shards(table(spark, folder, "documents").select("doc_id", "text"), 16)
    return assigned.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op4_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return lm_scoring.score_texts(docs, ~held_out(docs["doc_id"], 5, 1)).select(
        "doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op5_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "labels")
    model = quality_classifier.learn(docs, labels, ~held_out(labels["doc_id"], 4, 2), "quality")
    scored = quality_classifier.score_quality(docs, model)
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id"), 4, 2).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


def op6_secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_scan.scan_secrets(table(spark, folder, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["kind"] != secret_scan.ENTROPY)

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "row.doc_id",
        *(count(shape.kind) for shape in secret_scan.SHAPES),
        F.sha2(secret_scan.joined(base).cast("binary"), 256).alias("base_sha256"),
        secret_scan.joined(F.col("spans")).alias("spans"),
    )


def op7_warc(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    archives = scratch_path(spark, "warc")
    index = stored(warc.write_archives(pages, archives), "warc-index")
    kind = pages.schema["page_id"].dataType
    return warc.read_records(index, archives, payload=False).select(
        F.col("record_id").cast(kind).alias("page_id"),
        "payload_bytes",
        F.col("digest").alias("payload_digest"),
        "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"),
    )


def op8_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs, benchmark = table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "benchmark")
    found = decontaminate.find_contamination(docs, benchmark, keep=["doc_id"])
    return found.select(
        "row.doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op9_packing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return describe_pieces(packing.pack_texts(docs, public_tokenizers.path(TOKENIZER)))


def describe_pieces(pieces: DataFrame) -> DataFrame:
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op10_simhash(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return simhash.near_duplicates(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op11_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    found = site_tree.extract_main_text(pages)
    text = F.col("main_text")
    return found.select("page_id", "url", text.alias("text"), F.length(text).cast("long").alias("n_chars"))


def op12_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    return filter_audit.audit_filters(docs, labels)


def op13_phrases(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.mine_collocations(table(spark, folder, "documents"))


def _reaching(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        reach_package(spark)
        return query(spark, folder)

    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: _reaching(query)
    for query in (
        op1_quality_rules,
        op2_chat_formatting,
        op3_sharding,
        op4_lm_scoring,
        op5_quality_classifier,
        op6_secret_scans,
        op7_warc,
        op8_decontamination,
        op9_packing,
        op10_simhash,
        op11_html_extraction,
        op12_filter_audit,
        op13_phrases,
    )
}
