"""One query per operator, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path, stage
from .common import table
from .conversations import audit_conversations, conversation_digests, damage, repaired_turns
from .decontaminate import decontaminate
from .html_text import extract_text
from .mixing import mix
from .neighbours import nearest
from .pii import KINDS, find_personal_data
from .pii import listed as listed_personal
from .secret_scan import BASE_RULES, listed, scan_secrets
from .simhash import near_duplicates
from .substrings import remove_repeats
from .token_ids import read_token_files, write_token_files
from .toxicity import held_out, score_toxicity, train_on
from .url_filter import filter_urls
from .whitening import whiten

Query = Callable[[SparkSession, str], DataFrame]


def substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeats(table(spark, folder, "documents").select("doc_id", "text"))


def html_text(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    return extract_text(pages, keep=["page_id", "url"])


def mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mix(table(spark, folder, "documents").select("doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = near_duplicates(table(spark, folder, "documents").select("doc_id", "text"))
    digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    judged = decontaminate(docs, table(spark, folder, "benchmark"), keep=["doc_id"])
    digest = F.sha2(F.array_join("item_ids", ","), 256)
    return judged.select(
        "doc_id", "n_words", "n_hit", "n_items", digest.alias("items_sha256"), "contaminated"
    )


def secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = scan_secrets(table(spark, folder, "documents").select("doc_id", "text"))
    base = F.filter("secrets", lambda s: s["order"] < len(BASE_RULES))

    def count(order: int) -> Column:
        return F.size(F.filter("secrets", lambda s: s["order"] == order)).cast("long")

    counts = [count(i).alias(f"n_{r.kind}") for i, r in enumerate(BASE_RULES)]
    return found.select(
        "doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("secrets")).alias("spans")
    )


def url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url")
    return filter_urls(pages).select("page_id", "host", "path", "rule", "verdict", "pattern")


def toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = train_on(docs, table(spark, folder, "labels"))
    scored = score_toxicity(docs, model, keep=["doc_id"])
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted")


def neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return nearest(table(spark, folder, "embeddings"))


def personal_data(spark: SparkSession, folder: str) -> DataFrame:
    found = find_personal_data(table(spark, folder, "documents").select("doc_id", "text"))

    def count(kind: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    counts = [count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)]
    every = F.array_sort(F.concat("spans", "terms"))
    return found.select(
        F.col("id").cast("long").alias("doc_id"),
        *counts,
        F.sha2(listed_personal(F.col("spans")), 256).alias("base_sha256"),
        listed_personal(every).alias("spans"),
    )


def conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    rows = damage(table(spark, folder, "conversations"))
    audits = stage(audit_conversations(rows, copies="copies"), "audits")
    digests = conversation_digests(repaired_turns(rows, audits, copies="copies"))
    digests = digests.withColumnRenamed("conv_id", "_conv")
    found = audits.join(digests, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").drop("_conv")
    return found.withColumn("repaired_sha256", F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)))


def whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whiten(table(spark, folder, "embeddings"))


def token_ids(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    path = scratch_path(spark, "token-files")
    docs = table(spark, folder, "documents")
    write_token_files(docs, path, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    written = read_token_files(spark, path)
    return written.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def all_queries() -> dict[str, Query]:
    return {
        "op1_substring_dedup": substring_dedup,
        "op2_html_text": html_text,
        "op3_mixing": mixing,
        "op4_simhash": simhash,
        "op5_decontaminate": decontamination,
        "op6_secret_scan": secret_scan,
        "op7_url_filter": url_filter,
        "op8_toxicity": toxicity,
        "op9_neighbours": neighbours,
        "op10_personal_data": personal_data,
        "op11_conversation_repair": conversation_repair,
        "op12_whitening": whitening,
        "op13_token_ids": token_ids,
    }
