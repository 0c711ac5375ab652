"""The registered queries of this subpackage: thin forms of the operators over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweave.llm import brown
from tallyweave.llm.decontaminate import is_contaminated, n_hit, scan_texts
from tallyweave.llm.forest import link_vectors
from tallyweave.llm.frames import fold, table
from tallyweave.llm.mixing import mix_sources
from tallyweave.llm.pieces import decode_ids, encode_texts
from tallyweave.llm.secrets import find_secrets
from tallyweave.llm.sharding import shard_documents
from tallyweave.llm.simhash import near_duplicates
from tallyweave.llm.toxicity import score_texts, train
from tallyweave.llm.urls import Rule, judge_urls
from tallyweave.llm.variants import spelling_variants
from tallyweave.llm.warc import archive_pages
from tallyweave.llm.whitening import whiten_vectors

URL_RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)


def simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score_texts(docs, train(docs, table(spark, sf_dir, "labels")), ["doc_id"])
    return scored.select(
        "doc_id",
        (fold(F.col("doc_id")) == 0).alias("held_out"),
        F.col("toxic_score").alias("score"),
        F.when(F.col("toxic_score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )


def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    found = scan_texts(docs, items, keep=["doc_id"])
    return found.select(
        "doc_id",
        F.col("scan.n_words").cast("long").alias("n_words"),
        n_hit().alias("n_hit"),
        F.size("scan.items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("scan.items"), ",").cast("binary"), 256).alias("items_sha256"),
        is_contaminated().alias("contaminated"),
    )


def warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_pages(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def embedding_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_vectors(table(spark, sf_dir, "embeddings"))


def sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"))


def mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(table(spark, sf_dir, "documents"))
    return mixed.withColumn("mix_rate", F.round("mix_rate", 6))


def secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_assign",
        "n_access",
        "n_hex",
        "n_entropy",
        F.sha2(F.col("base_spans").cast("binary"), 256).alias("base_sha256"),
        "spans",
    )


def language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model, counts = brown.train(docs)
    scored = brown.score_texts(docs, model, counts, ["doc_id"])
    return scored.withColumn("held_out", fold(F.col("doc_id")) == 1)


def url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


def spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


def whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten_vectors(table(spark, sf_dir, "embeddings"))


def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers  # noqa: PLC0415

    model = public_tokenizers.path("piece_bpe_32k.model")
    encoded = encode_texts(table(spark, sf_dir, "documents"), model, ["doc_id"]).withColumns(
        {
            "n_tokens": F.size("ids").cast("long"),
            "ids_sha256": F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256),
        }
    )
    return decode_ids(encoded, model, ["doc_id", "n_tokens", "ids_sha256"]).select(
        "doc_id", "n_tokens", "ids_sha256", F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256")
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": simhash,
    "op2_toxicity": toxicity,
    "op3_decontamination": decontamination,
    "op4_warc": warc,
    "op5_forest": embedding_links,
    "op6_sharding": sharding,
    "op7_mixing": mixing,
    "op8_secrets": secret_scan,
    "op9_brown": language_model,
    "op10_urls": url_filter,
    "op11_variants": spelling,
    "op12_whitening": whitening,
    "op13_pieces": tokens,
}
