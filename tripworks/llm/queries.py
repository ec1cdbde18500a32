"""One registered query per corpus operator, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tripworks.llm import (
    addresses,
    audit,
    chat,
    decontaminate,
    html,
    language,
    manifest,
    mixture,
    neighbours,
    privacy,
    repeats,
    simhash,
    tokens,
)
from tripworks.llm.frames import read

Query = Callable[[SparkSession, str], DataFrame]


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(read(spark, sf_dir, "pages"))


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("hit_items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("hit_items", ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = language.identify(read(spark, sf_dir, "documents"), "doc_id", "text", "lang", "source")
    return found.withColumnRenamed("row_id", "doc_id")


def public_tokenizer() -> str:
    """Path of the byte-level vocabulary, looked up where a task runs."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(read(spark, sf_dir, "documents"), public_tokenizer)


def op5_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings")
    return neighbours.nearest(rows, "vec_id", "embedding", rows.where("vec_id % 20 = 0"), k=20)


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = privacy.personal_data(read(spark, sf_dir, "documents"))

    def listed(spans: Column, kind: Column | None = None) -> Column:
        name = (lambda x: x["kind"]) if kind is None else (lambda x: kind)
        return F.transform(spans, lambda x: F.concat_ws(":", name(x), x["start"].cast("string"), x["end"].cast("string")))

    base = listed(F.col("base"))
    terms = F.coalesce(listed(F.col("terms"), F.lit(privacy.TERM)), F.array().cast("array<string>"))

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *map(count, privacy.KINDS),
        F.sha2(F.array_join(base, ",").cast("binary"), 256).alias("base_sha256"),
        F.array_join(F.concat(base, terms), ",").alias("spans"),
    )


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


URL_RULES = addresses.rules(
    "allow com/", "block example.com/en/", "allow www.example.com/en/", "block net/es/", "block net/fr/"
)


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return addresses.judge(read(spark, sf_dir, "pages"), URL_RULES)


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixture.copies(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rotate(read(spark, sf_dir, "conversations"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.interactions(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.manifest(read(spark, sf_dir, "documents"))


def op13_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.without_repeats(read(spark, sf_dir, "documents"))


REGISTRY: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_html_extraction,
        op2_benchmark_decontamination,
        op3_language_id,
        op4_token_counts,
        op5_nearest_neighbours,
        op6_pii,
        op7_simhash_near_dedup,
        op8_url_filters,
        op9_source_mixing,
        op10_chat_formatting,
        op11_filter_audit,
        op12_merkle_manifest,
        op13_suffix_array_dedup,
    )
}
