"""The opN_<name> queries: each applies its operator, with production
parameters, to its whole table and derives the digest columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelstream.llm import (bpe, common, langid, linedup, mixing, neardup, oracles as sql, pii,
                              quality, repeats, search, secrets, topk, urls, variants)


def tokenizer(name: str = "byte_bpe_50k.tiktoken") -> tuple[str, str]:
    """The vocabulary file and the pattern that splits text before merging."""
    import public_tokenizers

    return public_tokenizers.path(name), public_tokenizers.PATTERN


def digest(spans: Column, kinds: list[str]) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*map(F.lit, kinds))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["rank"] + 1), s["start"], s["end"])), ",")


def op1_pii_boosted(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = F.col("found")
    base = F.filter(spans, lambda s: s["base"])
    n = lambda k: F.size(F.filter(base, lambda s: s["rank"] == pii.KINDS.index(k)))
    return pii.find(common.table(spark, sf_dir, "documents")).select(
        "doc_id", *[n(k).cast("long").alias(f"n_{k}") for k in pii.BASE],
        F.sha2(digest(base, pii.KINDS), 256).alias("base_sha256"), digest(spans, pii.KINDS).alias("spans"))


def op2_minhash_odd_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(common.table(spark, sf_dir, "documents"))


def op3_systematic_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    sized = common.stored(docs.select(F.col("doc_id").alias("key"), "source",
                                      mixing.words("text").alias("size")), "sizes")
    return mixing.copies(sized).select(
        F.col("key").alias("doc_id"), "size", "source_size", "target",
        (F.col("copies") * F.col("size")).alias("taken"))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = tokenizer()
    return bpe.round_trip(common.table(spark, sf_dir, "documents"), path, pattern).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op5_language_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    model = langid.fit(docs.filter(~held))
    return langid.predict(docs, model).select(
        "doc_id", held.alias("held_out"), "lang_pred", "score", "rejected")


def op6_topk_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(common.table(spark, sf_dir, "embeddings"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.measure(common.table(spark, sf_dir, "documents"))


def op8_sparse_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeats(common.table(spark, sf_dir, "documents"))


def op9_url_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(common.table(spark, sf_dir, "pages"))


def op10_secret_novelty(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = F.col("found")
    base = F.filter(spans, lambda s: s["base"])
    n = lambda k: F.size(F.filter(base, lambda s: s["rank"] == secrets.KINDS.index(k)))
    return secrets.find(common.table(spark, sf_dir, "documents")).select(
        "doc_id", *[n(k).cast("long").alias(f"n_{k}") for k in secrets.BASE],
        F.sha2(digest(base, secrets.KINDS), 256).alias("base_sha256"),
        digest(spans, secrets.KINDS).alias("spans"))


def op11_trie_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.variants(common.table(spark, sf_dir, "documents"))


def op12_range_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    bitmaps = common.stored(linedup.keep_bitmaps(docs), "bitmaps")
    return linedup.cleaned(docs, bitmaps).select(
        F.col("id").alias("doc_id"), "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op13_best_position_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(common.table(spark, sf_dir, "documents"),
                         common.table(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: fn for name, fn in globals().items() if name.startswith("op")}


def oracles() -> dict[str, str]:
    return {"op6_topk_segments": sql.OP6, "op11_trie_variants": sql.OP11,
            "op12_range_line_dedup": sql.OP12, "op13_best_position_search": sql.OP13}
