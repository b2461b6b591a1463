"""Registered queries of the corpus operators, over the whole tables of a folder, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harborlight.llm import ann, bpe, centroids, decontamination, fill_in_middle, jaccard, mixing, quality, secret_scan, substring_dedup, toxicity, url_filter, warc
from harborlight.llm._sample import fold
from harborlight.llm.sql import ORACLES


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return secret_scan.scan(docs, secret_scan.train(docs)).drop("text")


def op2_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    vectors = _table(spark, folder, "embeddings")
    return ann.nearest(vectors.filter("vec_id % 20 = 0"), ann.build_index(vectors, 20), 20)


def op3_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return decontamination.find_contamination(docs, _table(spark, folder, "benchmark")).drop("text")


def op4_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text", "source")
    planned = mixing.plan_mix(docs)
    return planned.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op5_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.remove_repeats(_table(spark, folder, "documents"))


def op6_warc(spark: SparkSession, folder: str) -> DataFrame:
    manifest = warc.write_archives(warc.plan_records(_table(spark, folder, "pages")))
    read = warc.read_archives(manifest, with_payload=False)
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_quality(spark: SparkSession, folder: str) -> DataFrame:
    stats = quality.document_statistics(_table(spark, folder, "documents"))
    labels = _table(spark, folder, "labels").filter(fold(F.col("doc_id"), 5) != 0).select("doc_id", F.col("quality").alias("label"))
    scored = quality.score(stats, quality.train(stats, labels))
    return scored.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted")


def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    labels = _table(spark, folder, "labels").filter(fold(F.col("doc_id"), 4) != 2).select("doc_id", F.col("toxic").alias("label"))
    scored = toxicity.score(docs, toxicity.train(docs, labels))
    return scored.select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "score", "predicted")


def op9_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.jaccard_components(_table(spark, folder, "documents"), shingle=4, percent=85)


def op10_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judge(_table(spark, folder, "pages"))


def op11_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers  # only this query needs the vocabulary files

    vocabulary = bpe.Vocabulary.read(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    encoded = bpe.encode(docs, vocabulary, public_tokenizers.PATTERN, cut_at_spaces=True).drop("text")
    ids_sha256 = F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256)
    return bpe.decode(encoded, vocabulary).select("doc_id", F.size("ids").cast("long").alias("n_tokens"), ids_sha256.alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    cut = fill_in_middle.fill_in_middle(_table(spark, folder, "documents").select("doc_id", "text"))
    restored = fill_in_middle.restore(F.col("output"), F.col("form"))
    digests = [F.sha2("output", 256).alias("output_sha256"), F.sha2(restored, 256).alias("restored_sha256")]
    return cut.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


def op13_centroid_clustering(spark: SparkSession, folder: str) -> DataFrame:
    assigned, centres = centroids.cluster(_table(spark, folder, "embeddings"))
    named = centres.select("cluster", "cluster_inertia", "inertia", centroids.centroid_digest(F.col("centroid")).alias("centroid_sha256"))
    return assigned.join(F.broadcast(named), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")  # as many rows as clusters


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = globals()
    return {n: own[n] for n in sorted(own) if n.startswith("op") and n[2].isdigit()}


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL over the same tables; queries without one are tested against brute force."""
    return dict(ORACLES)
