"""The registered queries of this folder: thin, one per operator, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import (byte_bpe, exact, fuzzy_lines, hard_negatives, packing, pieces, pii, quality,
                        simhash, token_files, url_classes, vector_codes, warc)
from strata.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def vocabulary(name: str) -> str:
    """The place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    token_files.write_tokens(table(spark, sf_dir, "documents"),
                             vocabulary("byte_bpe_50k.json"), path, end=2)
    return token_files.read_tokens(spark, path).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


def op3_pieces(packed: DataFrame) -> DataFrame:
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset", "loss_tokens")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op3_pieces(packing.pack_documents(
        table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), end=0))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(table(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = vocabulary("piece_bpe_32k.model")
    sampled = pieces.sample_pieces(table(spark, sf_dir, "documents"), model)
    return pieces.decode_pieces(sampled, model).select(
        "doc_id", (F.octet_length("pieces") / 4).cast("long").alias("n_pieces"),
        F.crc32("pieces").alias("pieces_crc32"),
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("lossless"))


def op6_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fuzzy_lines.fuzzy_lines(table(spark, sf_dir, "documents"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write_warc(table(spark, sf_dir, "pages"), path)
    return warc.read_warc(spark, path).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal(table(spark, sf_dir, "documents"))


def op10_url_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_classes.filter_urls(table(spark, sf_dir, "pages"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.vector_codes(table(spark, sf_dir, "embeddings"))


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    kind = vocabulary("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    encoded = byte_bpe.encode(table(spark, sf_dir, "documents"), *kind)
    decimal = F.array_join(F.col("ids").cast("array<string>"), ",")
    rows = byte_bpe.decode(encoded.withColumn("ids_sha256", F.sha2(decimal, 256)), *kind)
    return rows.withColumn("decoded_sha256", F.sha2("decoded", 256)).drop("decoded")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"),
                                         F.col("vec_id") % 100 == 0, label=moved)


QUERIES = {
    "op1_token_files": op1_token_files,
    "op2_simhash": op2_simhash,
    "op3_packing": op3_packing,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_pieces": op5_pieces,
    "op6_fuzzy_lines": op6_fuzzy_lines,
    "op7_warc": op7_warc,
    "op8_quality": op8_quality,
    "op9_personal_data": op9_personal_data,
    "op10_url_classes": op10_url_classes,
    "op11_vector_codes": op11_vector_codes,
    "op12_byte_bpe": op12_byte_bpe,
    "op13_hard_negatives": op13_hard_negatives,
}
