"""Queries of the numbered operators: each applies its operator with production parameters to the
whole of its table and derives the digest columns of its contract."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .oracles import ORACLES as ORACLE_SQL  # noqa: F401

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def piece_model_file() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


@query
def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .piece_bpe import digests, encode_decode
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return digests(encode_decode(docs, piece_model_file()))


@query
def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontaminate import digests, find_overlaps
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return digests(find_overlaps(docs, table(spark, sf_dir, "benchmark")))


def good_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of good quality; those that are toxic as well teach the resampler what goes."""
    return table(spark, sf_dir, "labels").where("quality = 1").select("doc_id", F.coalesce("toxic", F.lit(0)).alias("toxic"))


@query
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .resample import resample
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return resample(docs, good_labels(spark, sf_dir)).select("doc_id", "log_weight", "key", "kept")


@query
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .line_chunks import dedup_lines
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select(
        "doc_id", "removed_lines", F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n_chars_left"),
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("text_sha256"))


@query
def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .vector_join import near_vectors
    return near_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"), 0.98)


@query
def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .jaccard_join import near_duplicates
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .language import fit, held_out, predict
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.select("doc_id", "text", "lang").where(~held_out()))
    return predict(docs.select("doc_id", "text"), model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


@query
def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .licenses import digests, scan
    return digests(scan(table(spark, sf_dir, "documents").select("doc_id", "text")))


@query
def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .url_filter import judge
    return judge(table(spark, sf_dir, "pages").select("page_id", "url")).drop("purity")


@query
def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .warc import archive
    found = archive(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "capture_no")


@query
def op12_target_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .target_resample import draw
    docs, target = (table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    return draw(docs, target).select("doc_id", "n_features", "weight", "score", "rank")


@query
def op13_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .source_audit import audit
    return audit(table(spark, sf_dir, "documents").select("text", "lang", "source"))


@query
def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .token_files import tokenise
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return tokenise(docs, public_tokenizers.path("word_bpe_49k.json")).select("doc_id", "start", "n_tokens", "ids_crc32")
