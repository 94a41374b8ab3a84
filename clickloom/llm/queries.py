"""The registered queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm import exact_dup, mixture, shards, spelling
from clickloom.llm.common import table
from clickloom.llm.decontaminate import contamination
from clickloom.llm.language import predict_language
from clickloom.llm.license_scan import license_scan
from clickloom.llm.main_text import main_text
from clickloom.llm.near_dup import near_duplicates
from clickloom.llm.repeated_text import remove_repeated
from clickloom.llm.token_records import token_records
from clickloom.llm.toxicity import toxicity
from clickloom.llm.whitening import whitened_rows
from clickloom.session import pin_session


#: Limit of the registered query's shards, so small that the smallest tables have many of them.
SHARD_BYTES = 64 << 10


def fold(of: int, column: str = "doc_id") -> F.Column:
    """crc32 of the id as text, modulo ``of``."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % of


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    pin_session(spark)
    return table(spark, folder, "documents")


def op1_token_records(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    index = token_records(_documents(spark, folder), public_tokenizers.path("byte_bpe_50k.json"))
    return index.select("doc_id", "start", "n_tokens", "ids_crc32", "part", "file", "offset", "length")


def op2_main_text(spark: SparkSession, folder: str) -> DataFrame:
    pin_session(spark)
    return main_text(table(spark, folder, "pages"))


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = _documents(spark, folder)
    known = table(spark, folder, "labels").where(fold(3) != 1)
    scored = toxicity(docs.select("doc_id", "text"), known)
    return scored.select("doc_id", F.coalesce(fold(3) == 1, F.lit(False)).alias("held_out"), "score", "predicted")


def op4_shards(spark: SparkSession, folder: str) -> DataFrame:
    out = shards.shards(_documents(spark, folder).select("doc_id", "text"), SHARD_BYTES)
    return out.select("doc_id", "doc_bytes", "shard", "depth", "shard_bytes", "shard_rows")


def op5_exact_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dup.exact_duplicates(_documents(spark, folder))


def op6_contamination(spark: SparkSession, folder: str) -> DataFrame:
    found = contamination(_documents(spark, folder).select("doc_id", "text"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"), "items_sha256", "contaminated",
        "longest", "longest_item", "item_start", "doc_start",
    )


def op7_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(_documents(spark, folder), words=3, above=85, of=100)


def op8_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = _documents(spark, folder)
    found = predict_language(docs.select("doc_id", "text"), docs.where(fold(4) != 2))
    return found.select("doc_id", F.coalesce(fold(4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op9_mixture(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixture.mix(_documents(spark, folder).select("doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op10_repeated_text(spark: SparkSession, folder: str) -> DataFrame:
    found = remove_repeated(_documents(spark, folder), size=35, v=21, digest=True)
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.spelling_variants(_documents(spark, folder).select("doc_id", "text"))


def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    pin_session(spark)
    return whitened_rows(table(spark, folder, "embeddings"))


def op13_licenses(spark: SparkSession, folder: str) -> DataFrame:
    found = license_scan(_documents(spark, folder).select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


QUERIES = {
    query.__name__: query
    for query in (
        op1_token_records,
        op2_main_text,
        op3_toxicity,
        op4_shards,
        op5_exact_duplicates,
        op6_contamination,
        op7_near_duplicates,
        op8_language,
        op9_mixture,
        op10_repeated_text,
        op11_spelling_variants,
        op12_whitening,
        op13_licenses,
    )
}

ORACLE = {
    "op4_shards": shards.oracle(SHARD_BYTES),
    "op5_exact_duplicates": exact_dup.ORACLE,
    "op9_mixture": mixture.ORACLE,
    "op11_spelling_variants": spelling.ORACLE,
}
